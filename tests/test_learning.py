import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from hazegrid.constants import FEATURES
from hazegrid.learning import dataset, knn, metrics, models, scoring, selection
from hazegrid.plans.bindings import WEIGHTS

D0 = dt.datetime(2020, 1, 1)


@pytest.fixture(scope="module")
def points(spark):
    """Station-days with a class that follows the first input."""
    r = random.Random(11)
    rows = []
    for s in ("a", "b", "c"):
        for i in range(150):
            x = [r.gauss(0, 1) for _ in FEATURES]
            rows.append((s, D0 + dt.timedelta(days=i), *x, min(5, max(0, int(2.5 + 1.5 * x[0])))))
    return spark.createDataFrame(rows, "station string, date timestamp_ntz, " + ", ".join(f"{f} double" for f in FEATURES) + ", y int")


def test_split_by_date(points):
    parts = {r.part: r for r in dataset.temporal_split(points).groupBy("part").agg(F.min("date").alias("lo"), F.count("*").alias("n")).collect()}
    assert parts["val"].lo == D0 + dt.timedelta(days=int(150 * 0.70)) and parts["test"].lo == D0 + dt.timedelta(days=int(150 * 0.85))
    assert sum(p.n for p in parts.values()) == 450


def test_scaler_keeps_flat_columns(points):
    flat = points.withColumn("rain", F.lit(4.0))
    row = dataset.standardize(flat)[0].agg(F.max("rain").alias("m"), F.stddev_pop("temp").alias("s")).first()
    assert row.m == 0.0 and math.isclose(row.s, 1.0, rel_tol=1e-9)


@pytest.mark.parametrize("exclude_self", [False, True])
@pytest.mark.parametrize("block, cells", [(16, 8), (1000, 1)])
def test_knn_equals_brute_force(points, exclude_self, block, cells):
    k = 7
    # a third of the train rows are copies of one point
    train = points.unionByName(points.where("station = 'a'").withColumns({f: F.lit(0.5) for f in FEATURES}).withColumn("station", F.lit("copy")))
    query = train if exclude_self else points.where("station = 'b'")
    got = {(r.station, r.date): r for r in knn.knn_predict(train, query, k, exclude_self=exclude_self, block=block, cells=cells).collect()}
    t = sorted(((r.station, r.date, r.y, np.array([r[f] for f in FEATURES])) for r in train.collect()), key=lambda e: e[:2])
    tv = np.array([e[3] for e in t])
    asked = query.collect()
    assert len(got) == len(asked)
    for q in asked:
        d = ((tv - np.array([q[f] for f in FEATURES])) ** 2).sum(1).round(9)
        order = [i for i in np.argsort(d, kind="stable") if not (exclude_self and t[i][:2] == (q.station, q.date))][:k]
        votes = np.bincount([t[i][2] for i in order], minlength=6)
        assert got[q.station, q.date].prediction == int(votes.argmax())
        assert np.allclose([got[q.station, q.date][f"p{c}"] for c in range(6)], votes / k)


def test_knn_does_not_depend_on_the_layout(points, tmp_path):
    """Ties of points that lie in different blocks, on checkpointed, Parquet and repartitioned inputs."""
    train = points.withColumns({f: F.round(f, 0) for f in FEATURES[:3]} | {f: F.lit(0.1) for f in FEATURES[3:]})
    train.write.parquet(str(tmp_path / "t"))
    read = points.sparkSession.read.parquet(str(tmp_path / "t"))
    shown = [sorted((r.station, r.date, r.rn, r.t_station, r.t_date, r.d2) for r in knn.neighbours(d, d, 5, exclude_self=True, block=b, cells=c).collect())
             for d, b, c in ((train.checkpoint(), 30, 6), (read, 30, 6), (read.repartition(7), 11, 3))]
    assert shown[0] == shown[1] == shown[2] and len(shown[0]) == 5 * 450


def test_knn_second_round_visits_few_cells(spark):
    """Clustered points: hardly any query has to leave its cell, and the bound is its own."""
    r = np.random.RandomState(0)
    centres = r.randn(12, len(FEATURES)) * 50
    x = centres[np.arange(1200) % 12] + r.randn(1200, len(FEATURES))
    df = spark.createDataFrame([(D0 + dt.timedelta(days=i), [float(v) for v in x[i]], i % 12) for i in range(1200)], "date timestamp_ntz, v array<double>, cell int")
    asked = df.withColumns({"station": F.lit("s"), "bound": F.lit(100.0)})
    radius = np.array([np.sqrt(((x[c::12] - centres[c]) ** 2).sum(1)).max() for c in range(12)])
    assert knn._others(asked, centres, radius).count() == 0
    wide = knn._others(asked.withColumn("bound", F.lit(1e9)), centres, radius).groupBy("cell").count().collect()
    assert {r["count"] for r in wide} == {1100}


@pytest.fixture(scope="module")
def scored(spark):
    r = random.Random(2)
    rows = []
    for i in range(400):
        p = [round(r.random(), 2) for _ in range(5)] + [0.0]
        rows.append(("a", D0 + dt.timedelta(days=i), r.randrange(5), *p))     # class 5 never occurs
    return spark.createDataFrame(rows, "station string, date timestamp_ntz, y int, " + ", ".join(f"p{c} double" for c in range(6)))


def test_metrics_match_numpy(scored):
    d = scoring.with_decision(scored)
    rows = d.collect()
    y, p = np.array([r.y for r in rows]), np.array([r.prediction for r in rows])
    cm = np.zeros((6, 6), int)
    np.add.at(cm, (y, p), 1)
    got = {(r.y, r.prediction): r.n for r in metrics.confusion(d).collect()}
    assert all(got[i, j] == cm[i, j] for i in range(6) for j in range(6))
    tp = np.diag(cm)
    pr, rc = tp / np.maximum(cm.sum(0), 1), tp / np.maximum(cm.sum(1), 1)
    f1 = np.where(pr + rc > 0, 2 * pr * rc / np.where(pr + rc > 0, pr + rc, 1), 0)
    assert math.isclose(metrics.macro_f1(metrics.confusion(d)).first().macro_f1, f1.mean())
    one = metrics.summary(d).first()
    assert math.isclose(one.macro_f1, f1.mean()) and math.isclose(one.accuracy, (y == p).mean())
    # area by pair counting
    aucs = []
    for c in range(5):
        s = np.array([r[f"p{c}"] for r in rows])
        a, b = s[y == c][:, None], s[y != c][None, :]
        aucs.append(((a > b).sum() + 0.5 * (a == b).sum()) / (a.size * b.size))
    got = {r["class"]: r.auc for r in metrics.class_auc(scored).collect()}
    assert set(got) == set(range(5)) and np.allclose([got[c] for c in range(5)], aucs)
    assert math.isclose(metrics.macro_auc(scored).first().macro_auc, np.mean(aucs))
    flat = [r for r in metrics.roc_curve(scored).collect() if r["class"] == 5]
    assert sorted((r.fpr, r.tpr) for r in flat) == [(0.0, 0.0), (1.0, 1.0)]


def test_curves_where_scores_crowd(spark):
    """All scores within a millionth: no partition gets more than its share, and the running sums are exact."""
    r = random.Random(1)
    rows = {(c, 0.5 + r.random() * 1e-6): (r.randrange(3), r.randrange(3)) for c in (0, 0, 0, 1) for _ in range(2000)}
    df = spark.createDataFrame([(c, x, p, n) for (c, x), (p, n) in rows.items()], "class int, score double, pos long, neg long")
    got = {(x["class"], x.score): (x.tp, x.fp, x.positives, x.negatives) for x in metrics.cumulative(df, 12).collect()}
    for c in (0, 1):
        mine = sorted((x for x in rows if x[0] == c), reverse=True)
        tp, fp = np.cumsum([rows[x] for x in mine], axis=0).T
        assert all(got[x] == (a, b, tp[-1], fp[-1]) for x, a, b in zip(mine, tp, fp))
    sizes = [x["count"] for x in df.repartitionByRange(12, "class", F.col("score").desc()).groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 3 * sum(sizes) / 12


def test_class_weights(points):
    counts = {r.y: r.n for r in points.groupBy("y").agg(F.count("*").alias("n")).collect()}
    n = np.array([counts.get(c, 0) for c in range(6)], float)
    w = (np.maximum(n, 1).sum() / (6 * np.maximum(n, 1))) ** 0.5
    w *= n.sum() / (w * n).sum()
    got = {r.y: r.weight for r in dataset.class_weights(points, 0.5).collect()}
    assert np.allclose([got[c] for c in range(6)], w)


def test_logreg_reaches_its_optimum(points, tmp_path):
    l2 = 1e-2
    model = models.fit_logreg(points, l2)
    fitted = model.stages[-1]
    rows = points.collect()
    x = np.array([[r[f] for f in FEATURES] for r in rows])
    y = np.eye(6)[[r.y for r in rows]]
    w, b = fitted.coefficientMatrix.toArray(), fitted.interceptVector.toArray()
    z = x @ w.T + b
    p = np.exp(z - z.max(1, keepdims=True))
    p /= p.sum(1, keepdims=True)
    grad = (p - y).T @ x / len(x) + l2 * w
    assert np.abs(grad).max() < 1e-4
    df = models.predict(model, points)
    assert metrics.accuracy(df).first().accuracy > 0.6
    models.save_model(model, dataset.fit_scaler(points), {"model": "softmax"}, str(tmp_path / "m"))
    back, scaler, meta = models.load_model(points.sparkSession, str(tmp_path / "m"))
    assert meta["feature_cols"] == list(FEATURES) and scaler.count() == 1
    assert [r.prediction for r in models.predict(back, points).orderBy("station", "date").collect()] == \
        [r.prediction for r in df.orderBy("station", "date").collect()]


def test_fixed_weights(points):
    r = scoring.score_softmax(points, WEIGHTS).orderBy("station", "date").first()
    x = np.array([r[f] for f in FEATURES])
    z = np.array(WEIGHTS[0]) @ x + np.array(WEIGHTS[1])
    p = np.exp(z - z.max())
    p /= p.sum()
    assert np.allclose([r[f"p{c}"] for c in range(6)], p) and r.prediction == p.argmax()


def test_select_deployed(spark):
    rows = [("persistence", "naive", "", False, .9, .9, .9), ("nearest", "instance", "", False, .8, .8, .2), ("logistic", "linear", "", True, .7, .7, .3),
            ("neural", "neural", "", True, .7, .7, .4)]
    t = {r.experiment: r for r in selection.experiment_table(spark, rows).collect()}
    assert t["nearest"].best_accuracy and t["logistic"].deployed and t["neural"].best_macro_f1 and not t["persistence"].best_accuracy
