"""Design matrix, metrics, models and scoring."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from hazegrid.constants import FEATURES, STATION
from hazegrid.learning import dataset, deploy, metrics, scoring, selection
from hazegrid.learning.knn import knn_predict
from hazegrid.learning.models import fit_logreg, fit_mlp, predict
from hazegrid.functions.category import argmax, probabilities
from hazegrid.operators import outliers
from hazegrid.operators.documents import to_documents
from hazegrid.plans.bindings import CATEGORY_SQL, LABEL_SQL, WEIGHTS, Tables, argmax_sql, design_sql, rounded, scaled_sql, softmax_sql
from hazegrid.plans.registry import query
from hazegrid.session import scratch_path

PROBS = ", ".join(f"round(p{c}, 6) AS p{c}" for c in range(6))
FEATS = ", ".join(f"round({c}, 6) AS {c}" for c in FEATURES)


def predicted(t: Tables) -> DataFrame:
    return t.b6_scored.withColumn("prediction", argmax([F.col(p) for p in probabilities()]))


@query("daily_design_matrix", "design", f"SELECT station, date, {FEATS}, y FROM design")
def daily_design_matrix(t: Tables) -> DataFrame:
    return rounded(t.design, FEATURES).withColumns({c: F.col(c).cast("int") for c in ("t_is_weekend", "t_is_heating")})


@query("daily_design_matrix_unlabelled", "design_open", f"SELECT station, date, {FEATS}, y FROM design_open")
def daily_design_matrix_unlabelled(t: Tables) -> DataFrame:
    d = dataset.build_daily_classification(t.b3_hourly, require_label=False)
    return rounded(d, FEATURES).withColumns({c: F.col(c).cast("int") for c in ("t_is_weekend", "t_is_heating")})


@query("temporal_split", "split", "SELECT station, date, y, part FROM split")
def temporal_split(t: Tables) -> DataFrame:
    return dataset.temporal_split(t.design).select(STATION, "date", "y", "part")


@query("standardize", "split train", f"""
    SELECT s.station, s.date, s.y, p.part, {FEATS} FROM ({scaled_sql('split', 'train')}) s
    JOIN (SELECT station, date, part FROM split) p ON p.station = s.station AND p.date = s.date""")
def standardize(t: Tables) -> DataFrame:
    parts = dataset.standardize(*t.parts.values())
    out = None
    for name, d in zip(t.parts, parts):
        d = d.withColumn("part", F.lit(name))
        out = d if out is None else out.unionByName(d)
    return rounded(out, FEATURES)


@query("baseline_persistence", "test", f"SELECT station, date, y, {CATEGORY_SQL.format('pm_today')} AS prediction FROM test")
def baseline_persistence(t: Tables) -> DataFrame:
    return dataset.predict_persistence(t.parts["test"]).select(STATION, "date", "y", "prediction")


@query("baseline_majority", "test train", """
    SELECT station, date, y, (SELECT y FROM train GROUP BY y ORDER BY count(*) DESC, y LIMIT 1) AS prediction FROM test""")
def baseline_majority(t: Tables) -> DataFrame:
    return dataset.predict_majority(t.parts["train"], t.parts["test"]).select(STATION, "date", "y", "prediction")


@query("class_weights", "train six", """
    WITH c AS (SELECT six.y, count(train.y) AS n FROM six LEFT JOIN train ON train.y = six.y GROUP BY 1),
         w AS (SELECT y, n, pow(CAST(sum(greatest(n, 1)) OVER () AS DOUBLE) / (6 * greatest(n, 1)), 0.75) AS w FROM c)
    SELECT y, round(w * sum(n) OVER () / sum(w * n) OVER (), 6) AS weight FROM w""")
def class_weights(t: Tables) -> DataFrame:
    return rounded(dataset.class_weights(t.parts["train"], 0.75), ["weight"])


@query("confusion_matrix", "cm", "SELECT y, prediction, n FROM cm")
def confusion_matrix(t: Tables) -> DataFrame:
    return metrics.confusion(predicted(t))


@query("accuracy", "predicted", "SELECT round(avg(CAST(y = prediction AS INT)), 6) AS accuracy FROM predicted")
def accuracy(t: Tables) -> DataFrame:
    return rounded(metrics.accuracy(predicted(t)), ["accuracy"])


@query("confusion_normalised", "cm", """
    SELECT y, prediction, round(n / greatest(sum(n) OVER (PARTITION BY y), 1), 6) AS share FROM cm""")
def confusion_normalised(t: Tables) -> DataFrame:
    return rounded(metrics.confusion_normalised(metrics.confusion(predicted(t))), ["share"])


REPORT = """SELECT y, precision, recall, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1 FROM (
    SELECT a.y, CASE WHEN p.n > 0 THEN a.tp / p.n ELSE 0 END AS precision, CASE WHEN a.n > 0 THEN a.tp / a.n ELSE 0 END AS recall
    FROM (SELECT y, sum(n) AS n, sum(n) FILTER (WHERE y = prediction) AS tp FROM cm GROUP BY 1) a
    JOIN (SELECT prediction AS y, sum(n) AS n FROM cm GROUP BY 1) p ON p.y = a.y)"""


@query("class_report", "cm", f"SELECT y, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1 FROM ({REPORT})")
def class_report(t: Tables) -> DataFrame:
    return rounded(metrics.class_report(metrics.confusion(predicted(t))), ["precision", "recall", "f1"])


@query("macro_f1", "cm", f"SELECT round(avg(f1), 6) AS macro_f1 FROM ({REPORT})")
def macro_f1(t: Tables) -> DataFrame:
    return rounded(metrics.macro_f1(metrics.confusion(predicted(t))), ["macro_f1"])


@query("roc_points", "score_points", """
    SELECT class, score, round(fp / negatives, 6) AS fpr, round(tp / positives, 6) AS tpr FROM score_points WHERE positives > 0 AND negatives > 0
    UNION ALL SELECT DISTINCT class, NULL, 0.0, 0.0 FROM score_points
    UNION ALL SELECT DISTINCT class, NULL, 1.0, 1.0 FROM score_points WHERE positives = 0 OR negatives = 0""")
def roc_points(t: Tables) -> DataFrame:
    return rounded(metrics.roc_curve(t.b6_scored), ["fpr", "tpr"])


AUC = """SELECT class, sum((fpr - f0) * (tpr + t0) / 2) AS auc FROM (
    SELECT class, fpr, tpr, lag(fpr, 1, 0) OVER w AS f0, lag(tpr, 1, 0) OVER w AS t0 FROM (
      SELECT class, score, fp / negatives AS fpr, tp / positives AS tpr FROM score_points WHERE positives > 0 AND negatives > 0)
    WINDOW w AS (PARTITION BY class ORDER BY score DESC)) GROUP BY 1"""


@query("class_auc", "score_points", f"SELECT class, round(auc, 6) AS auc FROM ({AUC})")
def class_auc(t: Tables) -> DataFrame:
    return rounded(metrics.class_auc(t.b6_scored), ["auc"])


@query("macro_auc", "score_points", f"SELECT round(avg(auc), 6) AS macro_auc FROM ({AUC})")
def macro_auc(t: Tables) -> DataFrame:
    return rounded(metrics.macro_auc(t.b6_scored), ["macro_auc"])


@query("pr_points", "score_points", """
    SELECT class, score, round(tp / greatest(positives, 1), 6) AS recall, round(tp / greatest(tp + fp, 1), 6) AS precision FROM score_points""")
def pr_points(t: Tables) -> DataFrame:
    return rounded(metrics.pr_curve(t.b6_scored), ["recall", "precision"])


def scaler(t: Tables) -> DataFrame:
    return dataset.fit_scaler(t.parts["train"])


SCORED_TEST = f"({softmax_sql('(' + scaled_sql('test', 'train') + ')', 'station, date, y')})"


@query("score_softmax", "test train", f"SELECT station, date, y, {PROBS}, prediction, round(confidence, 6) AS confidence FROM {SCORED_TEST}")
def score_softmax(t: Tables) -> DataFrame:
    d = scoring.score_softmax(dataset.apply_scaler(t.parts["test"], scaler(t)), WEIGHTS)
    return rounded(d.select(STATION, "date", "y", *probabilities(), "prediction", "confidence"), [*probabilities(), "confidence"])


@query("top3_classes", "b6_scored", f"""
    WITH long AS ({' UNION ALL '.join(f'SELECT station, date, {c} AS class, p{c} AS probability FROM b6_scored' for c in range(6))}),
         o AS (SELECT *, row_number() OVER (PARTITION BY station, date ORDER BY probability DESC, class) AS rn FROM long)
    SELECT station, date, CAST(rn AS INT) AS rank, class, {LABEL_SQL.format('class')} AS category, probability FROM o WHERE rn <= 3""")
def top3_classes(t: Tables) -> DataFrame:
    return scoring.top_classes(t.b6_scored)


LIVE = "FROM {s} WHERE date >= (SELECT max(x.date) FROM {s} x WHERE x.station = {s}.station) - INTERVAL 200 DAY"


def history_sql(daily: str, fitted_on: str = "recent") -> str:
    """The last 200 days of each station, capped, as scored design rows; needs the binding ``train``. Fences come from
    those days, or from another table."""
    fences = " UNION ALL ".join(
        f"SELECT station, '{c}' AS channel, q3 - q1 AS iqr, q3 + 3 * (q3 - q1) AS fence FROM (SELECT station, quantile_cont({c}, 0.25) AS q1, "
        f"quantile_cont({c}, 0.75) AS q3 FROM {fitted_on} WHERE {c} IS NOT NULL GROUP BY 1)" for c in ("pm2_5", "wspm"))
    cap = ", ".join(f"CASE WHEN f_{c}.iqr > 0 AND s.{c} > f_{c}.fence THEN f_{c}.fence ELSE s.{c} END AS {c}" for c in ("pm2_5", "wspm"))
    joins = " ".join(f"LEFT JOIN (SELECT * FROM fences WHERE channel = '{c}') f_{c} ON f_{c}.station = s.station" for c in ("pm2_5", "wspm"))
    return f"""WITH daily AS ({daily}),
        recent AS (SELECT * FROM daily WHERE date >= (SELECT max(x.date) FROM daily x WHERE x.station = daily.station) - INTERVAL 200 DAY),
        fences AS ({fences}),
        capped AS (SELECT s.* REPLACE ({cap}) FROM recent s {joins}),
        live AS ({design_sql('capped', False)}),
        scored AS ({softmax_sql('(' + scaled_sql('live', 'train') + ')', 'station, date, y, raw_today')})"""


ROUNDED = ", ".join(f"round({c}, 1) AS {c}" for c in ("pm2_5", "pm10", "so2", "no2", "co", "o3", "temp", "pres", "dewp", "rain", "wspm"))


@query("forecast_next_day", "b3_daily train", f"""{history_sql(f'SELECT station, date, {ROUNDED} FROM b3_daily')}
    SELECT station, CAST(n AS BIGINT) AS feature_days, date + INTERVAL 1 DAY AS forecast_date,
           {LABEL_SQL.format('(' + CATEGORY_SQL.format('raw_today') + ')')} AS today_category, {LABEL_SQL.format('prediction')} AS forecast_category,
           round(confidence, 6) AS confidence, {PROBS}
    FROM (SELECT *, row_number() OVER (PARTITION BY station ORDER BY date DESC) AS rn, count(*) OVER (PARTITION BY station) AS n FROM scored)
    WHERE rn = 1 AND n >= 5""")
def forecast_next_day(t: Tables) -> DataFrame:
    docs = to_documents(t.b3_hourly.withColumn("wd", F.lit(None).cast("string")), t.b4_stations)
    return rounded(scoring.forecast_next_day(docs, scaler(t), WEIGHTS), [*probabilities(), "confidence"])


@query("backtest", "b3_daily train", f"""{history_sql('SELECT * FROM b3_daily')}
    SELECT station, count(*) AS days, round(avg(CAST(y = prediction AS INT)), 6) AS accuracy
    FROM (SELECT *, row_number() OVER (PARTITION BY station ORDER BY date DESC) AS rn FROM scored WHERE y IS NOT NULL) WHERE rn <= 90 GROUP BY 1""")
def backtest(t: Tables) -> DataFrame:
    return rounded(scoring.backtest(t.b3_hourly, scaler(t), WEIGHTS), ["accuracy"])


def stored_model(t: Tables) -> deploy.Deployed:
    """The fixed weights as the newest version of a model folder, with the scaler and the fences of the whole history."""
    folder = scratch_path(t.spark, "models")
    unscaled = ([[0.0] * len(FEATURES)] * 6, [0.0] * 6)
    fences = outliers.fit_fences(t.b3_hourly, outliers.CAPPED)
    for weights in (unscaled, WEIGHTS):     # a second version replaces the first
        deploy.save_version(folder, weights, scaler(t), fences, {"deployed_model": "fixed weights"})
    return deploy.load_version(t.spark, folder)


@query("model_roundtrip", "test train", f"SELECT station, date, y, {PROBS}, prediction, round(confidence, 6) AS confidence FROM {SCORED_TEST}")
def model_roundtrip(t: Tables) -> DataFrame:
    d = stored_model(t).score(t.parts["test"])
    return rounded(d.select(STATION, "date", "y", *probabilities(), "prediction", "confidence"), [*probabilities(), "confidence"])


@query("forecast_stored", "b3_daily train", f"""{history_sql(f'SELECT station, date, {ROUNDED} FROM b3_daily', 'b3_daily')},
    best AS (SELECT *, list_sort([{', '.join(f"{{'p': -p{c}, 'c': {c}}}" for c in range(6))}]) AS o,
                    row_number() OVER (PARTITION BY station ORDER BY date DESC) AS rn, count(*) OVER (PARTITION BY station) AS n FROM scored)
    SELECT station, CAST(n AS BIGINT) AS feature_days, date + INTERVAL 1 DAY AS forecast_date,
           {LABEL_SQL.format('(' + CATEGORY_SQL.format('raw_today') + ')')} AS today_category, {LABEL_SQL.format('prediction')} AS forecast_category,
           round(confidence, 6) AS confidence, {PROBS},
           {', '.join(f"{LABEL_SQL.format(f'o[{i}].c')} AS top{i}, round(-o[{i}].p, 6) AS probability{i}" for i in (1, 2, 3))},
           'fixed weights' AS deployed_model, 2 AS version
    FROM best WHERE rn = 1 AND n >= 5""")
def forecast_stored(t: Tables) -> DataFrame:
    docs = to_documents(t.b3_hourly.withColumn("wd", F.lit(None).cast("string")), t.b4_stations)
    return rounded(deploy.forecast(docs, stored_model(t)), [*probabilities(), "confidence", "probability1", "probability2", "probability3"])


@query("backtest_stored", "b3_daily train", f"""{history_sql('SELECT * FROM b3_daily', 'b3_daily')}
    SELECT station, count(*) AS days, round(avg(CAST(y = prediction AS INT)), 6) AS accuracy
    FROM (SELECT *, row_number() OVER (PARTITION BY station ORDER BY date DESC) AS rn FROM scored WHERE y IS NOT NULL) WHERE rn <= 90 GROUP BY 1""")
def backtest_stored(t: Tables) -> DataFrame:
    return rounded(deploy.backtest(t.b3_hourly, stored_model(t)), ["accuracy"])


# ----------------------------------------------------------------- models; the optimiser's path has no SQL form

def _parts(t: Tables) -> selection.Parts:
    return selection.Parts(t.design)


def _shown(d: DataFrame) -> DataFrame:
    return d.select(STATION, "date", "y", "prediction", *probabilities())


@query("logreg_predictions")
def logreg_predictions(t: Tables) -> DataFrame:
    p = _parts(t)
    return _shown(predict(fit_logreg(p.train_val, 1e-3), p.test))


@query("logreg_balanced_predictions")
def logreg_balanced_predictions(t: Tables) -> DataFrame:
    p = _parts(t)
    return _shown(predict(fit_logreg(dataset.with_weights(p.train_val, 0.75), 1e-3, weight="weight"), p.test))


@query("mlp_predictions")
def mlp_predictions(t: Tables) -> DataFrame:
    p = _parts(t)
    return _shown(predict(fit_mlp(p.train_val, selection.SMALL_HIDDEN), p.test))


@query("knn_predictions", "train test", f"""
    WITH s AS ({scaled_sql('test', 'train')}), r AS ({scaled_sql('train', 'train')}),
         q AS (SELECT station, date, y, CAST([{', '.join(FEATURES)}] AS DOUBLE[29]) AS v FROM s),
         t AS (SELECT station, date, y, CAST([{', '.join(FEATURES)}] AS DOUBLE[29]) AS v FROM r),
         near AS (SELECT q.station, q.date, q.y, min({{'d': array_distance(q.v, t.v), 's': t.station, 't': t.date, 'c': t.y}}, 15) AS n
                  FROM q, t GROUP BY 1, 2, 3),
         votes AS (SELECT station, date, y, {', '.join(f'len(list_filter(n, lambda e: e.c = {c})) / 15.0::DOUBLE AS p{c}' for c in range(6))} FROM near)
    SELECT station, date, y, {argmax_sql()} AS prediction, {PROBS} FROM votes""")
def knn_predictions(t: Tables) -> DataFrame:
    train, test = dataset.standardize(t.parts["train"], t.parts["test"])
    votes = selection.with_truth(knn_predict(train, test, 15), t.parts["test"])
    return rounded(_shown(votes), probabilities())


@query("grid_selection")
def grid_selection(t: Tables) -> DataFrame:
    return selection.grid_selection(_parts(t))


@query("learning_curve")
def learning_curve(t: Tables) -> DataFrame:
    return selection.learning_curve(_parts(t))


@query("train_to_forecast")
def train_to_forecast(t: Tables) -> DataFrame:
    """Experiments, a new version of a model folder, and the forecast of every station from it."""
    folder = scratch_path(t.spark, "models")
    deploy.deploy(t.design, outliers.fit_fences(t.b3_hourly, outliers.CAPPED), folder, curve=False)     # a key of its own
    docs = to_documents(t.b3_hourly.withColumn("wd", F.lit(None).cast("string")), t.b4_stations)
    return deploy.forecast(docs, deploy.load_version(t.spark, folder))


@query("experiment_table")
def experiment_table(t: Tables) -> DataFrame:
    return selection.experiment_table(t.spark, selection.run_experiments(_parts(t)).rows)
