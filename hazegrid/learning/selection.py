"""Grid selection, learning curve and the table of experiments.

The driver loops over settings; every fit and every metric inside is a distributed job on a written
design matrix.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hazegrid.constants import DATE, FEATURES, LAG_FEATURES, STATION
from hazegrid.learning import metrics
from hazegrid.learning.dataset import apply_scaler, fit_scaler, predict_majority, predict_persistence, temporal_split, with_weights
from hazegrid.learning.knn import knn_predict, neighbours, votes
from hazegrid.learning.models import fit_logreg, fit_mlp, predict
from hazegrid.operators.ordered import ordered_ids
from hazegrid.session import settle

# The grids.
L2_GRID = (1e-4, 1e-3, 1e-2, 1e-1, 1.0)
K_GRID = (15, 35, 75)
HIDDEN_GRID = (16, 32, 64)
BETA_GRID = (0.5, 0.75, 1.0)
CURVE_FRACTIONS = (0.05, 0.1, 0.2, 0.35, 0.5, 0.7, 0.85, 1.0)
CURVE_LEAST = 800
SMALL_HIDDEN, LARGE_HIDDEN = 8, 64


class Parts:
    """The standardised design matrix, written once, and its parts."""

    def __init__(self, design: DataFrame):
        split = settle(temporal_split(predict_persistence(design).withColumnRenamed("prediction", "today")))
        raw = {p: split.where(F.col("part") == p) for p in ("train", "val", "test")}
        self.scaler = settle(fit_scaler(raw["train"]))
        self.train, self.val, self.test = (settle(apply_scaler(raw[p], self.scaler)) for p in ("train", "val", "test"))
        self.train_val = self.train.unionByName(self.val)

    def sizes(self) -> str:
        return "/".join(str(d.count()) for d in (self.train, self.val, self.test))


def score(predicted: DataFrame) -> float:
    """Macro-F1 of a prediction."""
    return metrics.summary(predicted).first().macro_f1


def with_truth(predicted: DataFrame, truth: DataFrame) -> DataFrame:
    return predicted.join(truth.select(STATION, DATE, "y"), [STATION, DATE])


def select_param(grid: tuple, run: Callable[[object], DataFrame]) -> tuple[object, dict]:
    """Macro-F1 on the validation part for each setting; the first of the best ones wins."""
    scores = {g: score(run(g)) for g in grid}
    return max(scores, key=scores.get), scores


def select_l2(p: Parts) -> tuple[float, dict]:
    return select_param(L2_GRID, lambda l2: predict(fit_logreg(p.train, l2), p.val))


def select_k(p: Parts) -> tuple[int, dict]:
    """The neighbours of the largest k hold those of the others, so they are sought once."""
    near = settle(neighbours(p.train, p.val, max(K_GRID)))
    return select_param(K_GRID, lambda k: with_truth(votes(near, k), p.val))


def select_hidden(p: Parts) -> tuple[int, dict]:
    return select_param(HIDDEN_GRID, lambda h: predict(fit_mlp(p.train, h), p.val))


def select_beta(p: Parts, l2: float) -> tuple[float, dict]:
    return select_param(BETA_GRID, lambda b: predict(fit_logreg(with_weights(p.train, b), l2, weight="weight"), p.val))


def tune(p: Parts) -> dict[str, tuple[object, dict]]:
    """The chosen setting and all validation scores of each model."""
    l2 = select_l2(p)
    return {"logistic_l2": l2, "knn_k": select_k(p), "neural_hidden": select_hidden(p), "balanced_beta": select_beta(p, l2[0])}


def tuning_table(spark: SparkSession, tuned: dict[str, tuple[object, dict]]) -> DataFrame:
    rows = [(name, str(g), float(v), g == best) for name, (best, scores) in tuned.items() for g, v in scores.items()]
    return spark.createDataFrame(rows, "model string, setting string, val_macro_f1 double, chosen boolean")


def grid_selection(p: Parts) -> DataFrame:
    """All validation scores with the chosen setting of each model marked."""
    return tuning_table(p.train.sparkSession, tune(p))


def learning_curve(p: Parts, l2: float | None = None, fractions: tuple[float, ...] = CURVE_FRACTIONS,
                   least: int = CURVE_LEAST) -> DataFrame:
    """Train and test macro-F1 of the logistic model on growing parts of train and validation, taken in
    (part, station, date) order; without ``l2`` at the penalty that is best on the validation part."""
    l2 = select_l2(p)[0] if l2 is None else l2
    both = p.train.withColumn("_o", F.lit(0)).unionByName(p.val.withColumn("_o", F.lit(1)))
    numbered = ordered_ids(both, [F.col("_o"), F.col(STATION), F.col(DATE)], "_id")
    n = numbered.count()
    rows = []
    for f in fractions:
        m = min(max(least, int(n * f)), n)
        part = numbered.where(F.col("_id") <= m)
        model = fit_logreg(part, l2)
        rows.append((float(f), int(m), score(predict(model, part)), score(predict(model, p.test))))
    return p.train.sparkSession.createDataFrame(
        rows, "fraction double, rows long, train_macro_f1 double, test_macro_f1 double")


def _run(name: str, kind: str, setting: str, deployable: bool, train: DataFrame, test: DataFrame) -> tuple:
    on_test = metrics.summary(test).first()
    return (name, kind, setting, deployable, round(metrics.accuracy(train).first().accuracy, 3),
            round(on_test.accuracy, 3), round(on_test.macro_f1, 3))


@dataclass
class Outcome:
    """Experiments in running order, the fitted models by experiment, and what tuning found."""

    rows: list[tuple]
    models: dict[str, PipelineModel]
    tuned: dict[str, tuple[object, dict]]

    @property
    def chosen(self) -> dict[str, object]:
        return {name: best for name, (best, _) in self.tuned.items()}

    def tuning(self, spark: SparkSession) -> DataFrame:
        return tuning_table(spark, self.tuned)


def run_experiments(p: Parts) -> Outcome:
    """Two baselines and eight models: chosen on the validation part, refitted with it, scored on the test part."""
    out = Outcome([], {}, tune(p))
    best_l2, best_k, best_h, best_b = (out.chosen[name] for name in ("logistic_l2", "knn_k", "neural_hidden", "balanced_beta"))
    today = lambda d: d.withColumn("prediction", F.col("today"))
    out.rows += [
        _run("persistence", "naive", "none", False, today(p.train), today(p.test)),
        _run("majority", "naive", "most frequent class", False, predict_majority(p.train, p.train), predict_majority(p.train, p.test)),
    ]

    def fitted(name: str, kind: str, setting: str, model: PipelineModel, deployable: bool = True) -> None:
        out.models[name] = model
        out.rows.append(_run(name, kind, setting, deployable, predict(model, p.train), predict(model, p.test)))

    fitted("logistic, lags only", "linear", f"{len(LAG_FEATURES)} features", fit_logreg(p.train, features=LAG_FEATURES), False)
    fitted("logistic, all features", "linear", f"{len(FEATURES)} features", fit_logreg(p.train), False)
    fitted("logistic, tuned", "linear", f"l2={best_l2}", fit_logreg(p.train_val, best_l2))
    out.rows.append(_run("nearest neighbours, tuned", "instance", f"k={best_k}", False,
                         with_truth(knn_predict(p.train, p.train, best_k, exclude_self=True), p.train),
                         with_truth(knn_predict(p.train_val, p.test, best_k), p.test)))
    for name, h in (("neural, small", SMALL_HIDDEN), ("neural, tuned", best_h), ("neural, large", LARGE_HIDDEN)):
        fitted(name, "neural", f"hidden={h}", fit_mlp(p.train_val, h))
    fitted("logistic, balanced", "linear", f"l2={best_l2}, beta={best_b}",
           fit_logreg(with_weights(p.train_val, best_b), best_l2, weight="weight"))
    return out


def experiment_table(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """One row per experiment in running order, the deployed and the best ones marked."""
    t = spark.createDataFrame(
        [(i, *r) for i, r in enumerate(rows)],
        "run int, experiment string, approach string, setting string, deployable boolean, "
        "train_acc double, test_acc double, macro_f1 double")
    best = select_deployed(t)
    return t.withColumns({"best_accuracy": F.col("run") == best["best_run"], "best_macro_f1": F.col("run") == best["f1_run"],
                          "deployed": F.col("run") == best["deployed_run"]}).orderBy("run")


def select_deployed(table: DataFrame) -> dict:
    """Best learned model by test accuracy and by macro-F1, first of equals. The best one by accuracy is
    deployed if it can be, else the best that can."""
    learned = F.col("approach") != "naive"

    def first_best(col: str, where: Column) -> Column:
        return F.min_by("run", F.when(where, F.struct(-F.col(col), F.col("run"))))

    r = table.agg(first_best("test_acc", learned).alias("best_run"), first_best("macro_f1", learned).alias("f1_run"),
                  first_best("test_acc", learned & F.col("deployable")).alias("dep")).first()
    ok = table.where((F.col("run") == r.best_run) & F.col("deployable")).limit(1).count() > 0
    return {"best_run": r.best_run, "f1_run": r.f1_run, "deployed_run": r.best_run if ok else r.dep}
