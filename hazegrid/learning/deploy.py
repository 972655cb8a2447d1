"""From readings to a deployed model, and forecasts from what was deployed.

A model folder holds versions. A version is one folder with the model, its scaler, its fences and its evaluation as
Parquet, and metadata that is written last and in one step: a version without metadata does not exist for readers, so
an interrupted training leaves the version before it in force.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from hazegrid.constants import CATEGORIES, DATE, FEATURES, N_CLASSES, STATION
from hazegrid.functions.category import category_label, probabilities
from hazegrid.learning import metrics, scoring, selection
from hazegrid.learning.dataset import apply_scaler, build_daily_classification
from hazegrid.learning.models import predict
from hazegrid.operators.aggregates import class_counts
from hazegrid.operators.cleaning import clean
from hazegrid.operators.gaps import impute
from hazegrid.operators.outliers import CAPPED, cap_outliers, fit_fences
from hazegrid.session import settle

#: Softmax weights as rows: class, input (``bias`` for the intercept) and its weight.
WEIGHT_ROWS = "class int, input string, weight double"


def weight_rows(weights: scoring.Weights, features: tuple[str, ...] = FEATURES) -> list[tuple]:
    w, bias = weights
    return [(c, f, float(x)) for c in range(len(bias)) for f, x in zip((*features, "bias"), (*w[c], bias[c]))]


def weights_of(table: DataFrame, features: tuple[str, ...] = FEATURES) -> scoring.Weights:
    """Back from rows, of which there are classes x (inputs + 1); an absent weight is 0."""
    found = {(r["class"], r["input"]): r["weight"] for r in table.collect()}
    return ([[found.get((c, f), 0.0) for f in features] for c in range(N_CLASSES)],
            [found.get((c, "bias"), 0.0) for c in range(N_CLASSES)])


@dataclass(frozen=True)
class Deployed:
    """A stored model: Spark ML stages or softmax weights, with what its inputs need."""

    spark: SparkSession
    path: str
    meta: dict
    model: PipelineModel | scoring.Weights

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}")

    @property
    def scaler(self) -> DataFrame:
        return self.table("scaler")

    @property
    def fences(self) -> DataFrame:
        return self.table("fences")

    def score(self, design: DataFrame) -> DataFrame:
        """Rows of a design matrix with p0..p5, the predicted class and its confidence; inputs come back scaled."""
        features = tuple(self.meta["feature_cols"])
        scaled = apply_scaler(design, self.scaler, features)
        if isinstance(self.model, PipelineModel):
            return predict(self.model, scaled).withColumn("confidence", F.greatest(*probabilities()))
        return scoring.score_softmax(scaled, self.model, features)


def versions(spark: SparkSession, path: str) -> DataFrame:
    """Columns version, folder and meta of the versions that are complete."""
    none = spark.createDataFrame([], "version long, folder string, meta string")
    try:
        found = spark.read.text(f"{path}/*/meta").select("value", F.regexp_replace("_metadata.file_path", "/meta/[^/]*$", "").alias("folder"))
    except Exception as e:  # no version yet
        if getattr(e, "getCondition", lambda: None)() != "PATH_NOT_FOUND":
            raise
        return none
    return found.select(F.get_json_object("value", "$.version").cast("long").alias("version"), "folder", F.col("value").alias("meta"))


def save_version(path: str, model: PipelineModel | scoring.Weights, scaler: DataFrame, fences: DataFrame, meta: dict | None = None,
                 **tables: DataFrame) -> int:
    """Write a new version and return its number. ``tables`` are kept with it under their names."""
    spark = scaler.sparkSession
    version = (versions(spark, path).agg(F.max("version")).first()[0] or 0) + 1
    folder = f"{path}/{version:06d}-{uuid.uuid4().hex}"
    kind = "stages" if isinstance(model, PipelineModel) else "softmax"
    if kind == "stages":
        model.write().save(f"{folder}/model")
    else:
        spark.createDataFrame(weight_rows(model), WEIGHT_ROWS).write.parquet(f"{folder}/model")
    for name, table in {"scaler": scaler, "fences": fences, **tables}.items():
        table.write.parquet(f"{folder}/{name}")
    # The keys that describe a model
    full = {"task": "classification", "target": "next_day_aqi_category", "labels": list(CATEGORIES), "feature_cols": list(FEATURES),
            **(meta or {}), "version": version, "kind": kind, "tables": sorted(tables)}
    spark.createDataFrame([(json.dumps(full),)], "meta string").coalesce(1).write.text(f"{folder}/meta")
    return version


def load_version(spark: SparkSession, path: str, version: int | None = None) -> Deployed:
    """The version asked for, or the newest one."""
    known = versions(spark, path)
    if version is not None:
        known = known.where(F.col("version") == version)
    newest = known.orderBy(F.col("version").desc(), F.col("folder").desc()).limit(1).collect()
    if not newest:
        raise LookupError(f"{path} has no {'version' if version is None else f'version {version}'}")
    meta, folder = json.loads(newest[0].meta), newest[0].folder
    model = PipelineModel.load(f"{folder}/model") if meta["kind"] == "stages" else weights_of(spark.read.parquet(f"{folder}/model"))
    return Deployed(spark, folder, meta, model)


# ----------------------------------------------------------------- training

def prepared(readings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Raw readings cleaned, filled and capped, and the fences that were fitted on the filled series."""
    filled = settle(impute(clean(readings)))
    fences = settle(fit_fences(filled, CAPPED))
    return cap_outliers(filled, fences, CAPPED), fences


def evaluation(scored: DataFrame) -> dict[str, DataFrame]:
    """What is reported of a model on the test part, as tables."""
    cm = settle(metrics.confusion(scored))
    return {"class_report": metrics.class_report(cm), "confusion": metrics.confusion_normalised(cm).join(cm, ["y", "prediction"]),
            "roc": metrics.roc_curve(scored), "pr": metrics.pr_curve(scored), "auc": metrics.class_auc(scored)}


def deploy(design: DataFrame, fences: DataFrame, path: str, curve: bool = True) -> int:
    """Run the experiments on a design matrix and store the one to deploy as a new version of the model folder.

    Kept with it: ``experiments``, ``tuning`` (all validation scores), ``class_counts`` of the train part, ``curve`` (learning
    curve at the chosen penalty) and the test part's ``class_report``, ``confusion``, ``roc``, ``pr`` and ``auc``.
    """
    spark = design.sparkSession
    p = selection.Parts(design)
    done = selection.run_experiments(p)
    table = settle(selection.experiment_table(spark, done.rows))
    runs = {r.run: r for r in table.collect()}          # ten rows
    chosen, best = (next(r for r in runs.values() if r[mark]) for mark in ("deployed", "best_accuracy"))
    by_f1 = next(r for r in runs.values() if r.best_macro_f1)
    model = done.models[chosen.experiment]
    scored = settle(predict(model, p.test).select(STATION, DATE, "y", *probabilities(), "prediction"))
    tables = {"experiments": table, "tuning": done.tuning(spark), "class_counts": class_counts(p.train), **evaluation(scored)}
    if curve:
        tables["curve"] = selection.learning_curve(p, done.chosen["logistic_l2"])
    auc = metrics.macro_auc(scored).first().macro_auc
    meta = {"deployed_model": chosen.experiment, "best_model": best.experiment, "best_macro_f1_model": by_f1.experiment, "setting": chosen.setting,
            "split": p.sizes(), "test_accuracy": chosen.test_acc, "test_macro_f1": chosen.macro_f1,
            "macro_auc": None if auc is None else round(auc, 3), "persistence_acc": runs[0].test_acc, "chosen": done.chosen}
    return save_version(path, model, p.scaler, fences, meta, **tables)


def train_and_deploy(readings: DataFrame, path: str, curve: bool = True) -> int:
    """Raw hourly readings to a new version of the model folder ``path``; returns its number."""
    capped, fences = prepared(readings)
    return deploy(settle(build_daily_classification(capped)), fences, path, curve)


# ----------------------------------------------------------------- forecasts

def forecast(docs: DataFrame, deployed: Deployed, days: int = 200, least: int = 5) -> DataFrame:
    """Tomorrow's category of every station with at least ``least`` feature days, from a stored model with its fences:
    the three likeliest classes (``top1`` to ``top3`` with their probabilities) and the model's name and version."""
    ahead = scoring.forecast_rows(docs, deployed.score, days, least, deployed.fences)
    cells = F.array_sort(F.array(*[F.struct((-F.col(p)).alias("neg"), F.lit(c).alias("class")) for c, p in enumerate(probabilities())]))
    best = {}
    for i in range(3):
        best[f"top{i + 1}"] = category_label(cells[i]["class"])
        best[f"probability{i + 1}"] = -cells[i]["neg"]
    return ahead.withColumns({**best, "deployed_model": F.lit(deployed.meta.get("deployed_model")),
                              "version": F.lit(deployed.meta["version"])})


def backtest(hourly: DataFrame, deployed: Deployed, window: int = 200, days: int = 90) -> DataFrame:
    """Accuracy of a stored model over each station's last ``days`` days whose next category is known."""
    return scoring.backtest_rows(hourly, deployed.score, window, days, deployed.fences)
