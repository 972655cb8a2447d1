"""Classifiers of Spark ML, fitted by distributed optimisation."""

from __future__ import annotations

import json

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from hazegrid.constants import CATEGORIES, FEATURES, N_CLASSES

SEED = 7


def fit_logreg(df: DataFrame, l2: float = 1e-3, features: tuple[str, ...] = FEATURES, weight: str | None = None,
               label: str = "y", max_iter: int = 100) -> PipelineModel:
    """Multinomial logistic regression with an L2 penalty on the coefficients and none on the intercepts, brought
    to its optimum. Inputs must already be standardised."""
    lr = LogisticRegression(featuresCol="_features", labelCol=label, family="multinomial", regParam=l2,
                            elasticNetParam=0.0, standardization=False, maxIter=max_iter, tol=1e-7)
    if weight:
        lr = lr.setWeightCol(weight)
    return _fit(lr, df, features, label)


def fit_mlp(df: DataFrame, hidden: int = 32, features: tuple[str, ...] = FEATURES, label: str = "y",
            max_iter: int = 60) -> PipelineModel:
    """One hidden layer of sigmoid units and a softmax output, fitted by L-BFGS."""
    mlp = MultilayerPerceptronClassifier(featuresCol="_features", labelCol=label, layers=[len(features), hidden, N_CLASSES],
                                         maxIter=max_iter, seed=SEED, blockSize=256)
    return _fit(mlp, df, features, label)


def _fit(estimator, df: DataFrame, features: tuple[str, ...], label: str) -> PipelineModel:
    vectors = VectorAssembler(inputCols=list(features), outputCol="_features")
    ready = vectors.transform(df.withColumn(label, F.col(label).cast("double")))
    keep = ["_features", label] + ([estimator.getWeightCol()] if estimator.hasParam("weightCol")
                                   and estimator.isDefined("weightCol") else [])
    return PipelineModel([vectors, estimator.fit(ready.select(*keep))])


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Adds p0..p5 (0 for a class the model never saw) and the predicted class."""
    raw = model.transform(df)
    p = vector_to_array("probability")
    probs = [F.coalesce(F.get(p, F.lit(c)), F.lit(0.0)).alias(f"p{c}") for c in range(N_CLASSES)]
    return raw.select(*df.columns, *probs, F.col("prediction").cast("int").alias("prediction"))


def save_model(model: PipelineModel, scaler: DataFrame, meta: dict, path: str) -> None:
    """The fitted stages, the scaler table and one row of metadata."""
    spark = scaler.sparkSession
    model.write().overwrite().save(f"{path}/model")
    scaler.write.mode("overwrite").parquet(f"{path}/scaler")
    full = {"task": "classification", "target": "next_day_aqi_category", "labels": list(CATEGORIES),
            "feature_cols": list(FEATURES), **meta}
    spark.createDataFrame([(json.dumps(full),)], "meta string").write.mode("overwrite").text(f"{path}/meta")


def load_model(spark: SparkSession, path: str) -> tuple[PipelineModel, DataFrame, dict]:
    meta = json.loads(spark.read.text(f"{path}/meta").first().value)
    return PipelineModel.load(f"{path}/model"), spark.read.parquet(f"{path}/scaler"), meta
