"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "hazegrid", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators count on (UTC clock, adaptive execution)."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.parquet.filterPushdown": "true",
        **conf,
    }
    for k, v in settings.items():
        b = b.config(k, v)
    return prepare(b.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Pin what results depend on; safe to call on a session somebody else made."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    Where the session names none, a local master gets a fresh folder; on a cluster that is an error, since
    executors would each write to a disk of their own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all machines share (master is {master})")
        folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder once, as Parquet, so that later plans read the same rows.

    Used where a result is read several times (model fits) or where re-evaluation
    could differ (row ids). Survives lost executors, unlike a local checkpoint; readers prune
    columns, and Spark knows the size.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "table")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
