"""Table, document and report readers and writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from hazegrid.operators.documents import DOCUMENT_SCHEMA

FACT_ORDER = ["station_id", "ts"]
JDBC_BATCH = 20_000     # fixed value: rows per insert


def read_table(spark: SparkSession, folder: str, name: str, cols: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")
    return df.select(*cols) if cols else df


def write_star(star: dict[str, DataFrame], folder: str) -> None:
    """Replaces the four tables. Facts are range-partitioned and sorted by station and time, so files are
    equal in size whatever one station holds, and point and range reads skip by file statistics."""
    for name, df in star.items():
        if set(FACT_ORDER) <= set(df.columns):
            df = df.repartitionByRange(*FACT_ORDER).sortWithinPartitions(*FACT_ORDER)
        df.write.mode("overwrite").parquet(f"{folder.rstrip('/')}/{name}.parquet")


def read_star(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    names = ("stations", "wind_directions", "pollutant_readings", "weather_readings")
    return {n: read_table(spark, folder, n) for n in names}


def write_star_jdbc(star: dict[str, DataFrame], url: str, properties: dict[str, str]) -> None:
    """Reloads the tables of a relational store, dimensions first; keeps the tables' definitions."""
    for name, df in star.items():
        (df.write.mode("overwrite").option("truncate", "true").option("batchsize", JDBC_BATCH)
         .jdbc(url, name, properties=properties))


def write_docs(docs: DataFrame, path: str, n: int | None = None) -> None:
    """Documents as JSON lines, compressed, since every line repeats the names of all fields; with ``n`` the first n by station and time."""
    if n is not None:
        docs = docs.orderBy("station", "timestamp").limit(n)
    docs.write.mode("overwrite").option("ignoreNullFields", "false").option("compression", "gzip").json(path)


def read_docs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(DOCUMENT_SCHEMA).json(path)


def write_report(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """A result table as CSV with a header, or as JSON lines."""
    if fmt == "csv":
        df.write.mode("overwrite").option("header", "true").csv(path)
    elif fmt == "json":
        df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    else:
        raise ValueError(f"unknown report format {fmt!r}")


def read_report(spark: SparkSession, path: str, schema: str, fmt: str = "csv") -> DataFrame:
    reader = spark.read.schema(schema)
    return reader.option("header", "true").csv(path) if fmt == "csv" else reader.json(path)


def to_json_rows(df: DataFrame, name: str = "json") -> DataFrame:
    return df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias(name))
