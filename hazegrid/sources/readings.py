"""Station CSV files."""

from __future__ import annotations

import csv
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from hazegrid.constants import MISSING_MARKS, RAW_FILE_PATTERN, RAW_HEADER

COUNTERS = ("No", "year", "month", "day", "hour")


def column_name(header: str) -> str:
    """``PM2.5`` -> ``pm2_5``."""
    return header.lower().replace(".", "_")


def station_files(spark: SparkSession, folder: str, pattern: str = RAW_FILE_PATTERN) -> list[str]:
    """Paths of the station files below a folder; none if the folder does not exist."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(folder)
    if not root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(root):
        return []
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", pattern).load(folder).select("path"))
    return sorted(r.path for r in files.collect())       # one name per station file


def read_header(spark: SparkSession, path: str) -> tuple[str, ...]:
    """First line of a file; nothing else of it is read."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    stream = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(p)
    try:
        line = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8")).readLine()
    finally:
        stream.close()
    return tuple(h.strip().lstrip("﻿") for h in next(csv.reader([line or ""])))


def read_readings(spark: SparkSession, folders: Iterable[str], pattern: str = RAW_FILE_PATTERN) -> DataFrame:
    """All station files of the first folder that has any, in canonical columns, still as text.

    An explicit schema binds CSV columns by position, so a file with another column order would be read
    wrongly without a word. Files are therefore grouped by their header line, each group is one scan, and
    the groups are united by name; columns a file lacks are NULL.
    """
    paths = next((found for folder in folders if (found := station_files(spark, folder, pattern))), [])
    if not paths:
        raise FileNotFoundError(f"no {pattern} in any of the folders")
    with ThreadPoolExecutor(16) as pool:
        headers = list(pool.map(lambda p: read_header(spark, p), paths))
    groups: dict[tuple[str, ...], list[str]] = {}
    for path, header in zip(paths, headers):
        groups.setdefault(header, []).append(path)

    parts = []
    for header, members in groups.items():
        schema = StructType([StructField(h, StringType()) for h in header])
        df = spark.read.csv(members, header=True, schema=schema, enforceSchema=True)
        parts.append(df.select(*[F.col(f"`{h}`") for h in header if h in RAW_HEADER]))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)

    def cell(h: str):
        if h not in out.columns:
            return F.lit(None).cast("int" if h in COUNTERS else "string")
        text = F.trim(f"`{h}`")
        known = F.when(~text.isin(*MISSING_MARKS), text)
        return known.try_cast("double").cast("int") if h in COUNTERS else known

    return out.select(*[cell(h).alias(column_name(h)) for h in RAW_HEADER])
