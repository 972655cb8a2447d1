"""What the operators share: reading tables, folds, and tables written once to the shared folder."""

from __future__ import annotations

import sys
from collections.abc import Callable
from types import ModuleType

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazegrid.session import scratch_path


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def fold(col: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")), F.lit(parts))


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder (``spark.checkpoint.dir``) as Parquet and read it back.

    Cuts the lineage, so that what was computed survives lost executors, and lets later readers prune columns.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows of a table that is sent to all tasks, at most.
BROADCAST_ROWS = 400_000


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df``, to be broadcast if it has no more than ``rows`` rows; a larger one is joined by shuffle. Counts it, so write it first."""
    return F.broadcast(df) if df.count() <= rows else df


def internal(df: DataFrame, **columns: str | Column) -> DataFrame:
    """Only the named inputs under the operator's own names, so that no other column can clash with them."""
    return df.select(*[(df[c] if isinstance(c, str) else c).alias(name) for name, c in columns.items()])


def of_this_worker(owner: str, make: Callable[[], object] | None = None) -> object:
    """What the tasks of a Python worker share under the name ``owner``, made by the first of them.

    A worker outlives its tasks and stages. It holds one owner's memory at a time: a task of another operator drops
    what the one before left, also if it has nothing to keep itself. Functions travel to tasks by value, so a global of
    this module would start anew in every task; a module of the worker's own does not.
    """
    held = vars(sys.modules.setdefault("_held_by_this_worker", ModuleType("_held_by_this_worker")))
    if held.get("owner") != owner:
        held.pop("value", None)
        held["value"], held["owner"] = make() if make else None, owner
    return held["value"]
