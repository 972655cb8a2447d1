"""Global positions of rows in a given order, without a task that sees all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazegrid.llm.common import keep, small


def ranked(df: DataFrame, *order: Column, name: str = "rank") -> DataFrame:
    """``df`` with its position (from 0) in ``order``, which should tell all rows apart.

    Rows are range-partitioned, sorted in their partitions and written; a position is the place in the partition plus
    the rows of the partitions before it (a table of one row per partition).
    """
    at = F.col("_at")
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    rows = keep(rows, "sorted").withColumn("_part", F.shiftrightunsigned(at, 33)).withColumn("_at", at.bitwiseAND((1 << 33) - 1))
    counts = keep(rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")), "counts")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return rows.join(small(offsets), "_part").withColumn(name, F.col("_before") + at).drop("_part", "_at", "_before")
