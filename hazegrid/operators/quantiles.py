"""Exact quantiles of hot groups by counting passes.

The built-in exact ``percentile`` keeps every distinct value of a group in one task. Here a sketch first brackets each
wanted rank. A pass over the values then counts those below, above and in 65,536 equal ranges of the bracket, with
map-side combining; the range that holds the rank follows from those counts. Where that range holds one value it is the
answer, else a last pass counts its values, which are few. Wherever a rank lies, inside its bracket or not, the counts find
it: the sketch only decides how little is left for the last pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

SKETCH = 10_000                 # rank error of the sketch is at most n / SKETCH
SLACK = 4.0 / SKETCH            # a bracket reaches further than that to both sides
RANGES = 1 << 16                # of a bracket


def _range(x: Column, lo: Column, hi: Column, ranges: int) -> Column:
    """Number of the range: -1 below the bracket, ``ranges`` above it. It never decreases with the value."""
    inside = F.when(hi > lo, F.least(F.floor((x - lo) / (hi - lo) * ranges), F.lit(ranges - 1))).otherwise(0)
    return F.when(x < lo, -1).when(x <= hi, inside).otherwise(ranges).cast("int")


def exact_quantiles(df: DataFrame, keys: list[str], value: str, probs: tuple[float, ...], ranges: int = RANGES) -> DataFrame:
    """One row per key: ``n`` and ``q0..`` with linear interpolation between the two nearest ranks. Null values count
    for nothing; a key without values has no row."""
    d = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("_x"))
    points = [p for q in probs for p in (max(q - SLACK, 0.0), min(q + SLACK, 1.0))]
    b = d.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("_x", points, SKETCH).alias("_cut"))
    b = b.select(*keys, "n", F.array(*[F.struct(F.lit(i).alias("q"), F.col("_cut")[2 * i].alias("lo"), F.col("_cut")[2 * i + 1].alias("hi"))
                                       for i in range(len(probs))]).alias("_b"))
    held = (d.join(b, keys).select(*keys, "n", "_x", F.explode("_b").alias("_b"))
            .groupBy(*keys, "n", F.col("_b.q").alias("_q"), _range(F.col("_x"), F.col("_b.lo"), F.col("_b.hi"), ranges).alias("_r"))
            .agg(F.count(F.lit(1)).alias("_c"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi")))
    up = Window.partitionBy(*keys, "_q").orderBy("_r").rowsBetween(Window.unboundedPreceding, 0)    # ranges + 2 rows
    q = F.element_at(F.array(*[F.lit(float(p)) for p in probs]), F.col("_q") + 1)
    placed = held.withColumn("_upto", F.sum("_c").over(up)).withColumn("_h", (F.col("n") - 1) * q)
    rank = F.explode(F.array_distinct(F.array(F.floor("_h"), F.ceil("_h")))).alias("_rank")
    found = (placed.select("*", rank).where((F.col("_upto") > F.col("_rank")) & (F.col("_upto") - F.col("_c") <= F.col("_rank")))
             .select(*keys, "n", "_q", "_h", "_rank", (F.col("_rank") - F.col("_upto") + F.col("_c")).alias("_nth"), "_lo", "_hi"))
    wide = found.where("_lo < _hi")
    inside = (d.join(wide, keys).where(F.col("_x").between(F.col("_lo"), F.col("_hi")))
              .groupBy(*keys, "n", "_q", "_h", "_rank", "_nth", "_x").agg(F.count(F.lit(1)).alias("_c"))
              .groupBy(*keys, "n", "_q", "_h", "_rank", "_nth").agg(F.sort_array(F.collect_list(F.struct("_x", "_c"))).alias("_v")))
    start = F.struct(F.lit(0).cast("long").alias("upto"), F.lit(None).cast("double").alias("x"))
    nth = F.aggregate("_v", start, lambda s, v: F.struct(
        (s["upto"] + v["_c"]).alias("upto"),
        F.coalesce(s["x"], F.when(s["upto"] + v["_c"] > F.col("_nth"), v["_x"])).alias("x")))["x"]
    cols = [*keys, "n", "_q", "_h", "_rank"]
    at = found.where("_lo = _hi").select(*cols, F.col("_lo").alias("_x")).unionByName(inside.select(*cols, nth.alias("_x")))
    low, high = F.min_by("_x", "_rank"), F.max_by("_x", "_rank")
    return (at.groupBy(*keys, "n", "_q", "_h").agg((low + (high - low) * (F.col("_h") - F.floor("_h"))).alias("_e"))
            .groupBy(*keys).agg(F.max("n").alias("n"), *[F.max(F.when(F.col("_q") == i, F.col("_e"))).alias(f"q{i}") for i in range(len(probs))]))


def unpivot(df: DataFrame, keys: list[str], cols: list[str], name: str = "channel", value: str = "value") -> DataFrame:
    """Wide to long, one row per key and column."""
    return df.unpivot(keys, list(cols), name, value)
