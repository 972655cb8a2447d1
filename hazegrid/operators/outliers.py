"""Upper outliers by Tukey's far-out fence, fitted per station and channel."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from hazegrid.constants import STATION, TARGET
from hazegrid.operators.quantiles import exact_quantiles, unpivot

CAPPED = (TARGET, "wspm")


def fit_fences(df: DataFrame, cols: tuple[str, ...] = CAPPED, k: float = 3.0) -> DataFrame:
    """station, channel, q1, q3, iqr and the fence Q3 + k * IQR; fit on any part of the data and keep it."""
    long = unpivot(df.select(STATION, *cols), [STATION], list(cols))
    q = exact_quantiles(long, [STATION, "channel"], "value", (0.25, 0.75))
    iqr = F.col("q1") - F.col("q0")
    return q.select(STATION, "channel", F.col("q0").alias("q1"), F.col("q1").alias("q3"),
                    iqr.alias("iqr"), (F.col("q1") + k * iqr).alias("fence"))


def _with_fences(df: DataFrame, fences: DataFrame, cols: list[str]) -> DataFrame:
    """Adds ``_h_c``, NULL where a column is flat (IQR 0) or has no fence. The fence table has one row per
    station; whether it is sent to every task is left to its measured size."""
    wide = fences.where("iqr > 0").groupBy(STATION).agg(
        *[F.max(F.when(F.col("channel") == c, F.col("fence"))).alias(f"_h_{c}") for c in cols])
    return df.join(wide, STATION, "left")


def cap_outliers(df: DataFrame, fences: DataFrame, cols: tuple[str, ...] = CAPPED) -> DataFrame:
    cols = [c for c in cols if c in df.columns]
    j = _with_fences(df, fences, cols)
    return j.select(*[F.when(F.col(c) > F.col(f"_h_{c}"), F.col(f"_h_{c}")).otherwise(F.col(c)).alias(c)
                      if c in cols else F.col(c) for c in df.columns])


def cap_report(df: DataFrame, fences: DataFrame, cols: tuple[str, ...] = CAPPED) -> DataFrame:
    """How many readings each channel's cap changes, in percent of all rows."""
    cols = [c for c in cols if c in df.columns]
    one = _with_fences(df, fences, cols).agg(
        F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(c) > F.col(f"_h_{c}")).alias(c) for c in cols])
    return (one.unpivot(["_n"], cols, "channel", "capped")
            .select("channel", "capped", F.round(100 * F.col("capped") / F.col("_n"), 3).alias("pct"))
            .orderBy(F.col("capped").desc(), "channel"))
