"""Seasonal, spatial and correlation reports."""

from __future__ import annotations

from itertools import combinations_with_replacement

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from hazegrid.constants import CHANNELS, DATE, N_CLASSES, SEASONS, STATION, TARGET, TS
from hazegrid.functions import clock
from hazegrid.operators.features import guarded
from hazegrid.operators.gaps import interpolate_linear
from hazegrid.operators.ordered import HOURLY, Layout, in_blocks, over_rows
from hazegrid.session import settle


def daily_means(df: DataFrame, ts: str = TS) -> DataFrame:
    cols = [c for c in CHANNELS if c in df.columns]
    return df.groupBy(STATION, clock.truncate("day", F.col(ts)).alias(DATE)).agg(*[F.avg(c).alias(c) for c in cols])


def monthly_trend(df: DataFrame, col: str = TARGET, months: int = 6, ts: str = TS) -> DataFrame:
    """Mean per calendar month over all stations and its moving average."""
    m = df.groupBy(clock.truncate("month", F.col(ts)).alias("month")).agg(F.avg(col).alias(f"avg_{col}"))
    # twelve rows a year are left here
    w = Window.orderBy("month").rowsBetween(-(months - 1), 0)
    return m.withColumn(f"ma{months}", guarded(F.avg(f"avg_{col}"), f"avg_{col}", w, months))


def season_means(df: DataFrame, col: str = TARGET, ts: str = TS) -> DataFrame:
    """Mean per season, winter first; readings without a time come before."""
    m = df.groupBy(clock.season(F.col(ts)).alias("season")).agg(F.avg(col).alias(f"avg_{col}"))
    return m.orderBy(F.array_position(F.array(*[F.lit(s) for s in SEASONS]), F.col("season")))


def season_extremes(df: DataFrame, col: str = TARGET, ts: str = TS) -> DataFrame:
    """Highest and lowest season and their ratio."""
    m, v = season_means(df, col, ts), F.col(f"avg_{col}")
    return m.agg(F.max_by("season", v).alias("highest"), F.max(v).alias("highest_mean"),
                 F.min_by("season", v).alias("lowest"), F.min(v).alias("lowest_mean"),
                 (F.max(v) / F.min(v)).alias("ratio"))


def climatology(df: DataFrame, col: str = TARGET, ts: str = TS) -> DataFrame:
    return df.groupBy(F.month(ts).alias("month")).agg(F.avg(col).alias(f"avg_{col}"))


def diurnal_profile(df: DataFrame, col: str = TARGET, ts: str = TS) -> DataFrame:
    """Mean per hour, weekdays beside weekends."""
    return (df.select(F.hour(ts).alias("hour"), clock.is_weekend(F.col(ts)).alias("_we"), col)
            .groupBy("hour").pivot("_we", [0, 1]).agg(F.avg(col))
            .withColumnsRenamed({"0": "weekday", "1": "weekend"}))


def diurnal_extremes(df: DataFrame, col: str = TARGET, ts: str = TS) -> DataFrame:
    """Weekday hours of the highest and lowest mean; ties go to the earlier hour."""
    p = diurnal_profile(df, col, ts).where("weekday IS NOT NULL")
    return p.agg(F.min_by("hour", F.struct(-F.col("weekday"), F.col("hour"))).alias("peak_hour"),
                 F.min_by("hour", F.struct(F.col("weekday"), F.col("hour"))).alias("trough_hour"))


def station_means(df: DataFrame, col: str = TARGET) -> DataFrame:
    return df.groupBy(STATION).agg(F.avg(col).alias(f"avg_{col}")).orderBy(f"avg_{col}", STATION)


def station_extremes(df: DataFrame, col: str = TARGET) -> DataFrame:
    """Dirtiest and cleanest station and the gap between them."""
    m, v = df.groupBy(STATION).agg(F.avg(col).alias("_m")).where("_m IS NOT NULL"), F.col("_m")
    return m.agg(F.min_by(STATION, F.struct(-v, F.col(STATION))).alias("dirtiest"), F.max(v).alias("dirtiest_mean"),
                 F.min_by(STATION, F.struct(v, F.col(STATION))).alias("cleanest"), F.min(v).alias("cleanest_mean"),
                 (F.max(v) - F.min(v)).alias("gap"))


def pearson(a: str, b: str) -> Column:
    """``corr`` that does not divide by zero: NaN where a channel does not vary, as in the check SQL; NULL without a pair."""
    va, vb = F.regr_sxx(b, a), F.regr_syy(b, a)
    r = va / va if a == b else F.regr_sxy(b, a) / (F.sqrt(va) * F.sqrt(vb))
    return F.when((va > 0) & (vb > 0), r).when(va.isNotNull(), F.lit(float("nan")))


def corr_matrix(df: DataFrame, cols: tuple[str, ...] = CHANNELS) -> DataFrame:
    """Pearson correlation of every channel pair over the rows where both are known; one pass, no shuffle
    but the final merge."""
    cols = [c for c in cols if c in df.columns]
    pairs = list(combinations_with_replacement(cols, 2))
    one = df.agg(*[pearson(a, b).alias(f"{a}|{b}") for a, b in pairs])
    long = one.unpivot([], [f"{a}|{b}" for a, b in pairs], "_k", "r")
    a, b = F.split_part("_k", F.lit("|"), F.lit(1)), F.split_part("_k", F.lit("|"), F.lit(2))
    half = long.select(a.alias("a"), b.alias("b"), "r")
    return half.unionByName(half.where("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b"), "r"))


def corr_drivers(df: DataFrame, target: str = TARGET, cols: tuple[str, ...] = CHANNELS) -> DataFrame:
    """Channels with the highest and the lowest correlation to the target. NaN, of a channel that does not vary, counts as
    the largest value, as in the check SQL."""
    cols = [c for c in cols if c in df.columns and c != target]
    one = df.agg(*[pearson(target, c).alias(c) for c in cols])
    long = one.unpivot([], cols, "channel", "r").where("r IS NOT NULL")
    r = F.col("r")
    return long.agg(F.min_by("channel", F.struct(~F.isnan(r), -r, F.col("channel"))).alias("strongest_positive"), F.max(r).alias("max_r"),
                    F.min_by("channel", F.struct(r, F.col("channel"))).alias("strongest_negative"), F.min(r).alias("min_r"))


def lag_corr(df: DataFrame, col: str = TARGET, lags: tuple[int, ...] = (1, 24, 168), at: Layout = HOURLY) -> DataFrame:
    """Correlation of the series with itself k rows earlier, per station and lag."""
    lagged = over_rows(df.select(at.key, at.ts, col), at, max(lags), 0,
                       lambda w: {f"_l{k}": F.lag(col, k).over(w) for k in lags})
    wide = lagged.groupBy(at.key).agg(*[F.corr(col, f"_l{k}").alias(str(k)) for k in lags])
    return (wide.unpivot([at.key], [str(k) for k in lags], "lag", "r")
            .select(at.key, F.col("lag").cast("int").alias("lag"), "r"))


def acf(df: DataFrame, col: str = TARGET, nlags: int = 200, at: Layout = HOURLY) -> DataFrame:
    """Autocorrelation up to ``nlags`` rows about the mean of the whole series, gaps filled linearly; cells
    before the first valid one are left out.

    Each block of bounded size, with the rows before it, becomes one array, and a lag is its dot product
    with itself shifted. Only one sum per block and lag leaves a task.
    """
    # three narrow columns, read for the mean, the positions and the counts: written once instead of filled thrice
    filled = settle(interpolate_linear(df.select(at.key, at.ts, col), col, at).where(F.col(col).isNotNull()))
    mean = filled.groupBy(at.key).agg(F.avg(col).alias("_m"))
    centred = filled.join(mean, at.key).select(at.key, at.ts, (F.col(col) - F.col("_m")).alias("_x"))
    blocks = in_blocks(centred, at, nlags, 0).select(
        at.key, "_block", "_pos", "_x", (F.col("_home") == F.col("_block")).alias("_own"))

    def products(rows: pd.DataFrame) -> pd.DataFrame:
        """Row j of the block times row j - k, for its own rows with such a predecessor in reach."""
        rows = rows.sort_values("_pos")
        x, first = rows["_x"].to_numpy(), int((~rows["_own"]).sum())
        sums = [float(x[max(first, k):] @ x[max(first, k) - k:len(x) - k]) if k < len(x) else 0.0 for k in range(nlags + 1)]
        return pd.DataFrame({at.key: rows[at.key].iloc[0], "lag": np.arange(nlags + 1, dtype=np.int32), "s": sums})

    # a few hundred products per row: as array functions this took a thousand times as long per product
    kind = df.schema[at.key].dataType.simpleString()
    parts = blocks.groupBy(at.key, "_block").applyInPandas(products, f"`{at.key}` {kind}, lag int, s double")
    # a lag beyond the end of a series has no pair and no value
    n = filled.groupBy(at.key).agg(F.count(F.lit(1)).alias("_n"))
    sums = parts.groupBy(at.key, "lag").agg(F.sum("s").alias("s"))
    total = sums.where("lag = 0").select(at.key, F.col("s").alias("_v"))
    return (sums.join(total, at.key).join(n, at.key).where("lag < _n")
            .select(at.key, "lag", F.when(F.col("_v") > 0, F.col("s") / F.col("_v")).alias("acf")))


def class_counts(df: DataFrame, label: str = "y") -> DataFrame:
    """Rows per class; classes that never occur have 0."""
    one = df.agg(*[F.count_if(F.col(label) == c).alias(str(c)) for c in range(N_CLASSES)])
    return (one.unpivot([], [str(c) for c in range(N_CLASSES)], "y", "n")
            .select(F.col("y").cast("int").alias("y"), "n"))
