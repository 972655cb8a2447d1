"""Calendar, lag and rolling features."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, WindowSpec, functions as F

from hazegrid.constants import HOURLY_LAGS, HOURLY_WINDOWS, STATION, TARGET, TS
from hazegrid.functions import clock
from hazegrid.functions.category import category_ordinal
from hazegrid.operators.cleaning import clean
from hazegrid.operators.gaps import impute
from hazegrid.operators.ordered import DAILY, HOURLY, Layout, before_moments, over_rows, with_runs
from hazegrid.operators.outliers import CAPPED, cap_outliers, fit_fences
from hazegrid.session import settle


def add_time_features(df: DataFrame, ts: str = TS) -> DataFrame:
    t = F.col(ts)
    hour_sin, hour_cos = clock.cycle(F.hour(t), 24)
    month_sin, month_cos = clock.cycle(F.month(t), 12)
    return df.withColumns({
        "hour": F.hour(t), "dayofweek": F.weekday(t), "month": F.month(t),
        "is_weekend": clock.is_weekend(t), "is_heating_season": clock.is_heating(t), "season": clock.season(t),
        "hour_sin": hour_sin, "hour_cos": hour_cos, "month_sin": month_sin, "month_cos": month_cos,
    })


def guarded(agg: Column, col: str, frame: WindowSpec, least: int) -> Column:
    """The aggregate where the frame holds enough valid values, else NULL."""
    return F.when(F.count(col).over(frame) >= least, agg.over(frame))


def lag_columns(w: WindowSpec, target: str, lags: tuple[int, ...]) -> dict[str, Column]:
    return {f"{target}_lag{k}": F.lag(target, k).over(w) for k in lags}


#: Windows of more rows are put together from runs; a frame of a few rows is as cheap.
SHORT_WINDOW = 8


def past_runs(target: str, windows: tuple[int, ...], at: Layout) -> Callable[[DataFrame], DataFrame]:
    """Adds to blocks what ``past_columns`` needs for long windows."""
    def add(blocks: DataFrame) -> DataFrame:
        for n in windows:
            if n > SHORT_WINDOW:
                blocks = with_runs(blocks, at, target, n)
        return blocks
    return add


def past_columns(w: WindowSpec, target: str, windows: tuple[int, ...], mean: bool = True, std: bool = True) -> dict[str, Column]:
    """Mean and sample deviation of the rows before the current one."""
    out = {}
    for n in windows:
        least = max(2, n // 4)
        if n > SHORT_WINDOW:
            m = before_moments(w, n)
            enough = m["n"] >= least
            average, deviation = F.when(enough, m["mean"]), F.when(enough, F.sqrt(m["m2"] / (m["n"] - 1)))
        else:
            frame = w.rowsBetween(-n, -1)
            average, deviation = guarded(F.avg(target), target, frame, least), guarded(F.stddev_samp(target), target, frame, least)
        if mean:
            out[f"{target}_ma{n}"] = average
        if std:
            out[f"{target}_mstd{n}"] = deviation
    return out


def add_lag_features(df: DataFrame, target: str = TARGET, lags: tuple[int, ...] = HOURLY_LAGS,
                     at: Layout = HOURLY) -> DataFrame:
    return over_rows(df, at, max(lags), 0, lambda w: lag_columns(w, target, lags))


def add_moving_averages(df: DataFrame, target: str = TARGET, windows: tuple[int, ...] = HOURLY_WINDOWS,
                        at: Layout = HOURLY, mean: bool = True, std: bool = True) -> DataFrame:
    return over_rows(df, at, max(windows), 0, lambda w: past_columns(w, target, windows, mean, std), past_runs(target, windows, at))


def add_history(df: DataFrame, target: str = TARGET, lags: tuple[int, ...] = HOURLY_LAGS,
                windows: tuple[int, ...] = HOURLY_WINDOWS, at: Layout = HOURLY) -> DataFrame:
    """Lags and moving averages in one pass over the blocks."""
    return over_rows(df, at, max((*lags, *windows)), 0,
                     lambda w: {**lag_columns(w, target, lags), **past_columns(w, target, windows)}, past_runs(target, windows, at))


def rolling_columns(w: WindowSpec, col: str, n: int, least: int, prefix: str | None = None) -> dict[str, Column]:
    frame, prefix = w.rowsBetween(-(n - 1), 0), prefix or col
    return {f"{prefix}_roll{n}_mean": guarded(F.avg(col), col, frame, least),
            f"{prefix}_roll{n}_std": guarded(F.stddev_samp(col), col, frame, least)}


def rolling_stats(df: DataFrame, col: str, specs: tuple[tuple[int, int], ...], at: Layout = DAILY,
                  prefix: str | None = None) -> DataFrame:
    """Mean and sample deviation of the last n rows, the current one included, from ``least`` valid ones on."""
    def make(w: WindowSpec) -> dict[str, Column]:
        return {k: e for n, least in specs for k, e in rolling_columns(w, col, n, least, prefix).items()}
    return over_rows(df, at, max(n for n, _ in specs) - 1, 0, make)


def deviation(df: DataFrame, col: str, n: int = 7, least: int = 3, at: Layout = DAILY, name: str = "pm_dev7") -> DataFrame:
    """Distance of the current value from its trailing mean."""
    return over_rows(df, at, n - 1, 0, lambda w: {
        name: F.col(col) - guarded(F.avg(col), col, w.rowsBetween(-(n - 1), 0), least)})


def rolling_full(df: DataFrame, col: str, windows: tuple[int, ...], at: Layout = HOURLY) -> DataFrame:
    """Moving averages that are NULL until the window holds only valid values."""
    return over_rows(df, at, max(windows) - 1, 0, lambda w: {
        f"{col}_ma{n}": guarded(F.avg(col), col, w.rowsBetween(-(n - 1), 0), n) for n in windows})


def next_label(df: DataFrame, col: str = TARGET, at: Layout = DAILY) -> DataFrame:
    """Category of the next row of the station."""
    return over_rows(df, at, 0, 1, lambda w: {"y": F.lead(category_ordinal(F.col(col))).over(w)})


def smoothing_std(df: DataFrame, col: str = TARGET, n: int = 24, at: Layout = HOURLY) -> DataFrame:
    """Sample deviation of the series and of its moving average, per station."""
    ma = rolling_full(df.select(at.key, at.ts, col), col, (n,), at)
    return ma.groupBy(at.key).agg(F.stddev_samp(col).alias("raw_std"), F.stddev_samp(f"{col}_ma{n}").alias("ma_std"))


def date_slice(df: DataFrame, lo: str, hi: str, ts: str = TS) -> DataFrame:
    """Rows between two days, both included whole; the bound reaches the file scan."""
    return df.where((F.col(ts) >= F.lit(lo).cast(clock.NTZ))
                    & (F.col(ts) < F.lit(hi).cast(clock.NTZ) + F.expr("INTERVAL 1 DAY")))


def build_features(df: DataFrame, target: str = TARGET, lags: tuple[int, ...] = HOURLY_LAGS,
                   windows: tuple[int, ...] = HOURLY_WINDOWS, do_impute: bool = True, do_cap: bool = True,
                   fences: DataFrame | None = None, at: Layout = HOURLY) -> DataFrame:
    """clean, impute, cap, calendar, lags, moving averages.

    Fences are fitted on the imputed data unless a stored table is given. The imputed series is written to
    the shared folder, so this runs a job.
    """
    df = clean(df)
    if do_impute:
        df = impute(df, at=at)
    # fences, positions and features all read the filled series: write it once instead of filling it thrice
    df = settle(df)
    if do_cap:
        cols = tuple(c for c in (target, *CAPPED[1:]) if c in df.columns)
        df = cap_outliers(df, fences if fences is not None else fit_fences(df, cols), cols)
    return add_history(add_time_features(df, at.ts), target, lags, windows, at)
