"""Gap filling per station. A station's outage never reaches another station's series."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from hazegrid.constants import CHANNELS, WIND
from hazegrid.functions.clock import truncate
from hazegrid.operators.ordered import DAILY, HOURLY, Layout, with_neighbours


def interpolate_time(df: DataFrame, cols: list[str], limit: int = 6, at: Layout = HOURLY) -> DataFrame:
    """Fills cells at most ``limit`` rows after the previous or before the next valid one, linear in time;
    before the first and after the last valid cell the nearest one is taken."""
    rows = with_neighbours(df, cols, at)
    return _replace(rows, df, {c: f"coalesce(`{c}`, IF({_near(c, limit)}, {_on_line(c, '_us')}, NULL))" for c in cols})


def _near(c: str, limit: int) -> str:
    return f"coalesce(_pos - _p_{c}.i <= {limit}, false) OR coalesce(_n_{c}.i - _pos <= {limit}, false)"


def _on_line(c: str, time: str) -> str:
    """Straight line in time between the valid neighbours; where one is missing, the other's value."""
    p, n = f"_p_{c}", f"_n_{c}"
    return f"coalesce({p}.x + ({n}.x - {p}.x) * ({time} - {p}.t) / ({n}.t - {p}.t), {p}.x, {n}.x)"


def _replace(rows: DataFrame, like: DataFrame, done: dict[str, str]) -> DataFrame:
    return rows.select(*[F.expr(done[c]).alias(c) if c in done else F.col(c) for c in like.columns])


def ffill_bfill(df: DataFrame, cols: list[str], at: Layout = HOURLY, default: dict[str, str] | None = None) -> DataFrame:
    """Last valid value so far, before the first valid cell that one, else the default (if any).

    After the forward fill only the cells before the first valid one are open, so the backward fill is
    that one value per station.
    """
    rows = with_neighbours(df, cols, at, ahead=[])
    return _replace(rows, df, {c: _carried(c, (default or {}).get(c)) for c in cols})


def _carried(c: str, default: str | None = None) -> str:
    last = f", '{default}'" if default is not None else ""
    return f"coalesce(`{c}`, _p_{c}.x, _o_{c}.x{last})"


def fill_categorical(df: DataFrame, col: str = WIND, default: str = "N", at: Layout = HOURLY) -> DataFrame:
    return ffill_bfill(df, [col], at, {col: default})


def impute(df: DataFrame, short_gap: int = 6, at: Layout = HOURLY) -> DataFrame:
    """Time interpolation near valid cells, then forward and backward fill; wind direction is carried
    forward, then backward, then 'N'.

    One pass: inside a long gap the forward fill repeats the value of the row ``short_gap`` rows after the
    last valid one, so its time is kept with that reading and the line is read there.
    """
    numeric = [c for c in CHANNELS if c in df.columns]
    rest = [WIND] if WIND in df.columns else []
    rows = with_neighbours(df, numeric + rest, at, ahead=numeric, reach=short_gap)
    done = {c: f"coalesce(`{c}`, {_on_line(c, f'IF({_near(c, short_gap)}, _us, _p_{c}.r)')})" for c in numeric}
    return _replace(rows, df, done | {c: _carried(c, "N") for c in rest})


def interpolate_linear(df: DataFrame, col: str, at: Layout = HOURLY) -> DataFrame:
    """Linear in the row position, forward only: leading gaps stay, trailing ones take the last value."""
    p, n = f"_p_{col}", f"_n_{col}"
    line = f"coalesce({p}.x + ({n}.x - {p}.x) * (_pos - {p}.i) / ({n}.i - {p}.i), {p}.x)"
    return _replace(with_neighbours(df, [col], at), df, {col: f"coalesce(`{col}`, IF({p} IS NULL, NULL, {line}))"})


def resample_daily(df: DataFrame, col: str, at: Layout = HOURLY) -> DataFrame:
    """Daily mean for every day between a station's first and last one; days without a row are NULL."""
    day = truncate("day", F.col(at.ts))
    means = df.groupBy(at.key, day.alias(DAILY.ts)).agg(F.avg(col).alias(col))
    span = means.groupBy(at.key).agg(F.min(DAILY.ts).alias("_lo"), F.max(DAILY.ts).alias("_hi"))
    grid = span.select(at.key, F.explode(F.sequence("_lo", "_hi", F.expr("INTERVAL 1 DAY"))).alias(DAILY.ts))
    return grid.join(means, [at.key, DAILY.ts], "left")
