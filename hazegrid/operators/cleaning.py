"""From raw text rows to one clean reading per station and hour."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window, functions as F

from hazegrid.constants import CHANNELS, CLOCK_PARTS, POLLUTANTS, STATION, TS


def add_datetime(df: DataFrame, strict: bool = True) -> DataFrame:
    """``ts`` from year, month, day and hour. Impossible parts fail the job, or give NULL if not strict."""
    make = F.make_timestamp_ntz if strict else F.try_make_timestamp_ntz
    parts = [F.col(c).cast("int") for c in CLOCK_PARTS]
    return df.withColumn(TS, make(*parts, F.lit(0), F.lit(0).cast("decimal(16,6)")))


def as_number(c: Column) -> Column:
    """Text to DOUBLE; text that is no number, and NaN, become NULL."""
    text = F.trim(c.cast("string"))
    v = text.try_cast("double")
    # Java also reads '1d' and '1f' as numbers, but 'inf' is one
    suffixed = F.lower(F.substring(text, -1, 1)).isin("d", "f") & (F.abs(v) != float("inf"))
    return F.when(v.isNotNull() & ~F.isnan(v) & ~suffixed, v)


def coerce_numeric(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    kinds = dict(df.dtypes)
    done = {}
    for c in cols:
        col = F.col(c)
        if kinds[c] in ("double", "float"):
            done[c] = F.when(~F.isnan(col), col.cast("double"))
        elif kinds[c] == "string":
            done[c] = as_number(col)
        else:
            done[c] = col.cast("double")
    return df.withColumns(done)


def null_negatives(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Negative concentrations, wind speeds and rainfall cannot be; they become missing."""
    return df.withColumns({c: F.when(F.col(c) >= 0, F.col(c)) for c in cols})


def dedup_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Keeps the first row of each key in the given order.

    ``row_number() = 1`` runs as a group limit on both sides of the shuffle, so a key that holds a
    third of all rows sends one row per input task. End ``order`` with enough columns to be total.
    """
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def clean(df: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Time, numbers, impossible negatives, one row per (station, ts).

    ``order`` says which of several rows of an hour came first; by default the row label ``no``, then
    all other columns, so that the result does not depend on how the input is split.
    """
    if TS not in df.columns:
        df = add_datetime(df)
    present = [c for c in CHANNELS if c in df.columns]
    df = coerce_numeric(df, present)
    df = null_negatives(df, [c for c in present if c in (*POLLUTANTS, "wspm", "rain")])
    if order is None:
        lead = ["no"] if "no" in df.columns else []
        order = lead + [c for c in df.columns if c not in (*lead, STATION, TS)]
    return dedup_first(df, [STATION, TS], order)
