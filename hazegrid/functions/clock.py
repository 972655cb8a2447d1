"""Time expressions on zone-free timestamps."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

from hazegrid.constants import HEATING_MONTHS, SEASONS
from hazegrid.functions.category import named

NTZ = "timestamp_ntz"
EPOCH = "1970-01-01 00:00:00"


def truncate(unit: str, ts: Column) -> Column:
    """``date_trunc`` that stays zone-free (the built-in one returns a zoned timestamp)."""
    return F.date_trunc(unit, ts).cast(NTZ)


def seconds_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("SECOND", start, end)


def is_heating(ts: Column) -> Column:
    return F.month(ts).isin(*HEATING_MONTHS).cast("int")


def is_weekend(ts: Column) -> Column:
    return (F.weekday(ts) >= 5).cast("int")


def season(ts: Column) -> Column:
    return named(F.floor((F.month(ts) % 12) / 3).cast("int"), SEASONS)


def cycle(part: Column, period: float) -> tuple[Column, Column]:
    """Sine and cosine of a position in a cycle, so that its two ends are neighbours."""
    angle = F.lit(2 * math.pi) * part / F.lit(float(period))
    return F.sin(angle), F.cos(angle)
