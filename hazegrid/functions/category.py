"""Air-quality bands and class helpers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from hazegrid.constants import CATEGORIES, CATEGORY_EDGES, N_CLASSES


def category_ordinal(value: Column) -> Column:
    """0..5 by band; negative or missing gives NULL; an upper edge belongs to its band."""
    e = F.when(value.isNull() | F.isnan(value) | (value < 0), F.lit(None).cast("int"))
    for i, edge in enumerate(CATEGORY_EDGES):
        e = e.when(value <= edge, F.lit(i))
    return e.otherwise(F.lit(len(CATEGORY_EDGES)))


def named(ordinal: Column, names: tuple[str, ...]) -> Column:
    """The name of a number 0, 1, ...; NULL for NULL (``element_at`` on a literal array gives a name then)."""
    return reduce(lambda e, i: e.when(ordinal == i, names[i]), range(1, len(names)), F.when(ordinal == 0, names[0]))


def category_label(ordinal: Column) -> Column:
    return named(ordinal, CATEGORIES)


def category(value: Column) -> Column:
    """Band name of a value."""
    return category_label(category_ordinal(value))


def argmax(columns: list[Column]) -> Column:
    """Index of the largest column; ties go to the lowest index."""
    best = F.greatest(*columns)
    e = F.when(columns[0] == best, F.lit(0))
    for i, c in enumerate(columns[1:], start=1):
        e = e.when(c == best, F.lit(i))
    return e


def probabilities() -> list[str]:
    return [f"p{c}" for c in range(N_CLASSES)]
