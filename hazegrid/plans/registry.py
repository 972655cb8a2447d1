"""Query keys with their Spark function and check SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from hazegrid.plans.bindings import Tables, with_bindings


@dataclass(frozen=True)
class Query:
    run: Callable[[Tables], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(key: str, uses: str = "", sql: str | None = None):
    """Registers a function of ``Tables``; ``uses`` names the bindings the check SQL reads."""
    def add(fn: Callable[[Tables], DataFrame]):
        if key in REGISTRY:
            raise ValueError(f"query {key} is registered twice")
        REGISTRY[key] = Query(fn, with_bindings(uses.split(), sql) if sql else None)
        return fn
    return add


def load() -> dict[str, Query]:
    from hazegrid.plans import (q_aggregates, q_cleaning, q_documents, q_features, q_gaps, q_learning,  # noqa: F401
                                q_mutations, q_quality, q_sources, q_star)
    return REGISTRY


def runner(key: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: REGISTRY[key].run(Tables(spark, folder))
