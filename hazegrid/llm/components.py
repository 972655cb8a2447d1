"""Connected components of a graph given as edges, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazegrid.llm.common import keep


def _min_neighbour(arcs: DataFrame) -> DataFrame:
    """Arcs (a, b) with the smallest node among a and its neighbours (``m``). The sums are made before the shuffle."""
    least = arcs.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return arcs.join(least, "a")


def components(edges: DataFrame) -> DataFrame:
    """Columns ``node`` and ``root`` (smallest node reachable) for every node that has an edge (a, b).

    Every round is a join and two aggregations, written to the shared folder; rounds go on until nothing changes.
    The number of edges never grows. A node with very many edges is a skewed join key, which Spark splits.
    """
    edges = keep(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = (_min_neighbour(both).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .where("a <> b").distinct())
        large = keep(large, "large")
        joined = _min_neighbour(large)                       # every arc goes from the larger to the smaller node
        small = (joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(joined.select("a", F.col("m").alias("b"))).where("a <> b").distinct())
        edges = keep(small, "edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(now) == state or not now[0]:
            break
        state = tuple(now)
    leaves = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return leaves.union(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
