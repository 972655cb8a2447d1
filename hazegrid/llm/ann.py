"""Approximate nearest neighbours by a forest of random-projection trees.

The trees are grown on a bounded sample; every row is put into one leaf of each tree. A query walks all trees through
one priority queue, nearest splitting plane first, until the leaves it has met hold enough rows. Queries meet rows leaf
by leaf, in blocks of bounded size, where distances are computed exactly; the k best of all leaves are the result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazegrid.llm.common import keep

#: Rows that the trees are grown on at most (those with the smallest hash of the id), and of these in a leaf at most.
SAMPLE_ROWS, LEAF_ROWS, TREES = 20_000, 128, 4
#: A query meets leaves that hold this many times all rows, each row counted in every tree (all leaves: TREES times).
#: Vectors without structure, whose nearest neighbours are hardly nearer than the rest, need as much for a recall of 0.95.
SEARCH_SHARE = 1.3
#: Rows and queries of a block.
ROW_BLOCK, QUERY_BLOCK = 4096, 1024


@dataclass
class Tree:
    """Inner node i: plane and cut; left and right are nodes, or leaves as -1 - leaf."""
    planes: np.ndarray
    cuts: np.ndarray
    left: np.ndarray
    right: np.ndarray
    leaves: int

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), np.int64) if len(self.cuts) else np.full(len(x), -1)
        while (inner := np.flatnonzero(at >= 0)).size:
            n = at[inner]
            below = np.einsum("ij,ij->i", x[inner], self.planes[n]) <= self.cuts[n]
            at[inner] = np.where(below, self.left[n], self.right[n])
        return -1 - at


def grow(sample: np.ndarray, leaf_rows: int, seed: int) -> Tree:
    """A tree whose planes lie across the line through two random rows of the node, at the median."""
    pick = np.random.RandomState(seed)
    planes, cuts, left, right = [], [], [], []
    leaves = 0

    def node(rows: np.ndarray) -> int:
        nonlocal leaves
        if len(rows) > leaf_rows:
            for _ in range(8):
                a, b = pick.choice(rows, 2, replace=False)
                plane = sample[a] - sample[b]
                size = float(np.linalg.norm(plane))
                if not size:
                    continue
                at = sample[rows] @ (plane / size)
                cut = float(np.median(at))
                below = at <= cut
                if 0 < below.sum() < len(rows):
                    here = len(cuts)
                    planes.append(plane / size), cuts.append(cut), left.append(0), right.append(0)
                    left[here], right[here] = node(rows[below]), node(rows[~below])
                    return here
        leaves += 1
        return -leaves

    node(np.arange(len(sample)))
    dim = sample.shape[1] if sample.ndim == 2 else 0
    return Tree(np.array(planes).reshape(-1, dim), np.array(cuts), np.array(left, np.int64), np.array(right, np.int64), leaves)


def walk(trees: list[Tree], held: np.ndarray, q: np.ndarray, enough: float) -> list[tuple[int, int]]:
    """(tree, leaf) pairs for one query, nearest planes first, until they hold ``enough`` rows."""
    queue: list[tuple[float, int, int]] = [(0.0, k, 0 if len(t.cuts) else -1) for k, t in enumerate(trees)]
    heapq.heapify(queue)
    found, rows = [], 0
    while queue and rows < enough:
        far, k, at = heapq.heappop(queue)
        tree = trees[k]
        while at >= 0:
            margin = float(tree.planes[at] @ q - tree.cuts[at])
            near, other = (tree.left[at], tree.right[at]) if margin <= 0 else (tree.right[at], tree.left[at])
            heapq.heappush(queue, (far + margin * margin, k, int(other)))
            at = near
        found.append((k, int(-1 - at)))
        rows += int(held[k, -1 - at])
    return found


def usable(id_col: str, vector_col: str) -> Column:
    """No null id; a vector without null or non-finite components and not all zero."""
    fine = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & fine & F.exists(vector_col, lambda x: x != 0)


def _vectors(batch: pa.RecordBatch, dim: int) -> np.ndarray:
    return batch.column("v").flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, dim)


def nearest(base: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
            trees: int = TREES, sample_rows: int = SAMPLE_ROWS, leaf_rows: int = LEAF_ROWS, share: float = SEARCH_SHARE,
            row_block: int = ROW_BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """The k nearest rows of ``base`` found for each row of ``queries``: query_id, rank, id, score (Euclidean distance).

    A row is no neighbour of a query with the same id. Ties go to the smaller id; all candidates come if there are
    fewer than k. Rows with a null id or with a vector that is null, zero, or has null or non-finite components take no
    part, nor do vectors that are not of the most frequent length (of equally frequent ones the longest). Repeated rows
    count once. Other columns are ignored; empty tables give an empty result.
    """
    spark = base.sparkSession
    kind = base.schema[id_col].dataType.simpleString()

    def cleaned(df: DataFrame) -> DataFrame:
        return (df.select(df[id_col].alias("id"), df[vector_col].cast("array<double>").alias("v")).where(usable("id", "v")))

    rows = keep(cleaned(base), "vectors")
    asked = keep(cleaned(queries), "asked")
    common = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    empty = spark.createDataFrame([], f"query_id {kind}, rank int, `{id_col}` {kind}, score double")
    if common is None:
        return empty
    dim = common.d
    rows, asked = rows.where(F.size("v") == dim), asked.where(F.size("v") == dim)
    # Of equal vectors only the k + 1 smallest ids can be among the k nearest, the query's own id aside.
    same = Window.partitionBy("v").orderBy("id")
    rows = keep(rows.withColumn("n", F.dense_rank().over(same)).where(F.col("n") <= k + 1).select("id", "v").distinct(), "base")

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes() for x in _vectors(batch, dim)], pa.binary())], ["x"])

    sample = rows.orderBy(F.xxhash64("id"), "id", "v").limit(sample_rows).select("v").mapInArrow(packed, "x binary").collect()
    points = np.array([np.frombuffer(r.x) for r in sample]).reshape(-1, dim)
    forest = [grow(points, leaf_rows, seed) for seed in range(trees)]

    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _vectors(batch, dim)
            for number, tree in enumerate(forest):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), number, np.int32)), pa.array(tree.leaf_of(x).astype(np.int32)),
                     batch.column("id"), batch.column("v")], ["tree", "leaf", "id", "v"])

    index = keep(rows.mapInArrow(indexed, f"tree int, leaf int, id {kind}, v array<double>"), "index")
    held = np.zeros((trees, max(t.leaves for t in forest)), np.int64)  # as many entries as the sample gives leaves
    for r in index.groupBy("tree", "leaf").count().collect():
        held[r["tree"], r["leaf"]] = r["count"]
    enough = max(share * int(held[0].sum()), trees * 20 * k)

    def walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _vectors(batch, dim)
            for at in range(0, len(x), 64):
                hits = [(at + i, *p) for i, q in enumerate(x[at:at + 64]) for p in walk(forest, held, q, enough)]
                of = pa.array([h[0] for h in hits], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([h[1] for h in hits], pa.int32()), pa.array([h[2] for h in hits], pa.int32()),
                     batch.column("id").take(of), batch.column("v").take(of)], ["tree", "leaf", "id", "v"])

    probes = keep(asked.distinct().mapInArrow(walked, f"tree int, leaf int, id {kind}, v array<double>"), "probes")
    # Blocks of bounded size: a leaf's rows are dealt by hash, and so are the queries that meet it.
    blocks = (index.groupBy("tree", "leaf").agg(F.ceil(F.count(F.lit(1)) / row_block).cast("int").alias("row_blocks"))
              .join(probes.groupBy("tree", "leaf").agg(F.ceil(F.count(F.lit(1)) / query_block).cast("int").alias("query_blocks")),
                    ["tree", "leaf"]))
    blocks = keep(blocks, "blocks")  # one row per leaf at most
    by = F.pmod(F.xxhash64("id", "v"), F.lit(1 << 30))
    left = (probes.join(F.broadcast(blocks), ["tree", "leaf"]).withColumn("qb", (by % F.col("query_blocks")).cast("int"))
            .withColumn("rb", F.explode(F.sequence(F.lit(0), F.col("row_blocks") - 1))).drop("row_blocks", "query_blocks"))
    right = (index.join(F.broadcast(blocks), ["tree", "leaf"]).withColumn("rb", (by % F.col("row_blocks")).cast("int"))
             .withColumn("qb", F.explode(F.sequence(F.lit(0), F.col("query_blocks") - 1))).drop("row_blocks", "query_blocks"))

    def rank_block(q: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(q) and len(r):
            x, ids = np.stack(r["v"].to_numpy()), r["id"].to_numpy()
            for qid, v in zip(q["id"].to_numpy(), q["v"].to_numpy()):
                far = np.sqrt(((x - v) ** 2).sum(1))
                far[ids == qid] = np.inf
                best = np.flatnonzero(far <= np.partition(far, min(k, len(far)) - 1)[min(k, len(far)) - 1])
                best = best[np.lexsort((ids[best], far[best]))][:k]
                out += [(qid, ids[i], far[i]) for i in best if far[i] < np.inf]
        return pd.DataFrame(out, columns=["query_id", "id", "score"])

    keys = ["tree", "leaf", "rb", "qb"]
    found = (left.groupBy(*keys).cogroup(right.groupBy(*keys))
             .applyInPandas(rank_block, f"query_id {kind}, id {kind}, score double"))
    found = found.groupBy("query_id", "id").agg(F.min("score").alias("score"))  # the same row met in several trees
    best = Window.partitionBy("query_id").orderBy("score", "id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", F.col("id").alias(id_col), "score"))
