"""Exact top-k search by inner product, block at a time.

Rows lie in blocks of consecutive rows of an order in which like rows are near each other. A block keeps its rows (its
forward index) and, per component ("term"), the largest and the smallest value. The sum over a query's components of
the better of the two is a bound on every score in the block. Blocks are visited by falling bound and scored whole, until
the bounds fall below the query's kth score. Queries come in groups and blocks in shards, both of bounded size: first each
query searches the shard with its highest bound, which gives a kth score; then only shards with a bound that reaches
it are searched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazegrid.llm.common import keep, small

#: Rows of a block and queries of a group; blocks of a shard; shards or groups that meet in one task's unit of work.
BLOCK, SHARD, UNIT = 256, 64, 16
#: Rows from which the order is fitted, at most; the order has no more parts than a 16th of them.
SAMPLE_ROWS = 20_000
_LIMIT = (1 << 63) - 1


def quantised(rows: DataFrame, scale: float, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Columns ``id`` and ``v`` (floor of ``scale`` times each component, limited to 64 bits). Vectors that are null or hold
    null or non-finite components are left out, and so are rows without an id."""
    v = F.col(vector_col)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    whole = F.transform(v, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    return rows.where(F.col(id_col).isNotNull() & v.isNotNull() & finite).select(F.col(id_col).cast("long").alias("id"), whole.alias("v"))


# ----------------------------------------------------------------- an order of rows

def fit_order(sample: np.ndarray, least: int = 16, depth: int = 12) -> list:
    """A binary tree (direction, threshold, below, above), halving the rows along the direction of largest spread."""
    if depth == 0 or len(sample) < 2 * least:
        return []
    centred = sample - sample.mean(0)
    direction = centred[np.argmax((centred ** 2).sum(1))]
    for _ in range(8):  # power iterations
        direction = centred.T @ (centred @ direction)
        size = np.sqrt((direction ** 2).sum())
        if not np.isfinite(size) or size == 0:
            return []
        direction = direction / size
    at = sample @ direction
    threshold = float(np.median(at))
    above = at > threshold
    if not above.any():
        return []
    return [direction, threshold, fit_order(sample[~above], least, depth - 1), fit_order(sample[above], least, depth - 1)]


def _leaves(tree: list, x: np.ndarray, rows: np.ndarray, out: np.ndarray, low: int, high: int) -> None:
    if not tree or not len(rows):
        out[rows] = low
        return
    direction, threshold, below, above = tree
    up, middle = x[rows] @ direction > threshold, (low + high) // 2
    _leaves(below, x, rows[~up], out, low, middle)
    _leaves(above, x, rows[up], out, middle, high)


def _sampled(rows: DataFrame, bound: int) -> list:
    """Up to ``bound`` rows by hash of the id, about as many from every task."""
    n = rows.count()
    part = 4.0 * bound / max(n, 1)  # more than enough; then the bound
    pick = F.pmod(F.xxhash64("id"), F.lit(1 << 30))
    some = rows.where(pick < min(part, 1.0) * (1 << 30)) if part < 1 else rows
    return some.orderBy(pick, "id").limit(bound).collect()


def with_order(rows: DataFrame, tree: list, dim: int) -> DataFrame:
    """Adds ``dim`` (length of the vector) and ``leaf``: the part of the tree for vectors of ``dim`` components, 0 for others."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = batch.column(1)
            sizes = np.diff(v.offsets.to_numpy())
            leaf, fits = np.zeros(len(v), np.int64), np.flatnonzero(sizes == dim)
            if tree and len(fits):
                x = v.flatten().to_numpy(zero_copy_only=False).astype(float)[np.repeat(sizes == dim, sizes)].reshape(-1, dim)
                found = np.zeros(len(fits), np.int64)
                _leaves(tree, x, np.arange(len(fits)), found, 0, 1 << 20)
                leaf[fits] = found
            yield pa.RecordBatch.from_arrays([batch.column(0), v, pa.array(sizes.astype(np.int64)), pa.array(leaf)], ["id", "v", "dim", "leaf"])

    return rows.select("id", "v").mapInArrow(run, "id long, v array<long>, dim long, leaf long")


# ----------------------------------------------------------------- blocks

def _pack(x: np.ndarray) -> tuple[int, bytes]:
    """The smallest of 2, 4 and 8 bytes a number that holds them, and the numbers."""
    most = max(int(x.max(initial=0)), -int(x.min(initial=0)))
    width = 2 if most < 1 << 15 else 4 if most < 1 << 31 else 8
    return width, x.astype(f"<i{width}").tobytes()


def _unpack(raw: bytes, width: int, dim: int, rows: int) -> np.ndarray:
    return np.frombuffer(raw, f"<i{width}").astype(np.int64).reshape(rows, dim)


def blocks_of(ordered: DataFrame, size: int) -> DataFrame:
    """Blocks of up to ``size`` consecutive rows with the same dimension: ids, values, and per component the largest and
    smallest value. ``number`` counts along the order, ``part`` names runs of SHARD blocks."""
    order = ["dim", "leaf", "id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["dim", "n", "width", "ids", "data", "top", "low"]

        def block(ids, dim, x):
            width, data = _pack(x)
            ends = (x.max(0), x.min(0)) if dim else (x[0], x[0])
            return pa.RecordBatch.from_arrays([pa.array([v]) for v in (dim, len(ids), width, ids.tobytes(), data, *(e.astype("<i8").tobytes() for e in ends))], names)

        held, now = [], None   # (ids, values) of the dimension ``now``
        for batch in batches:
            ids, dims = batch.column(0).to_numpy().astype("<i8"), batch.column(2).to_numpy()
            flat, at = batch.column(1).flatten().to_numpy(zero_copy_only=False), batch.column(1).offsets.to_numpy()
            cuts = [0, *(np.flatnonzero(dims[1:] != dims[:-1]) + 1).tolist(), len(ids)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                dim = int(dims[a])
                if now is not None and dim != now:
                    yield from (block(i, now, x) for i, x in held)
                    held = []
                ids_now, x = ids[a:b], flat[at[a] - at[0]:at[b] - at[0]].reshape(b - a, dim)
                if held:
                    (i, y), = held
                    ids_now, x = np.concatenate((i, ids_now)), np.concatenate((y, x))
                now, whole = dim, len(ids_now) // size * size
                yield from (block(ids_now[s:s + size], dim, x[s:s + size]) for s in range(0, whole, size))
                held = [(ids_now[whole:], x[whole:])] if whole < len(ids_now) else []
        yield from (block(i, now, x) for i, x in held)

    at = F.col("number")
    cut = (ordered.repartitionByRange(*order).sortWithinPartitions(*order).select("id", "v", "dim")
           .mapInArrow(run, "dim long, n long, width long, ids binary, data binary, top binary, low binary").withColumn("number", F.monotonically_increasing_id()))
    part = F.shiftleft(F.shiftrightunsigned(at, 33), 30) + F.floor(at.bitwiseAND((1 << 33) - 1) / SHARD)
    return keep(cut.withColumn("part", part), "blocks")


def bounds(q: np.ndarray, top: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Per query and block the largest score that the block's extremes allow (never too small)."""
    plus, minus = np.maximum(q, 0).astype(float), np.minimum(q, 0).astype(float)
    t, m = top.astype(float).T, low.astype(float).T
    out = plus @ t + minus @ m
    slack = plus @ np.abs(t) - minus @ np.abs(m)
    return out + np.where(slack < 1 << 52, 0.0, slack * 1e-9)  # sums below 2^53 are exact


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products, exact: in doubles where they fit, else in Python's integers, limited to 64 bits."""
    most = float(np.abs(q.astype(float)).max(initial=0)) * float(np.abs(x.astype(float)).max(initial=0)) * max(q.shape[1], 1)
    if most < 1 << 53:
        return (q.astype(float) @ x.astype(float).T).astype(np.int64)
    return np.clip(q.astype(object) @ x.astype(object).T, -_LIMIT - 1, _LIMIT).astype(np.int64)


class _Best:
    """The k best (score, id) of each query, as far as they are known; scores below ``floor`` are of no use."""

    def __init__(self, ids: np.ndarray, k: int, floor: np.ndarray):
        self.ids, self.k, self.kth = ids, k, floor.copy()
        self.found = [np.zeros((0, 3), np.int64)]   # query, -score, id

    def offer(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        usable = ids[None, :] != self.ids[rows][:, None]
        at = self.kth[rows]
        if scores.shape[1] > self.k:   # the kth of a block alone is a bound already
            masked = np.where(usable, scores.astype(float), -np.inf)
            at = np.maximum(at, np.partition(masked, -self.k, axis=1)[:, -self.k])
        x, y = np.nonzero(usable & (scores >= at[:, None]))
        if not len(x):
            return
        new = np.stack([rows[x], ~scores[x, y], ids[y]], 1)    # ~s falls as s rises, and has no overflow
        every = np.concatenate([*self.found, new])
        every = every[np.lexsort((every[:, 2], every[:, 1], every[:, 0]))]
        first = np.searchsorted(every[:, 0], every[:, 0])
        every = every[np.arange(len(every)) - first < self.k]
        self.found = [every]
        full = np.bincount(every[:, 0], minlength=len(self.ids)) >= self.k
        last = np.searchsorted(every[:, 0], np.flatnonzero(full), side="right") - 1
        self.kth[full] = np.maximum(self.kth[full], (~every[last, 1]).astype(float))


def search(ids: np.ndarray, q: np.ndarray, blocks: list[tuple], k: int, floor: np.ndarray) -> np.ndarray:
    """Rows (query number, score, id) of the best k of ``blocks`` (ids, values, top, low) for each query.

    Step j: every query whose bound on its jth best block still reaches its kth score scores that block; queries with
    the same block do so in one product.
    """
    best = _Best(ids, k, floor)
    limit = bounds(q, np.stack([b[2] for b in blocks]), np.stack([b[3] for b in blocks]))
    order = np.argsort(-limit, axis=1, kind="stable")
    live = np.arange(len(ids))
    for j in range(len(blocks)):
        live = live[limit[live, order[live, j]] >= best.kth[live]]
        if not len(live):
            break
        for b in np.unique(order[live, j]):
            rows = live[order[live, j] == b]
            best.offer(rows, products(q[rows], blocks[b][1]), blocks[b][0])
    every = best.found[0]
    return np.stack([every[:, 0], ~every[:, 1], every[:, 2]], 1)


# ----------------------------------------------------------------- the search in Spark

def _unit(col: str, units: Column | int) -> Column:
    return F.pmod(F.xxhash64(col), units)


def _named(columns: dict[str, tuple]) -> pa.Table:
    return pa.table({name: pa.array(values, kind) for name, (values, kind) in columns.items()})


def _bound_pairs(groups: DataFrame, shards: DataFrame, reach: bool) -> DataFrame:
    """Columns ``group``, ``pos``, ``shard`` and ``bound``, the shard's highest bound for the query: per query and unit of
    shards the best one only, or with ``reach`` all whose bound reaches the query's ``kth`` but the ``seed``."""
    n_groups, n_parts = groups.count(), shards.select("part").distinct().count()
    g_units, s_units = -(-n_groups // UNIT) or 1, -(-n_parts // UNIT) or 1
    more = ["kth", "seed"] if reach else []
    left = (groups.select("number", "dim", "n", "width", "data", *more).withColumn("g", _unit("number", F.lit(g_units)))
            .withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(s_units - 1)))))
    right = (shards.select("part", "dim", "top", "low").withColumn("s", _unit("part", F.lit(s_units)))
             .withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(g_units - 1)))))

    def run(queries: pa.Table, rows: pa.Table) -> pa.Table:
        out = [[], [], [], []]
        parts, row_dims = rows["part"].to_numpy(), rows["dim"].to_numpy()
        tops, lows = rows["top"].to_pylist(), rows["low"].to_pylist()
        for r in queries.to_pylist():
            at = np.flatnonzero(row_dims == r["dim"])
            if not len(at):
                continue
            at = at[np.argsort(parts[at], kind="stable")]
            top, low = (np.frombuffer(b"".join(c[i] for i in at), "<i8").reshape(len(at), r["dim"]) for c in (tops, lows))
            names, starts = np.unique(parts[at], return_index=True)
            limit = np.maximum.reduceat(bounds(_unpack(r["data"], r["width"], r["dim"], r["n"]), top, low), starts, axis=1)
            if reach:
                x, y = np.nonzero((limit >= np.array(r["kth"])[:, None]) & (names[None, :] != np.array(r["seed"])[:, None]))
            else:
                x, y = np.arange(r["n"]), limit.argmax(1)
            for column, values in zip(out, (np.full(len(x), r["number"]), x, names[y], limit[x, y])):
                column.append(values)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64())
        return _named({n: (np.concatenate(c) if c else [], kind) for n, c, kind in zip(("group", "pos", "shard", "bound"), out, kinds)})

    return left.groupBy("g", "s").cogroup(right.groupBy("g", "s")).applyInArrow(run, "group long, pos long, shard long, bound double")


def _searched(pairs: DataFrame, groups: DataFrame, shards: DataFrame, k: int) -> DataFrame:
    """The best k of each (query, shard) pair: columns group, pos, query_id, vec_id and score."""
    cells = keep(pairs.groupBy("group", "shard").agg(F.collect_list("pos").alias("rows")), "cells")  # up to BLOCK queries
    units = -(-groups.count() // UNIT) or 1
    cells = cells.withColumn("g", _unit("group", F.lit(units)))
    more = ["kth"] if "kth" in groups.columns else []
    left = cells.join(groups.select("number", "n", "width", "dim", "ids", "data", *more), F.col("group") == F.col("number"))
    wanted = keep(cells.select(F.col("shard").alias("part"), "g").distinct(), "wanted")
    right = shards.select("part", "n", "width", "dim", "ids", "data", "top", "low").join(small(wanted), "part")

    def run(queries: pa.Table, rows: pa.Table) -> pa.Table:
        def numbers(raw):
            return np.frombuffer(raw, "<i8")

        blocks: dict[int, list] = {}
        for b in rows.to_pylist():
            blocks.setdefault(b["dim"], []).append((numbers(b["ids"]), _unpack(b["data"], b["width"], b["dim"], b["n"]), numbers(b["top"]), numbers(b["low"])))
        out = [[], [], [], [], []]
        for r in queries.to_pylist():
            at = np.array(r["rows"])
            ids, q = numbers(r["ids"])[at], _unpack(r["data"], r["width"], r["dim"], r["n"])[at]
            floor = np.array(r["kth"])[at] if more else np.full(len(at), -np.inf)
            found = search(ids, q, blocks[r["dim"]], k, floor)
            for column, values in zip(out, (np.full(len(found), r["group"]), at[found[:, 0]], ids[found[:, 0]], found[:, 2], found[:, 1])):
                column.append(values)
        names = ("group", "pos", "query_id", "vec_id", "score")
        return _named({n: (np.concatenate(c) if c else [], pa.int64()) for n, c in zip(names, out)})

    return (left.groupBy("shard", "g").cogroup(right.groupBy(F.col("part").alias("shard"), "g"))
            .applyInArrow(run, "group long, pos long, query_id long, vec_id long, score long"))


def _best_of(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("group", "pos").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(rows: DataFrame, queries: DataFrame, k: int = 20, block: int = BLOCK, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row per query and rank: query_id, rank (from 1), vec_id and score, of ``rows`` and ``queries`` with ``id`` and
    integer vectors ``v`` (see ``quantised``).

    Exact: every row with the query's number of components and another id is a candidate, highest inner product first,
    ties to the smaller id; there may be fewer than k. The order is fitted on at most ``sample_rows`` rows and decides
    only how much is skipped; all rows are in the index. Rows with equal ids are candidates each, and repeated queries
    are answered each. Scores beyond 64 bits are limited to them. Empty tables give an empty result.
    """
    rows = keep(rows.select("id", "v"), "vectors")
    sample = _sampled(rows, sample_rows)
    lengths = [len(r["v"]) for r in sample]
    dim = max(set(lengths), key=lengths.count) if sample else 0
    tree = fit_order(np.array([r["v"] for r in sample if len(r["v"]) == dim], float)) if dim else []
    shards = blocks_of(with_order(rows, tree, dim), block)
    groups = blocks_of(with_order(queries, tree, dim), block)

    best = keep(_bound_pairs(groups, shards, False).groupBy("group", "pos").agg(F.max_by("shard", F.struct("bound", "shard")).alias("shard")), "seeds")
    first = keep(_best_of(_searched(best, groups, shards, k), k), "first")
    known = first.groupBy("group", "pos").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("kth"))
    state = best.join(known, ["group", "pos"], "left").select(
        "group", F.struct("pos", F.coalesce(F.col("kth").cast("double"), F.lit(float("-inf"))).alias("kth"), "shard").alias("s"))
    lists = state.groupBy("group").agg(F.sort_array(F.collect_list("s")).alias("s"))  # one entry per query of the group
    told = keep(groups.join(lists, F.col("number") == F.col("group")).select(*groups.columns, F.col("s.kth").alias("kth"), F.col("s.shard").alias("seed")), "told")
    rest = _searched(_bound_pairs(told, shards, True), told, shards, k)
    found = _best_of(first.drop("rank").unionByName(rest), k)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
