"""Near-duplicate documents by SimHash fingerprints, compared in tiles.

Equal fingerprints are one class from the start. The classes are dealt to buckets that pairs within the radius share,
each bucket is cut into tiles ordered by population count, and tiles are compared with NumPy (exclusive or, bit
counts); tile pairs whose population counts differ beyond the radius are skipped. What a task finds is reduced to a
spanning forest, so no group of copies is expanded into its pairs. Links become groups by connected components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hazegrid.llm.common import internal, keep, small, of_this_worker
from hazegrid.llm.components import components

#: Fingerprints of a tile, and of a step inside a tile.
TILE, STEP = 4096, 512
SEED = 42


def shingle_hashes(raw: bytes, words: int) -> np.ndarray:
    """XXH64 of every run of ``words`` words of a text in which A-Z are lower-cased; the whole text if it is shorter."""
    found = raw.lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    joined = b" ".join(found)
    if len(found) <= words:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    size = np.fromiter(map(len, found), np.int64, len(found))
    end = np.cumsum(size + 1) - 1
    start = (end - size)[:len(found) - words + 1].tolist()
    h = xxhash.xxh64_intdigest
    return np.array([h(joined[a:b], SEED) for a, b in zip(start, end[words - 1:].tolist())], np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """A bit is 1 if set in over half the hashes. No hashes: zero."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = np.ascontiguousarray(hashes[at:at + (1 << 16)]).astype("<u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """Columns ``id``, ``text_hash`` and ``fp`` (big-endian bytes) of every row; a null text has no words."""
    frame = internal(docs, id=id_col, text_hash=F.xxhash64(docs[text_col]), text=docs[text_col].cast("binary"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_this_worker("simhash")
        for batch in batches:
            found = [fingerprint(shingle_hashes(t.as_py() or b"", words)).to_bytes(8, "big") for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.binary())],
                                             ["id", "text_hash", "fp"])

    return frame.mapInArrow(run, StructType([frame.schema["id"], frame.schema["text_hash"]]).add("fp", "binary"))


def exact_blocks(bits: int, radius: int) -> list[list[int]]:
    """Bits dealt into radius + 1 blocks: two fingerprints within the radius agree on one of them at least."""
    return [list(map(int, b)) for b in np.array_split(np.arange(bits), radius + 1)]


def _bucketed(classes: DataFrame, blocks: list[list[int]]) -> DataFrame:
    """One row per fingerprint and block: block, key (the block's bits), pop (bits set) and fp."""
    places = [(np.array([63 - b for b in block]), len(block)) for block in blocks]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_this_worker("simhash")
        for batch in batches:
            fp = batch.column(0)
            bits = np.unpackbits(np.frombuffer(b"".join(fp.to_pylist()), np.uint8).reshape(-1, 8), axis=1)
            pop = pa.array(bits.sum(1, dtype=np.int32))
            for number, (where, width) in enumerate(places):
                key = bits[:, where].astype(np.int64) @ (np.int64(1) << np.arange(width, dtype=np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(fp), number, np.int32)), pa.array(key), pop, fp],
                                                 ["block", "key", "pop", "fp"])

    return classes.select("fp").mapInArrow(run, "block int, key long, pop int, fp binary")


def _tiled(rows: DataFrame, radius: int, tile: int) -> DataFrame:
    """Rows with the tile pairs (ti <= tj) they take part in, and their own tile.

    A bucket of up to ``tile`` rows is one tile. The rows of a larger one are ranked by population count through counts
    per (bucket, pop), of which a bucket has at most as many as a fingerprint has bits; within one count the place comes
    from a hash. A row goes only to pairs with tiles that hold population counts within the radius of its own.
    """
    large = rows.groupBy("block", "key").agg(F.count(F.lit(1)).alias("total")).where(F.col("total") > tile)
    large = keep(large.select(F.col("block").alias("l_block"), F.col("key").alias("l_key")), "large")  # rows / tile at most
    bucket = Window.partitionBy("l_block", "l_key")
    upto = bucket.orderBy("l_pop").rowsBetween(Window.unboundedPreceding, -1)
    near = bucket.orderBy("l_pop").rangeBetween(-radius, radius)
    inside = rows.join(small(large), (F.col("block") == F.col("l_block")) & (F.col("key") == F.col("l_key")))
    sizes = (inside.groupBy("l_block", "l_key", F.col("pop").alias("l_pop")).agg(F.count(F.lit(1)).alias("n"))
             .withColumn("before", F.coalesce(F.sum("n").over(upto), F.lit(0)))
             .withColumn("lo", F.min("before").over(near)).withColumn("hi", F.max(F.col("before") + F.col("n")).over(near)))
    sizes = keep(sizes, "sizes")
    same = (F.col("block") == F.col("l_block")) & (F.col("key") == F.col("l_key")) & (F.col("pop") == F.col("l_pop"))
    place = F.pmod(F.xxhash64("fp"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    whole = F.col("l_pop").isNull()

    def number(x):
        return F.when(whole, 0).otherwise(F.floor(x / tile).cast("int"))

    return (rows.join(small(sizes), same, "left")
            .withColumn("tile", number(F.col("before") + place * F.col("n")))
            .withColumn("other", F.explode(F.sequence(number(F.col("lo")), number(F.col("hi") - 1))))
            .select("block", "key", F.least("tile", "other").alias("ti"), F.greatest("tile", "other").alias("tj"),
                    "tile", "pop", "fp"))


def spanning(pairs: np.ndarray) -> np.ndarray:
    """Of pairs of numbers, a spanning forest: pairs that join the same numbers together. The union of two forests
    has a forest of all their pairs."""
    pairs = pairs[pairs[:, 0] != pairs[:, 1]]
    if not len(pairs):
        return pairs
    nodes, where = np.unique(pairs, return_inverse=True)
    a, b = where.reshape(-1, 2).T
    label, live, taken = np.arange(len(nodes)), np.arange(len(pairs)), []
    while len(live := live[label[a[live]] != label[b[live]]]):
        best = np.full(len(nodes), len(pairs))
        for end in (a, b):                       # every component takes its first pair to another one
            np.minimum.at(best, label[end[live]], live)
        found = np.unique(best[best < len(pairs)])
        taken.append(found)
        while True:                              # the components that now belong together take the smallest label
            low = np.minimum(label[a[found]], label[b[found]])
            root = np.arange(len(nodes))
            np.minimum.at(root, label[a[found]], low)
            np.minimum.at(root, label[b[found]], low)
            if (root == np.arange(len(nodes))).all():
                break
            label = root[label]
    return pairs[np.sort(np.concatenate(taken))]


class _Forest:
    """Pairs as they are found, reduced to a spanning forest whenever there are many."""

    def __init__(self, most: int = 1 << 20):
        self.pairs, self.held, self.most = [], 0, most

    def add(self, pairs: np.ndarray) -> None:
        self.pairs.append(pairs)
        self.held += len(pairs)
        if self.held > self.most:
            self.pairs, self.held = [self.result()], 0

    def result(self) -> np.ndarray:
        return spanning(np.concatenate(self.pairs)) if self.pairs else np.zeros((0, 2), np.int64)


def _compare(fp: np.ndarray, pop: np.ndarray, left: np.ndarray, right: np.ndarray, radius: int, found: _Forest) -> None:
    """Adds pairs of row numbers within the radius; left and right are row numbers ordered by population count."""
    same = left is right
    for i in range(0, len(left), STEP):
        a = left[i:i + STEP]
        for j in range(i if same else 0, len(right), STEP):
            b = right[j:j + STEP]
            if pop[b[0]] - pop[a[-1]] > radius or pop[a[0]] - pop[b[-1]] > radius:
                continue
            x, y = np.nonzero(np.bitwise_count(fp[a][:, None] ^ fp[b][None, :]) <= radius)
            if same and i == j:
                x, y = x[x < y], y[x < y]
            if len(x):
                found.add(np.stack([a[x], b[y]], 1))


def links(classes: DataFrame, radius: int, blocks: list[list[int]], tile: int = TILE) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints within the radius: of all that a batch of a task finds, a spanning forest."""
    tiled = _tiled(_bucketed(classes, blocks), radius, tile)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_this_worker("simhash")
        def settle(columns):
            group, ti, tj, own, pop, name = columns
            fp = np.frombuffer(b"".join(name), ">u8").astype(np.uint64)
            cut = np.flatnonzero(np.any(group[1:] != group[:-1], axis=1)) + 1
            starts, ends = np.concatenate(([0], cut)), np.concatenate((cut, [len(pop)]))
            small = (ends - starts <= 64) & (ti[starts] == tj[starts])
            mark = np.repeat(np.where(small, np.arange(len(starts)), -1), ends - starts)
            found = _Forest()
            for d in range(1, int((ends - starts)[small].max(initial=1))):  # all small groups at once
                at = np.flatnonzero((mark[d:] == mark[:-d]) & (mark[d:] >= 0) & (pop[d:] - pop[:-d] <= radius))
                at = at[np.bitwise_count(fp[at] ^ fp[at + d]) <= radius]
                found.add(np.stack([at, at + d], 1))
            for s, e in zip(starts[~small], ends[~small]):
                every = np.arange(s, e)
                if ti[s] == tj[s]:
                    _compare(fp, pop, every, every, radius, found)
                else:
                    left, right = every[own[s:e] == ti[s]], every[own[s:e] == tj[s]]
                    if len(left) and len(right):
                        _compare(fp, pop, left, right, radius, found)
            pairs = found.result()
            if len(pairs):
                rows_in = np.unique(pairs)
                nodes, where = np.unique(name[rows_in], return_inverse=True)  # a fingerprint stands in many blocks
                number = np.zeros(len(pop), np.int64)
                number[rows_in] = where.reshape(-1)
                ends = spanning(np.unique(np.sort(number[pairs], axis=1), axis=0))
                yield pa.RecordBatch.from_arrays([pa.array(nodes[col].tolist(), pa.binary()) for col in ends.T], ["a", "b"])

        rest = None
        for batch in batches:
            if not batch.num_rows:
                continue
            c = {n: batch.column(n) for n in batch.schema.names}
            num = {n: c[n].to_numpy(zero_copy_only=False) for n in ("block", "key", "ti", "tj", "tile", "pop")}
            now = (np.stack([num["block"], num["key"], num["ti"], num["tj"]], 1).astype(np.int64), num["ti"], num["tj"],
                   num["tile"], num["pop"].astype(np.int64), np.array(c["fp"].to_pylist(), object))
            if rest is not None:
                now = tuple(np.concatenate((x, y)) for x, y in zip(rest, now))
            last = int(np.argmax((now[0] == now[0][-1]).all(1)))  # where the last group, maybe not whole yet, begins
            if last:
                yield from settle([x[:last] for x in now])
            rest = tuple(x[last:] for x in now)
        if rest is not None:
            yield from settle(rest)

    keys = ["block", "key", "ti", "tj"]
    return tiled.repartition(*keys).sortWithinPartitions(*keys, "pop").mapInArrow(run, "a binary, b binary")


def classes_of(prints: DataFrame) -> DataFrame:
    """Distinct fingerprints (``fp``) with their smallest (no_id, id, text_hash); null ids come after all others."""
    who = F.struct(F.col("id").isNull().alias("no_id"), "id", "text_hash")
    return keep(prints.groupBy("fp").agg(F.min(who).alias("least")), "classes")


def groups(classes: DataFrame, edges: DataFrame) -> DataFrame:
    """Columns ``fp`` and ``first`` (the smallest ``least`` of the fingerprint's group) for all classes."""
    found = components(edges)
    rooted = keep(classes.join(found, classes["fp"] == found["node"], "left")
                  .select("fp", "least", F.coalesce("root", "fp").alias("root")), "rooted")
    first = rooted.groupBy("root").agg(F.min("least").alias("first"))
    return keep(rooted.join(first, "root").select("fp", "first"), "groups")


def grouped(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, radius: int = 2,
            tile: int = TILE) -> DataFrame:
    """One row per document: ``id``, ``text_hash``, ``fp`` and ``first``, the (no_id, id, text_hash) that comes first in its group."""
    prints = keep(fingerprints(docs, id_col, text_col, words), "prints")
    classes = classes_of(prints)
    return prints.join(groups(classes, links(classes, radius, exact_blocks(64, radius), tile)), "fp")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, radius: int = 2,
                    tile: int = TILE) -> DataFrame:
    """One row per document: id, ``fingerprint`` (16 hex digits), ``component_id`` (smallest id reachable).

    Exact: documents are linked if their 64-bit fingerprints differ in at most ``radius`` bits. Null and empty texts
    have fingerprint zero and are linked like any other. Repeated rows come out each. A null id is larger than any
    other, and the component of a group that has null ids only is null. Other columns are ignored; an empty table
    gives an empty result.
    """
    return grouped(docs, id_col, text_col, words, radius, tile).select(
        F.col("id").alias(id_col), F.lower(F.hex("fp")).alias("fingerprint"), F.col("first.id").alias("component_id"))


def one_of_each_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, radius: int = 2,
                      tile: int = TILE) -> DataFrame:
    """``docs`` with one row of each group of ``near_duplicates``, its columns unchanged: the one with the smallest id.

    Null texts are copies of the empty one; among equal ids the row with the smallest text hash stays, of repeated rows
    one; a null id loses to any other. An empty table gives an empty result.
    """
    rows = keep(grouped(docs, id_col, text_col, words, radius, tile), "grouped")
    stays = F.col("id").eqNullSafe(F.col("first.id")) & F.col("text_hash").eqNullSafe(F.col("first.text_hash"))
    gone = keep(rows.where(~stays).select("id", "text_hash").distinct(), "gone")
    again = keep(rows.where(stays).groupBy("id", "text_hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "again")
    left = docs.select(F.struct(*docs.columns).alias("row"), docs[id_col].alias("id"), F.xxhash64(docs[text_col]).alias("text_hash"))

    def of(frame: DataFrame, other: DataFrame, how: str) -> DataFrame:
        same = frame["id"].eqNullSafe(F.col("o_id")) & frame["text_hash"].eqNullSafe(F.col("o_hash"))
        return frame.join(small(other.select(F.col("id").alias("o_id"), F.col("text_hash").alias("o_hash"))), same, how)

    out = of(left, gone, "left_anti")
    if again.isEmpty():  # no row is repeated
        return out.select("row.*")
    rank = Window.partitionBy("id", "text_hash").orderBy(F.lit(0))
    once = of(left, again, "left_semi").withColumn("n", F.row_number().over(rank)).where("n = 1").select("row")
    return of(out, again, "left_anti").select("row").union(once).select("row.*")
