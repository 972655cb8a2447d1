"""Importance resampling towards a target distribution.

Hashed word runs of the corpus and of the target are counted per bucket; the log ratios of the two form an array of
gains, and a document's weight is the mean gain of its features. Gumbel noise by id makes the highest scores a draw
without replacement in proportion to the weights. The cutoff is found by weighted median of medians: partitions report
medians of what remains of their keys, the median of those, weighted by remaining sizes, becomes the pivot, and the side
of it that cannot hold the cutoff is discarded (a quarter of the keys at least), until the exact key is known.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hazegrid.llm.common import internal, keep
from hazegrid.llm.ranks import ranked

#: Words whose buckets a task remembers; keys of which one median is taken; keys that end the search when no more are left.
REMEMBERED, MEDIAN_OF, FEW = 1_000_000, 1 << 20, 10_000
#: Keys: higher scores first, then smaller ids (null last), then the place in the table, which tells equal rows apart.
ORDER = [("score", "descending"), ("id", "ascending"), ("place", "ascending")]
# Words are what separators leave: ASCII characters but digits and letters. A-Z become a-z.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


class Features:
    """Buckets of the runs of 1 to ``longest`` words of texts, with a bounded memory."""

    def __init__(self, longest: int, buckets: int):
        self.longest, self.buckets, self.known = longest, buckets, {}

    def _bucket(self, feature: bytes) -> int:
        found = self.known[feature] = zlib.crc32(feature) % self.buckets
        return found

    def of(self, raw: bytes | None) -> tuple[int, np.ndarray]:
        """Number of words, and the bucket of each feature."""
        words = raw.translate(_TABLE).split() if raw else []
        if len(self.known) > REMEMBERED:
            self.known.clear()
        known, out = self.known, []
        for n in range(1, self.longest + 1):
            runs = words if n == 1 else [b" ".join(words[i:i + n]) for i in range(len(words) - n + 1)]
            out += [known[w] if w in known else self._bucket(w) for w in runs]
        return len(words), np.array(out, np.int64)


def bucket_counts(texts: DataFrame, text_col: str, longest: int, buckets: int) -> np.ndarray:
    """Features per bucket over all texts; every task passes on its own sums."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, total = Features(longest, buckets), np.zeros(buckets, np.int64)
        for batch in batches:
            for t in batch.column(0):
                total += np.bincount(features.of(t.as_py())[1], minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    parts = texts.select(texts[text_col].cast("binary")).mapInArrow(run, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for row in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # one row per bucket at most
        out[row["bucket"]] = row["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of the smoothed bucket shares, target over corpus, rounded down."""
    b = len(corpus)
    s, t = float(corpus.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((y + 1.0) * (s + b) / ((x + 1.0) * (t + b)))) for x, y in zip(corpus.tolist(), target.tolist())], np.int64)


def scores(docs: DataFrame, gain: np.ndarray, longest: int, seed: int, id_col: str, text_col: str) -> DataFrame:
    """Columns id, place (a number of the row), n_words, n_features, weight and score of every document."""
    salt = F.concat(F.lit(f"{seed}:"), F.coalesce(docs[id_col].cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(salt.cast("binary"), 256), 1, 8), 16, 10).cast("long")
    frame = internal(docs, id=id_col, place=F.monotonically_increasing_id(), h=h, text=docs[text_col].cast("binary"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(longest, len(gain))
        for batch in batches:
            words, sizes, weights, final = [], [], [], []
            for h, t in zip(batch.column(2).to_pylist(), batch.column(3)):
                n, at = features.of(t.as_py())
                weight = int(gain[at].sum()) // len(at) if len(at) else 0
                words.append(n)
                sizes.append(len(at))
                weights.append(weight)
                final.append(weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(v, pa.int64()) for v in (words, sizes, weights, final))],
                                             ["id", "place", "n_words", "n_features", "weight", "score"])

    schema = StructType([frame.schema["id"], frame.schema["place"]])
    for c in ("n_words", "n_features", "weight", "score"):
        schema = schema.add(c, "long")
    return frame.mapInArrow(run, schema)


def _key(row) -> tuple:
    return -row["score"], row["id"] is None, 0 if row["id"] is None else row["id"], row["place"]


def _ahead(keys: pa.Table, pivot: dict) -> tuple[pa.Array, pa.Array]:
    """Which keys come before the pivot, and which is the pivot."""
    def yes(x):
        return pc.fill_null(x, False)

    tied = pc.equal(keys["score"], pivot["score"])
    if pivot["id"] is None:
        same, lower = pc.is_null(keys["id"]), pc.is_valid(keys["id"])
    else:
        bound = pa.scalar(pivot["id"], keys["id"].type)
        same, lower = yes(pc.equal(keys["id"], bound)), yes(pc.less(keys["id"], bound))
    tied_id = pc.and_(tied, same)
    before = pc.or_(pc.greater(keys["score"], pivot["score"]),
                    pc.or_(pc.and_(tied, lower), pc.and_(tied_id, pc.less(keys["place"], pivot["place"]))))
    return before, pc.and_(tied_id, pc.equal(keys["place"], pivot["place"]))


def at_or_before(pivot: dict) -> Column:
    """Rows with the pivot's key or one before it."""
    tied = F.col("score") == pivot["score"]
    if pivot["id"] is None:
        same, lower = F.col("id").isNull(), F.col("id").isNotNull()
    else:
        same, lower = F.col("id").eqNullSafe(F.lit(pivot["id"])), F.coalesce(F.col("id") < F.lit(pivot["id"]), F.lit(False))
    return (F.col("score") > pivot["score"]) | (tied & (lower | (same & (F.col("place") <= pivot["place"]))))


def _medians(keys: DataFrame, pivot: dict | None, median_of: int) -> list:
    """Per task and side of the pivot (0 before, 1 after) the number of keys and their median; one row per
    ``median_of`` keys and side. Without a pivot all keys are on side 1."""
    def side(number: int, part: pa.Table) -> pa.RecordBatch:
        order = pc.sort_indices(part, sort_keys=ORDER, null_placement="at_end")
        mid = part.slice(order[len(part) // 2].as_py(), 1)
        return pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([len(part)], pa.int64()), *(mid[c].combine_chunks() for c in ("score", "id", "place"))],
                                          ["side", "n", "score", "id", "place"])

    def report(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = pa.Table.from_batches(held)
        if pivot is None:
            sides = [(1, part)]
        else:
            before, same = _ahead(part, pivot)
            sides = [(0, part.filter(before)), (1, part.filter(pc.invert(pc.or_(before, same))))]
        yield from (side(number, rows) for number, rows in sides if len(rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += len(batch)
            if n >= median_of:
                yield from report(held)
                held, n = [], 0
        if n:
            yield from report(held)

    schema = StructType().add("side", "integer").add("n", "long")
    for c in ("score", "id", "place"):
        schema = schema.add(keys.schema[c])
    return keys.mapInArrow(run, schema).collect()


def cutoff(keys: DataFrame, nth: int, median_of: int = MEDIAN_OF, few: int = FEW) -> dict:
    """The key (score, id, place) of the ``nth`` (from 1) row of ``keys``, which is a written table.

    What was discarded stays away: once three quarters of the keys last written are gone, the rest is written anew, so
    that all rounds together read a small multiple of the keys.
    """
    pivot, lo, hi = None, None, None
    size = written = keys.count()
    if not 1 <= nth <= size:
        raise ValueError(f"there is no row {nth} of {size}")
    while True:
        rest = keys
        if hi is not None:
            rest = rest.where(at_or_before(hi) & ~_is(hi))
        if lo is not None:
            rest = rest.where(~at_or_before(lo))
        if size <= few:  # a bounded number of keys
            return sorted((r.asDict() for r in rest.collect()), key=_key)[nth - 1]
        if size * 4 <= written:
            keys, rest, written, lo, hi = (kept := keep(rest, "keys")), kept, size, None, None
        reports = _medians(rest, pivot, median_of)
        if pivot is not None:
            before = sum(r["n"] for r in reports if r["side"] == 0)
            if nth == before + 1:
                return pivot
            if nth <= before:
                hi, size, wanted = pivot, before, 0
            else:
                lo, nth, size, wanted = pivot, nth - before - 1, size - before - 1, 1
            reports = [r for r in reports if r["side"] == wanted]
        reached, half = 0, sum(r["n"] for r in reports) / 2
        for r in sorted(reports, key=_key):
            reached += r["n"]
            if reached >= half:
                pivot = {c: r[c] for c in ("score", "id", "place")}
                break


def _is(pivot: dict) -> Column:
    return F.col("place") == pivot["place"]


def resample(docs: DataFrame, target: DataFrame, longest: int = 1, buckets: int = 10_000, percent: int = 10, least_words: int = 20,
             seed: int = 2024, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text", **search: int) -> DataFrame:
    """One row per document: id, n_features, weight, score and ``rank``, null for documents that were not drawn.

    Of the N documents with at least ``least_words`` words, floor(percent N / 100) are drawn. Null and empty texts have no
    features and weight 0. A null id is hashed like an empty one and loses ties; repeated rows are scored and drawn each,
    in any order among themselves. Other columns are ignored. An empty target gives every feature the gain of none seen; an
    empty table gives an empty result.
    """
    gain = gains(bucket_counts(docs, text_col, longest, buckets), bucket_counts(target, target_text, longest, buckets))
    scored = keep(scores(docs, gain, longest, seed, id_col, text_col), "scores")
    fits = F.col("n_words") >= least_words
    draw = percent * scored.where(fits).count() // 100
    out = [F.col("id").alias(id_col), "n_features", "weight", "score"]
    none = F.lit(None).cast("long").alias("rank")
    if not draw:
        return scored.select(*out, none)
    drawn = fits & at_or_before(cutoff(scored.where(fits).select("score", "id", "place"), draw, **search))
    winners = ranked(scored.where(drawn), F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("place").asc())
    return winners.select(*out, (F.col("rank") + 1).alias("rank")).union(scored.where(~drawn).select(*out, none))
