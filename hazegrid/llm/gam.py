"""Quality classifier: a generalised additive model with pairwise interactions.

Features of the text only. Cyclic boosting goes round the features; each turn fits one shallow tree on the binned
gradients of one feature and adds it to that feature's lookup table. Then the strongest pairs get two-way tables in
the same manner. A score is a sum of bin look-ups.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructType

from hazegrid.llm.common import fold, internal, of_this_worker
from hazegrid.llm.textstats import GAPS, byte_set, covered, exact_windows, heads, repeated, scramble, word_edges, word_numbers

FEATURES = ("log_words", "word_length", "distinct_share", "top_share", "echo_share", "upper_share", "shout_rate",
            "symbol_rate", "bar_share", "repeat_share", "dup_line_share", "punct_share", "digit_share", "line_length",
            "wide_share", "short_share")
#: Labelled rows that a model is fitted on at most (those with the smallest hash of the id).
SAMPLE_ROWS = 20_000
_IS_GAP = byte_set(GAPS)
_UPPER = byte_set(bytes(range(65, 91)))
_DIGIT = byte_set(bytes(range(48, 58)))
_PUNCT = byte_set(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
_SYMBOL = byte_set(b"#*$%&|<>")


def describe(raw: bytes) -> np.ndarray:
    """The features of one text (UTF-8); all zero for one without words."""
    out = np.zeros(len(FEATURES))
    ids, kinds = word_numbers(raw)
    n = len(ids)
    if not n:
        return out
    b = np.frombuffer(raw, np.uint8)
    starts, ends = word_edges(b, _IS_GAP)
    before = heads(b)
    size = before[ends] - before[starts]
    chars, bytes_in = size.sum(), (ends - starts).sum()
    lines = [x for x in raw.split(b"\n") if x.strip()]
    again = repeated(exact_windows(ids, kinds, 3, scramble(ids)))
    out[:] = (np.log1p(n), chars / n, kinds / n, np.bincount(ids).max() / n,
              (ids[1:] == ids[:-1]).sum() / n, _UPPER[b].sum() / chars, raw.count(b"!") / n, _SYMBOL[b].sum() / n,
              ((ends - starts == 1) & (b[starts] == 124)).sum() / n,
              covered(again, 3, n).sum() / n if again.any() else 0.0, 1 - len(set(lines)) / len(lines),
              _PUNCT[b].sum() / chars, _DIGIT[b].sum() / chars, np.log1p(n / len(lines)), 1 - chars / bytes_in,
              (size <= 3).sum() / n)
    return out


@dataclass
class Gam:
    """Cuts and tables; ``pairs`` holds (feature, feature, cuts, cuts, table)."""
    base: float = 0.0
    cuts: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of label 1 for the rows of x."""
        f = np.full(len(x), self.base)
        for j, (cut, table) in enumerate(zip(self.cuts, self.tables)):
            f += table[np.searchsorted(cut, x[:, j], side="right")]
        for i, j, ci, cj, table in self.pairs:
            f += table[np.searchsorted(ci, x[:, i], side="right"), np.searchsorted(cj, x[:, j], side="right")]
        return 1 / (1 + np.exp(-f))


def _cuts(values: np.ndarray, bins: int) -> np.ndarray:
    q = np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))
    return q[q > values.min()]


def _gain(g: np.ndarray, h: np.ndarray, ridge: float) -> np.ndarray:
    return g * g / (h + ridge)


def _tree(g: np.ndarray, h: np.ndarray, ridge: float) -> np.ndarray:
    """Leaf values per bin of the best tree with two cuts (three leaves) along one feature."""
    def best(lo: int, hi: int) -> tuple[float, int]:
        if hi - lo < 2:
            return 0.0, -1
        cg, ch = np.cumsum(g[lo:hi]), np.cumsum(h[lo:hi])
        gains = _gain(cg[:-1], ch[:-1], ridge) + _gain(cg[-1] - cg[:-1], ch[-1] - ch[:-1], ridge) - _gain(cg[-1], ch[-1], ridge)
        at = int(np.argmax(gains))
        return float(gains[at]), lo + at + 1

    edges = [0, len(g)]
    for _ in range(2):
        found = max((best(lo, hi) for lo, hi in zip(edges, edges[1:])), key=lambda x: x[0])
        if found[1] < 0 or found[0] <= 1e-12:
            break
        edges = sorted([*edges, found[1]])
    out = np.zeros(len(g))
    for lo, hi in zip(edges, edges[1:]):
        out[lo:hi] = g[lo:hi].sum() / (h[lo:hi].sum() + ridge)
    return out


def _quadrants(g: np.ndarray, h: np.ndarray, ridge: float) -> tuple[float, np.ndarray]:
    """Gain and leaf values of the best tree that cuts both features once (four leaves)."""
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    if min(g.shape) < 2:
        return 0.0, np.zeros(g.shape)

    def parts(c):
        a, right, low, all_ = c[:-1, :-1], c[:-1, -1:], c[-1:, :-1], c[-1, -1]
        return a, right - a, low - a, all_ - right - low + a

    gains = sum(_gain(x, y, ridge) for x, y in zip(parts(cg), parts(ch)))
    i, j = np.unravel_index(int(np.argmax(gains)), gains.shape)
    out = np.zeros(g.shape)
    for rows in (slice(0, i + 1), slice(i + 1, None)):
        for cols in (slice(0, j + 1), slice(j + 1, None)):
            out[rows, cols] = g[rows, cols].sum() / (h[rows, cols].sum() + ridge)
    return float(gains[i, j]), out


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 150, pair_rounds: int = 60, rate: float = 0.1, ridge: float = 4.0,
        bins: int = 32, pair_bins: int = 12, n_pairs: int = 6) -> Gam:
    """Fit on rows x and labels y (0 or 1). Without rows the model says 0.5 for every text; with one class it nears that class."""
    model = Gam(base=float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))) if len(y) else 0.0)
    if not len(y):
        return model
    model.cuts = [_cuts(x[:, j], bins) for j in range(x.shape[1])]
    model.tables = [np.zeros(len(c) + 1) for c in model.cuts]
    at = [np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(model.cuts)]
    f = np.full(len(y), model.base)

    def gradients():
        p = 1 / (1 + np.exp(-f))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for j, b in enumerate(at):
            g, h = gradients()
            step = rate * _tree(np.bincount(b, g, len(model.tables[j])), np.bincount(b, h, len(model.tables[j])), ridge)
            model.tables[j] += step
            f += step[b]
    coarse = [_cuts(x[:, j], pair_bins) for j in range(x.shape[1])]
    rough = [np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(coarse)]

    def grid(i, j):
        shape = (len(coarse[i]) + 1, len(coarse[j]) + 1)
        cell = rough[i] * shape[1] + rough[j]
        g, h = gradients()
        return cell, _quadrants(*(np.bincount(cell, v, shape[0] * shape[1]).reshape(shape) for v in (g, h)), ridge)

    ranked = sorted(((-grid(i, j)[1][0], i, j) for i in range(x.shape[1]) for j in range(i)))[:n_pairs]
    tables = {(i, j): np.zeros((len(coarse[i]) + 1, len(coarse[j]) + 1)) for _, i, j in ranked}
    for _ in range(pair_rounds):
        for i, j in tables:
            cell, (_, leaf) = grid(i, j)
            tables[i, j] += rate * leaf
            f += rate * leaf.reshape(-1)[cell]
    model.pairs = [(i, j, coarse[i], coarse[j], t) for (i, j), t in tables.items()]
    return model


def _described(frame: DataFrame) -> DataFrame:
    """Features (``x`` array) of the frame's binary column ``text``, with its other columns."""
    others = [c for c in frame.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_this_worker("gam")
        for batch in batches:
            x = [describe(t.as_py() or b"") for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in others), pa.array(x, pa.list_(pa.float64()))],
                                             [*others, "x"])

    return frame.mapInArrow(run, StructType([frame.schema[c] for c in others]).add("x", ArrayType(DoubleType())))


def train(docs: DataFrame, labels: DataFrame, held_out_fold: tuple[int, int] = (5, 0), id_col: str = "doc_id",
          text_col: str = "text", label_col: str = "quality", sample_rows: int = SAMPLE_ROWS) -> Gam:
    """Fit on labelled documents outside the held-out fold, at most ``sample_rows`` of them.

    The rows with the smallest hash of the id are taken; only their features come to the driver. Null labels and ids
    are left out; any label above 0 counts as 1. Repeated rows count each, within the bound.
    """
    parts, held = held_out_fold
    known = (internal(labels, id=id_col, y=label_col).where("id is not null and y is not null")
             .where(fold("id", parts) != held))
    known = known.orderBy(F.xxhash64(F.col("id").cast("string")), "id", "y").limit(sample_rows)
    texts = internal(docs, id=id_col, text=docs[text_col].cast("binary"))
    rows = (_described(texts.join(F.broadcast(known), "id")).orderBy(F.xxhash64(F.col("id").cast("string")), "id", "y", "x")
            .limit(sample_rows).select("y", "x").collect())
    return fit(np.array([r.x for r in rows]).reshape(len(rows), len(FEATURES)), np.array([float(r.y > 0) for r in rows]))


def score(docs: DataFrame, model: Gam, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """One row per document: id, ``score`` (0 to 1, higher: label 1 likelier), ``predicted`` (1 from ``threshold`` on).

    Null and empty texts have all features 0 and get a score like any other; a null id stays null; repeated rows are
    scored each; other columns are ignored; an empty table gives an empty result.
    """
    frame = internal(docs, id=id_col, text=docs[text_col].cast("binary"))
    return _scored(frame, model, threshold).withColumnRenamed("id", id_col)


def _scored(frame: DataFrame, model: Gam, threshold: float) -> DataFrame:
    """The columns of ``frame`` but its binary ``text``, with ``score`` and ``predicted``."""
    others = [c for c in frame.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_this_worker("gam")
        for batch in batches:
            x = np.array([describe(t.as_py() or b"") for t in batch.column("text")]).reshape(batch.num_rows, len(FEATURES))
            p = model.score(x)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in others), pa.array(p, pa.float64()), pa.array(p >= threshold).cast(pa.int32())],
                [*others, "score", "predicted"])

    schema = StructType([frame.schema[c] for c in others]).add("score", "double").add("predicted", "integer")
    return frame.mapInArrow(run, schema)


def keep_good(docs: DataFrame, model: Gam, text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that score at ``threshold`` or more, all their columns unchanged."""
    frame = docs.select(F.struct(*docs.columns).alias("row"), docs[text_col].cast("binary").alias("text"))
    return _scored(frame, model, threshold).where("predicted = 1").select("row.*")
