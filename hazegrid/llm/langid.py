"""Language identification in two steps: the family first, then the language within it.

Character n-grams (one to three bytes of the lower-cased text) are counted into hashed buckets. A softmax regression
picks the language family; within it, one linear support vector machine for each pair of languages votes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hazegrid.llm.common import fold, internal, keep, small, of_this_worker

UNKNOWN = "und"
# Families of ISO 639-1 codes. A language that is not listed is a family of its own.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "fy", "is", "lb", "nl", "no", "nb", "nn", "sv", "yi"),
    "romance": ("ca", "es", "fr", "gl", "it", "la", "oc", "pt", "ro"),
    "slavic": ("be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "indic": ("bn", "gu", "hi", "mr", "ne", "pa", "si", "ur"),
    "turkic": ("az", "kk", "ky", "tr", "tt", "uz"),
    "uralic": ("et", "fi", "hu"),
}
#: Training texts of each language at most (those with the smallest hash of the id), and of all languages together: with
#: very many languages each gets an equal share of these, so that what comes to the driver is bounded.
SAMPLE_PER_LANGUAGE, SAMPLE_ROWS = 600, 60_000
#: Buckets of byte pairs and of byte triples; single bytes have 256 of their own.
PAIRS, TRIPLES = 1024, 2048
WIDTH = 256 + PAIRS + TRIPLES
_BLANK = bytes(32 if c < 128 and not chr(c).isalpha() else c for c in range(256))
_LETTER = regex.compile(r"\p{L}")


def has_letter(text: str) -> bool:
    return _LETTER.search(text) is not None


def profile(text: str) -> np.ndarray:
    """Square roots of the n-gram counts of a text, scaled to length 1."""
    b = np.frombuffer(b" " + text.lower().encode("utf-8", "replace").translate(_BLANK) + b" ", np.uint8).astype(np.uint32)
    two = b[:-1] * np.uint32(256) + b[1:]
    three = two[:-1] * np.uint32(256) + b[2:]
    mixed = [((x * np.uint32(2654435761)) >> np.uint32(15)) for x in (two, three)]
    out = np.zeros(WIDTH, np.float32)
    out[:256] = np.bincount(b, minlength=256)
    out[32] = 0
    out[256:256 + PAIRS] = np.bincount(mixed[0] % PAIRS, minlength=PAIRS)
    out[256 + PAIRS:] = np.bincount(mixed[1] % TRIPLES, minlength=TRIPLES)
    np.sqrt(out, out=out)
    return out / max(float(np.linalg.norm(out)), 1e-9)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def _fit_families(x: np.ndarray, y: np.ndarray, k: int, steps: int = 200, ridge: float = 1e-5, rate: float = 8.0) -> np.ndarray:
    """Softmax regression by accelerated gradient descent; classes weigh the same. Last row: intercepts."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    goal = np.eye(k, dtype=x.dtype)[y]
    weight = (1 / (k * np.bincount(y, minlength=k)))[y][:, None].astype(x.dtype)
    w = v = np.zeros((x.shape[1], k), x.dtype)
    for t in range(steps):
        new = v - x.dtype.type(rate) * (x.T @ (weight * (_softmax(x @ v) - goal)) + x.dtype.type(ridge) * v)
        w, v = new, new + x.dtype.type(t / (t + 3)) * (new - w)
    return w


def _fit_pair(x: np.ndarray, y: np.ndarray, steps: int = 200, ridge: float = 1e-4, rate: float = 0.4) -> np.ndarray:
    """Linear support vector machine (squared hinge) for y in (-1, 1); both classes weigh the same. Last entry: intercept."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    weight = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1)).astype(x.dtype)
    w = v = np.zeros(x.shape[1], x.dtype)
    for t in range(steps):
        slack = np.maximum(0, 1 - y * (x @ v))
        new = v - x.dtype.type(rate) * (-2 * (x.T @ (weight * slack * y)) + x.dtype.type(ridge) * v)
        w, v = new, new + x.dtype.type(t / (t + 3)) * (new - w)
    return w


@dataclass
class LanguageModel:
    families: list[list[str]] = field(default_factory=list)     # languages of each family
    family_weights: np.ndarray | None = None
    pairs: dict[tuple[str, str], np.ndarray] = field(default_factory=dict)

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Language and score of each profile: family probability times the language's share of the pairwise margins."""
        if not self.families:
            return [UNKNOWN] * len(x), np.zeros(len(x))
        x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
        p = _softmax(x @ self.family_weights)
        first = p.argmax(1)
        names, scores = [""] * len(x), np.zeros(len(x))
        for k, members in enumerate(self.families):
            at = np.flatnonzero(first == k)
            votes, won = np.zeros((len(at), len(members))), np.ones((len(at), len(members)))
            for i, j in combinations(range(len(members)), 2):
                margin = x[at] @ self.pairs[members[i], members[j]]
                side = 1 / (1 + np.exp(-4 * margin.astype(float)))
                votes[:, i] += (margin > 0) + side / 1000
                votes[:, j] += (margin <= 0) + (1 - side) / 1000
                won[:, i] = np.minimum(won[:, i], side)
                won[:, j] = np.minimum(won[:, j], 1 - side)
            best = votes.argmax(1)
            for r, m in zip(at, best):
                names[r] = members[m]
            scores[at] = p[at, k] * won[np.arange(len(at)), best]
        return names, np.clip(scores, 0, 1)


def fit(x: np.ndarray, langs: list[str], families: dict[str, tuple[str, ...]] | None = None) -> LanguageModel:
    """Fit on profiles x and their languages. Without rows every text is UNKNOWN; with one language all are that one."""
    home = {code: name for name, codes in (FAMILIES if families is None else families).items() for code in codes}
    groups: dict[str, list[str]] = {}
    for lang in sorted(set(langs)):
        groups.setdefault(home.get(lang, f"={lang}"), []).append(lang)
    model = LanguageModel([groups[g] for g in sorted(groups)])
    if not langs:
        return model
    at = {lang: k for k, members in enumerate(model.families) for lang in members}
    model.family_weights = _fit_families(x, np.array([at[v] for v in langs]), len(model.families))
    names = np.array(langs)
    for members in model.families:
        for a, b in combinations(members, 2):
            rows = (names == a) | (names == b)
            model.pairs[a, b] = _fit_pair(x[rows], np.where(names[rows] == a, 1, -1).astype(x.dtype))
    return model


def train(docs: DataFrame, held_out_fold: tuple[int, int] = (4, 2), id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang", per_language: int = SAMPLE_PER_LANGUAGE, sample_rows: int = SAMPLE_ROWS,
          families: dict[str, tuple[str, ...]] | None = None) -> LanguageModel:
    """Learn from texts of documents outside the held-out fold, at most ``per_language`` of each language.

    Null texts, null languages and texts without a letter teach nothing; of repeated rows one teaches. A count per
    language gives the hash below which about twice the bound lies, so no task ever ranks a whole language. Only
    profiles of the sample come to the driver.
    """
    parts, held = held_out_fold
    rows = (internal(docs, id=id_col, lang=lang_col, text=text_col).where("lang is not null and text is not null")
            .where(fold("id", parts) != held).where(F.col("text").rlike(r"\p{L}")))
    names = rows.select("lang", "id", F.xxhash64("text").alias("text_hash"))
    names = names.withColumn("h", F.xxhash64(F.coalesce(F.col("id").cast("string"), F.lit("")), "text_hash"))
    names = keep(names.distinct(), "languages")
    sizes = names.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    bound = F.least(F.lit(per_language), F.greatest(F.lit(2), F.floor(F.lit(sample_rows) / F.count(F.lit(1)).over(Window.partitionBy()))))
    sizes = keep(sizes.withColumn("bound", bound), "sizes")  # one row per language
    # Hashes are even over 64 bits: about 2 x bound + 64 rows of a language lie below its limit, all if it has no more
    near = names.join(small(sizes), "lang").where((F.col("h") / F.lit(2.0 ** 64) + 0.5) * F.col("n") <= 2 * F.col("bound") + 64)
    rank = Window.partitionBy("lang").orderBy("h", "id", "text_hash")
    chosen = near.withColumn("nth", F.row_number().over(rank)).where(F.col("nth") <= F.col("bound"))
    chosen = keep(chosen.select(F.col("lang").alias("c_lang"), F.col("id").alias("c_id"), F.col("text_hash").alias("c_hash")), "sample")
    same = (F.col("lang") == F.col("c_lang")) & F.col("id").eqNullSafe(F.col("c_id")) & (F.col("text_hash") == F.col("c_hash"))
    rows = rows.withColumn("text_hash", F.xxhash64("text"))
    rows = rows.join(small(chosen), same, "left_semi").groupBy("lang", "id", "text_hash").agg(F.first("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_this_worker("langid")
        for batch in batches:
            x = [profile(t.as_py()).tobytes() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(x, pa.binary())], ["lang", "x"])

    found = sorted(rows.select("lang", "text").mapInArrow(run, "lang string, x binary").collect())
    x = np.array([np.frombuffer(r.x, np.float32) for r in found], np.float32).reshape(len(found), WIDTH)
    return fit(x, [r.lang for r in found], families)


def _labelled(frame: DataFrame, model: LanguageModel) -> DataFrame:
    """The columns of ``frame`` but ``text``, with ``lang_pred`` and ``score``."""
    others = [c for c in frame.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_this_worker("langid")
        for batch in batches:
            names, scores = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows)
            column = batch.column("text")
            for start in range(0, batch.num_rows, 256):  # bounds the matrix of profiles
                texts = column.slice(start, 256).to_pylist()
                at = [i for i, t in enumerate(texts) if t and has_letter(t)]
                if at:
                    found, sure = model.predict(np.array([profile(texts[i]) for i in at]))
                    for i, name, s in zip(at, found, sure):
                        names[start + i], scores[start + i] = name, s
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in others), pa.array(names, pa.string()),
                                              pa.array(scores, pa.float64())], [*others, "lang_pred", "score"])

    schema = StructType([frame.schema[c] for c in others]).add("lang_pred", "string").add("score", "double")
    return frame.mapInArrow(run, schema)


def identify(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``lang_pred`` and ``score`` (0 to 1).

    A null text, or one without a letter, is UNKNOWN with score 0. A null id stays null, repeated rows are labelled
    each, other columns are ignored, an empty table gives an empty result.
    """
    return _labelled(internal(docs, id=id_col, text=text_col), model).withColumnRenamed("id", id_col)


def keep_known(docs: DataFrame, model: LanguageModel, text_col: str = "text", min_score: float = 0.3) -> DataFrame:
    """The rows of ``docs`` whose language is known with ``min_score`` or more, all their columns unchanged."""
    frame = docs.select(F.struct(*docs.columns).alias("row"), docs[text_col].alias("text"))
    return (_labelled(frame, model).where(F.col("lang_pred") != UNKNOWN).where(F.col("score") >= min_score).select("row.*"))
