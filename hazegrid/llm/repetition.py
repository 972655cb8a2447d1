"""Quality rules by repetition coverage.

Rolling hashes of several n-gram lengths find the word n-grams of a text that occurred in it before; the characters
inside them, and inside repeated lines, are measured against the characters of all words. One pass over the texts,
no shuffle; every text is measured whole in the task that reads it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from hazegrid.llm.common import internal
from hazegrid.llm.textstats import (GAPS, again, byte_set, covered, exact_windows, heads, repeated, scramble, window_hashes,
                                    word_edges, word_numbers)

SYMBOLS = b"#*$%&|<>"
#: Largest share (in percent) of a text's word characters in n-grams of so many words that occurred before.
COVERAGE_LIMITS = {5: 15, 6: 14, 7: 13, 8: 12, 9: 11, 10: 10}
#: Largest share of the characters in lines equal to an earlier one.
LINE_LIMIT = 20
#: Most characters of SYMBOLS per 100 words; reported, but no part of the verdict.
SYMBOL_LIMIT = 30
#: Fewest words, and the largest share of words in 3-word windows found twice.
MIN_WORDS = 50
REPEAT_LIMIT = 50
_IS_GAP, _IS_SYMBOL = byte_set(GAPS), byte_set(SYMBOLS)


def measure(raw: bytes, lengths: tuple[int, ...]) -> dict[str, int]:
    """Counts of one text (UTF-8)."""
    b = np.frombuffer(raw, np.uint8)
    ids, kinds = word_numbers(raw)
    starts, ends = word_edges(b, _IS_GAP)
    before = heads(b)
    chars = before[ends] - before[starts]
    out = {"n_words": len(ids), "word_chars": int(chars.sum()), "n_symbols": int(_IS_SYMBOL[b].sum())}
    seen: set[bytes] = set()
    twice = twice_chars = 0
    for line in raw.split(b"\n"):
        if line in seen:
            twice += 1
            twice_chars += len(line.decode("utf-8", "replace"))
        elif line.strip():
            seen.add(line)
    out |= {"n_dup_lines": twice, "dup_line_chars": twice_chars, "n_chars_all": int(before[-1])}
    mixed = scramble(ids)
    out["n_repeat_words"] = int(covered(repeated(exact_windows(ids, kinds, 3, mixed)), 3, len(ids)).sum())
    some = True
    for n in sorted(lengths):  # a repeated window holds repeated shorter ones, so after none there are no more
        found = again(window_hashes(mixed, n)) if some else np.zeros(0, bool)
        some = bool(found.any())
        out[f"dup_chars_{n}"] = int(chars[covered(found, n, len(ids))].sum()) if some else 0
    return out


def repetition_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      coverage_limits: dict[int, int] | None = None, line_limit: int = LINE_LIMIT,
                      symbol_limit: int = SYMBOL_LIMIT,
                      min_words: int = MIN_WORDS, repeat_limit: int = REPEAT_LIMIT) -> DataFrame:
    """One row per document: counts, ``dup_chars_n`` per n-gram length, ``dup_line_chars``, ``symbols_failed``,
    ``base_failed`` and ``kept``.

    ``base_failed``: fewer than ``min_words`` words, or over ``repeat_limit`` percent of the words in 3-word windows
    found twice. ``kept``: not base_failed, no n-gram length has more than its limit of the word characters in n-grams
    that occurred before (their first occurrence does not count), and lines equal to an earlier line hold at most
    ``line_limit`` percent of all characters. ``symbols_failed`` (over ``symbol_limit`` symbols per 100 words) does not
    bear on ``kept``.
    A null text has no words (as an empty one): all counts 0, base_failed. A null id stays null. Repeated rows are
    measured each; other columns of ``docs`` are ignored. An empty table gives an empty result.
    """
    limits = dict(sorted((COVERAGE_LIMITS if coverage_limits is None else coverage_limits).items()))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "dup_line_chars",
              *(f"dup_chars_{n}" for n in limits)]
    frame = internal(docs, id=id_col, text=docs[text_col].cast("binary"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [measure(t.as_py() or b"", tuple(limits)) for t in batch.column(1)]
            failed = [r["n_words"] < min_words or 100 * r["n_repeat_words"] > repeat_limit * r["n_words"] for r in rows]
            fine = [not f and all(100 * r[f"dup_chars_{n}"] <= most * r["word_chars"] for n, most in limits.items())
                    and 100 * r["dup_line_chars"] <= line_limit * r["n_chars_all"] for r, f in zip(rows, failed)]
            symbols = [100 * r["n_symbols"] > symbol_limit * r["n_words"] for r in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array([r[c] for r in rows], pa.int64()) for c in counts),
                 *(pa.array(v, pa.bool_()) for v in (symbols, failed, fine))],
                [id_col, *counts, "symbols_failed", "base_failed", "kept"])

    schema = StructType().add(id_col, frame.schema["id"].dataType)
    for c in counts:
        schema = schema.add(c, "long")
    for c in ("symbols_failed", "base_failed", "kept"):
        schema = schema.add(c, "boolean")
    return frame.mapInArrow(run, schema)
