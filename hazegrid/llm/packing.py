"""Packing tokenised documents into sequences: vector best-fit.

Texts are tokenised where they are read; only piece lengths travel from there. Pieces are cut into blocks in the order
of the input, every block is packed in one task: pieces by falling length, each into the open sequence that fits best
under three capacities (tokens, documents, attention cost).
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hazegrid.llm import mixing
from hazegrid.llm.common import internal, keep, of_this_worker

SEQUENCE = 2048
#: Pieces that one task packs.
BLOCK = 16_384
#: Distinct words whose ids a Python worker remembers, about (some 150 bytes each, held between tasks); new words encoded together.
REMEMBERED, JOINED = 600_000, 200
# Every character but space and line feed that some table counts as white space or as a break.
_RARE = [chr(c) for c in (*range(10), *range(11, 32), 127, *range(0x80, 0xA1), 0x1680, 0x180E, *range(0x2000, 0x2010),
                          *range(0x2028, 0x2030), 0x205F, 0x2060, 0x3000, 0xFEFF)]
_RARE_ASCII = [c for c in _RARE if c.isascii()]


class Encoder:
    """Token ids of texts as little-endian 32-bit bytes, with a bounded memory of words.

    The pre-tokeniser of byte-level BPE starts a token at every space between two characters that are no white space,
    so a text's ids are those of its first word and of each further word with its leading space. Texts with other
    spacing, or with the string of a special token, are encoded whole. For the same reason many new words can be encoded
    as one text, whose ids are then cut where the bytes of the tokens add up to a word.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab()
        self.size = np.zeros(max(vocabulary.values()) + 1, np.int64)    # a token's bytes: one character each
        self.size[list(vocabulary.values())] = [len(t) for t in vocabulary]
        self.known: dict[str, bytes] = {}       # ids of a word after a space
        self.older: dict[str, bytes] = {}       # those before them; a word that is met again comes back

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, words: list[str]) -> None:
        """Remembers the ids of words, those that do not touch a line feed or nothing at all as one text."""
        alone = [w for w in words if not w or w[0] == "\n" or w[-1] == "\n"]
        rest = [w for w in words if w and w[0] != "\n" and w[-1] != "\n"] if alone else words
        for at in range(0, len(rest), JOINED):
            part = rest[at:at + JOINED]
            joined = " " + " ".join(part)
            ids, = self._ids([joined])
            reached = np.cumsum(self.size[np.frombuffer(ids, "<u4")])
            ends = np.append(np.flatnonzero(np.frombuffer(joined.encode(), np.uint8) == 32), 0)[1:]  # words have no space
            ends[-1] = len(joined.encode())
            cut = np.searchsorted(reached, ends)
            if len(reached) and reached[-1] == ends[-1] and (reached[cut] == ends).all():
                cut = ((cut + 1) * 4).tolist()
                self.known.update((w, ids[a:b]) for w, a, b in zip(part, [0, *cut], cut))
            else:                               # a token reaches over a word's end
                alone += part
        self.known.update(zip(alone, self._ids([" " + w for w in alone])))

    def _plain(self, t: str) -> bool:
        return not ("  " in t or "\n " in t or " \n" in t or any(c in t for c in (_RARE_ASCII if t.isascii() else _RARE))
                    or any(s in t for s in self.special))

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > REMEMBERED // 2:
            self.older, self.known = self.known, {}
        known, older = self.known, self.older
        heads, words, new = [], [], set()
        for t in texts:
            first, *rest = t.split(" ") if self._plain(t) else [t]
            ids = list(map(known.get, rest))
            missing = [k for k, i in enumerate(ids) if i is None]
            new.update([rest[k] for k in missing])
            heads.append(first)
            words.append((rest, ids, missing))
        back = {w: ids for w in new if (ids := older.get(w)) is not None} if older else {}
        known.update(back)
        self._learn([*new.difference(back)])
        for rest, ids, missing in words:
            for k in missing:
                ids[k] = known[rest[k]]
        return [h + b"".join(ids) for h, (_, ids, _) in zip(self._ids(heads), words)]


def shared_encoder(path: str) -> Encoder:
    """The encoder of this Python worker, with the words that its earlier tasks met."""
    return of_this_worker(f"words {path}", lambda: Encoder(path))


def pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", size: int = SEQUENCE,
           end_id: int = 0, **carried: Column) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, its place in the input (part, number) and ``carried`` columns.

    Every text's ids are followed by ``end_id``. Texts of more than ``size`` ids are cut so that all pieces but the
    first are full. A null text is an empty one: one piece of one id.
    """
    frame = internal(docs, id=id_col, text=text_col, part=F.spark_partition_id(), **carried)
    names = list(carried)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder, number = shared_encoder(tokenizer_path), 0
        tail = int(end_id).to_bytes(4, "little")
        for batch in batches:
            rows: list[list] = [[] for _ in range(6)]
            for at in range(0, batch.num_rows, 256):
                texts = [t or "" for t in batch.column(1).slice(at, 256).to_pylist()]
                for i, ids in enumerate(encoder.encode(texts)):
                    ids += tail
                    n = len(ids) // 4
                    start, end = 0, n % size or size
                    for piece in range(-(-n // size)):
                        for col, v in zip(rows, (at + i, piece, start, end - start, zlib.crc32(memoryview(ids)[4 * start:4 * end]), number)):
                            col.append(v)
                        start, end, number = end, end + size, number + 1
            of, *rest = rows
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(of, pa.int64())), *(pa.array(v, pa.int64()) for v in rest),
                 *(c.take(pa.array(of, pa.int64())) for c in batch.columns[2:])],
                ["id", "piece", "start", "length", "ids_crc32", "number", "part", *names])

    schema = StructType([frame.schema["id"]])
    for c in ("piece", "start", "length", "ids_crc32", "number"):
        schema = schema.add(c, "long")
    schema = schema.add("part", "integer")
    for c in names:
        schema = schema.add(frame.schema[c])
    return frame.mapInArrow(run, schema)


def in_mixed_order(cut: DataFrame, **options) -> DataFrame:
    """Rows of ``pieces`` (with ``key`` and ``tie`` of their documents) with places that follow the mix, in which a
    document's pieces stay together. Texts do not travel again."""
    first = (F.col("number") - F.col("piece")).alias("first")  # a document's pieces have running numbers
    texts = keep(cut.groupBy("part", first, "id", "key", "tie")
                 .agg(F.sort_array(F.collect_list(F.struct("piece", "start", "length", "ids_crc32"))).alias("cut")), "texts")
    rows = mixing.interleave(texts.select("id", "key", "tie", "cut"), **options)
    rows = rows.repartitionByRange("slot", "place").sortWithinPartitions("slot", "place").select("id", F.explode("cut").alias("cut"))
    place = F.monotonically_increasing_id()
    return rows.select("id", "cut.*", F.shiftrightunsigned(place, 33).cast("int").alias("part"), place.bitwiseAND((1 << 33) - 1).alias("number"))


def written_order(docs: DataFrame) -> tuple[Column, Column]:
    """Columns by which rows come in the order in which they were written: files of a Parquet write go by their number,
    however Spark deals them to tasks. Rows that are not read from Parquet go by partition and place."""
    name = F.col("_metadata.file_name")
    file, row = F.concat(F.lpad(F.regexp_extract(name, r"part-(\d+)", 1), 10, "0"), name), F.col("_metadata.row_index")
    try:
        docs.select(file, row)
    except AnalysisException:
        return F.lit(""), F.monotonically_increasing_id()
    return file, row


def in_written_order(cut: DataFrame) -> DataFrame:
    """Rows of ``pieces`` (with ``file`` and ``row`` of their documents) with places that follow those."""
    order = ("file", "row", "piece")
    rows = cut.select("id", "piece", "start", "length", "ids_crc32", "file", "row").repartitionByRange(*order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id()
    return rows.select("id", "piece", "start", "length", "ids_crc32", F.shiftrightunsigned(place, 33).cast("int").alias("part"),
                       place.bitwiseAND((1 << 33) - 1).alias("number"))


def best_fit(lengths: np.ndarray, size: int = SEQUENCE, most_docs: int = SEQUENCE, most_cost: int = SEQUENCE ** 2,
             weights: tuple[float, float, float] = (1.0, 0.05, 0.2), rule: str = "norm") -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece.

    A piece needs (tokens, 1 document, tokens squared) of the residual capacities, all as shares of the whole. Pieces
    go by falling length, ties in the order given. Of the sequences that can take a piece under every constraint,
    rule "norm" takes the one with the smallest weighted norm of what would be left, "dot" the one with the smallest
    weighted dot product of the piece and the residual, since a small one means little room is wasted; ties go to the
    oldest sequence. A piece that fits nowhere opens a sequence.
    """
    if rule not in ("norm", "dot"):
        raise ValueError(f"rule is norm or dot, not {rule}")
    w = np.array(weights)
    where, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    room = np.zeros((max(len(lengths), 1), 3))     # residuals of the open sequences
    name = np.zeros(max(len(lengths), 1), np.int64)
    whole = np.array([size, most_docs, most_cost], float)
    opened = live = 0
    order = np.argsort(-lengths, kind="stable")
    smallest = int(lengths.min()) if len(lengths) else 0
    for at in order:
        n = int(lengths[at])
        need = np.array([n, 1, n * n], float)
        if n > size or n * n > most_cost or most_docs < 1:
            raise ValueError(f"a piece of {n} ids fits in no sequence")
        fits = np.flatnonzero((room[:live, 0] >= n) & (room[:live, 1] >= 1) & (room[:live, 2] >= n * n))
        if len(fits):
            r = room[fits] / whole
            left = ((r - need / whole) ** 2) @ w if rule == "norm" else (r * (need / whole)) @ w
            k = int(fits[np.argmin(left)])
        else:
            k, live, opened = live, live + 1, opened + 1
            room[k], name[k] = whole, opened - 1
        where[at], offset[at] = name[k], size - int(room[k, 0])
        room[k] -= need
        if room[k, 0] < smallest or room[k, 1] < 1 or room[k, 2] < smallest * smallest:  # full: take it off the list
            room[k:live - 1] = room[k + 1:live].copy()
            name[k:live - 1] = name[k + 1:live].copy()
            live -= 1
    return where, offset


def pack(cut: DataFrame, size: int = SEQUENCE, block: int = BLOCK, **rule) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to the rows of ``pieces`` (which is read twice, so write it first).

    Blocks are runs of ``block`` pieces in the order of the input, through counts of each input partition. Sequences of
    a block have numbers of their own.
    """
    counts = cut.groupBy("part").agg((F.max("number") + 1).alias("n"))  # one row per input partition
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    rows = (cut.join(F.broadcast(base), "part")
            .withColumn("block", F.floor((F.col("base") + F.col("number")) / block)).withColumn("nth", F.col("base") + F.col("number"))
            .drop("part", "number", "base"))
    out = StructType([*rows.schema.fields]).add("sequence_id", "long").add("offset", "long")

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("nth", kind="stable")
        where, offset = best_fit(part["length"].to_numpy(), size, **rule)
        return part.assign(sequence_id=part["block"].to_numpy() * (block + 1) + where, offset=offset)

    return rows.groupBy("block").applyInPandas(run, out).drop("block", "nth")


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                   size: int = SEQUENCE, block: int = BLOCK, **rule) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset.

    Null texts count as empty, empty ones are one id long, very long ones are cut, all ids are kept; repeated rows and
    null ids are packed each; other columns are ignored; an empty table gives an empty result.
    """
    cut = keep(pieces(docs, tokenizer_path, id_col, text_col, size), "pieces")
    return pack(cut, size, block, **rule).select(
        F.col("id").alias(id_col), F.col("piece").cast("int").alias("piece"), "start", "length", "ids_crc32", "sequence_id", "offset")


def pack_mixed(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
               size: int = SEQUENCE, block: int = BLOCK, mix: dict | None = None, **rule) -> DataFrame:
    """As ``pack_documents``, with blocks cut in the order of ``mixing.in_mixed_order`` (options ``mix``), however the
    rows are read: files of a written mix do not come back in their order."""
    key, tie = mixing.order_key(docs, source_col)
    cut = keep(pieces(docs, tokenizer_path, id_col, text_col, size, key=key, tie=tie), "pieces")
    return pack(keep(in_mixed_order(cut, **(mix or {})), "mixed"), size, block, **rule).select(
        F.col("id").alias(id_col), F.col("piece").cast("int").alias("piece"), "start", "length", "ids_crc32", "sequence_id", "offset")


def pack_in_order(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", size: int = SEQUENCE,
                  block: int = BLOCK, **rule) -> DataFrame:
    """As ``pack_documents``, with blocks cut in the order in which the rows were written, for a table that an earlier step
    has put in order (``mixing.in_mixed_order``, with whatever weights)."""
    file, row = written_order(docs)
    cut = keep(pieces(docs, tokenizer_path, id_col, text_col, size, file=file, row=row), "pieces")
    return pack(keep(in_written_order(cut), "ordered"), size, block, **rule).select(
        F.col("id").alias(id_col), F.col("piece").cast("int").alias("piece"), "start", "length", "ids_crc32", "sequence_id", "offset")
