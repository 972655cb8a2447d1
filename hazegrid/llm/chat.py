"""Chat formatting by prefix-target expansion.

Every assistant turn is an example of its own: all preceding turns are its context, only that reply is trainable. All
examples of a conversation are prefixes of one formatted text, which ``format_turns`` writes turn by turn;
``example_texts`` expands it into the examples, each with its whole context, its reply and the reply's span.
``examples`` has the spans only, for those who cut the prefixes themselves.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
ASSISTANT = "assistant"
#: Characters of examples that a task hands on together, about.
BATCH_CHARS = 1 << 22
_ESCAPED = re.compile(r"<(\\*)\\\|")


def escape(text: Column) -> Column:
    r"""Breaks up every ``<|``: a backslash goes between the two, and one more where there are backslashes already."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: Column) -> Column:
    r"""A role in one line: backslash, line feed and ``|`` become ``\\``, ``\n`` and ``\p``."""
    for raw, sign in (("\\", "\\\\"), ("\n", "\\n"), ("|", "\\p")):
        role = F.replace(role, F.lit(raw), F.lit(sign))
    return role


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: {"n": "\n", "p": "|"}.get(m[1], m[1]), role)


def format_turns(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text") -> DataFrame:
    """One row per turn: ``conv_id``, ``n`` (from 1), ``segment`` and its place, and the example that ends with it.

    ``segment`` is the turn between its marks, its control strings escaped; ``seg_start`` and ``seg_end`` are its place
    in the conversation's formatted text (code points). For assistant turns ``example`` counts the conversation's
    examples, ``context_end`` is the end of the context, which begins at 0, and ``target_start`` to ``target_end``
    is the trainable reply; null for other turns.
    Turns go by ``turn``, null first, ties by role and text. A null text or role is an empty one, a null conversation
    is one of its own, repeated rows stay, other columns are ignored, an empty table gives an empty result.
    Only sums run along a conversation, so one of any length needs no more memory than its turns' windows, which spill.
    """
    rows = turns.select(turns[conv_col].alias("conv_id"), turns[turn_col].alias("turn"),
                        F.coalesce(turns[role_col].cast("string"), F.lit("")).alias("role"),
                        F.coalesce(turns[text_col].cast("string"), F.lit("")).alias("text"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("head", F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n"))).withColumn("body", escape(F.col("text")))
    rows = rows.withColumn("segment", F.concat("head", "body", F.lit(END + "\n")))
    rows = (rows.withColumn("n", F.row_number().over(order)).withColumn("seg_end", F.sum(F.length("segment")).over(upto))
            .withColumn("seg_start", F.col("seg_end") - F.length("segment")))
    ours = F.col("role") == ASSISTANT
    body = F.col("seg_start") + F.length("head")
    return rows.select(
        "conv_id", "n", "segment", "seg_start", "seg_end",
        F.when(ours, F.sum(ours.cast("int")).over(upto)).alias("example"), F.when(ours, F.col("seg_start")).alias("context_end"),
        F.when(ours, body).alias("target_start"), F.when(ours, body + F.length("body")).alias("target_end"))


def examples(formatted: DataFrame) -> DataFrame:
    """One row per example: conv_id, example, context_turns, context_end, target_start, target_end, and its length."""
    return (formatted.where("example is not null")
            .select("conv_id", "example", (F.col("n") - 1).alias("context_turns"), "context_end", "target_start", "target_end",
                    F.col("seg_end").alias("length")))


def example_texts(formatted: DataFrame, batch_chars: int = BATCH_CHARS) -> DataFrame:
    """The examples with their whole ``text`` (context and reply). A conversation's turns stream through in order; a task
    holds one context and about ``batch_chars`` of examples. Texts grow with the square of a conversation's length."""
    kind = formatted.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", "example", "text", "context_end", "target_start", "target_end"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, context, rows, size = object(), "", [], 0
        for batch in batches:
            kinds = [batch.column("conv_id").type, pa.int64(), pa.string(), *[pa.int64()] * 3]

            def rows_out():
                return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

            for row in batch.to_pylist():
                context = context + row["segment"] if row["conv_id"] == now else row["segment"]
                now = row["conv_id"]
                if row["example"] is not None:
                    rows.append((now, row["example"], context, row["context_end"], row["target_start"], row["target_end"]))
                    size += len(context)
                if size >= batch_chars:
                    yield rows_out()
                    rows, size = [], 0
            if rows:
                yield rows_out()
                rows, size = [], 0

    return (formatted.select("conv_id", "n", "segment", "example", "context_end", "target_start", "target_end")
            .repartition("conv_id").sortWithinPartitions("conv_id", "n")
            .mapInArrow(run, f"conv_id {kind}, example long, text string, context_end long, target_start long, target_end long"))


def parse_segment(segment: str) -> tuple[str, str]:
    """Role and text of a formatted turn."""
    tail = END + "\n"
    if not segment.startswith(START) or not segment.endswith(tail):
        raise ValueError(f"not a formatted turn: {segment[:80]!r}")
    role, _, body = segment[len(START):-len(tail)].partition("\n")
    return unescape_role(role), unescape(body)


def digests(formatted: DataFrame, texts: DataFrame | None = None) -> DataFrame:
    """Reads formatted turns and their examples (``texts``, of ``example_texts``) back. One row per conversation: n_turns,
    turns_sha256 (role, line feed, text, line feed of each turn), loss_chars and loss_sha256 (what the loss masks of its
    examples cover, unescaped), formatted_chars (the formatted text), n_examples, example_chars (all examples spelled
    out). Turns and replies stream through in order, whatever their number; contexts are left where they are read.
    """
    texts = example_texts(formatted) if texts is None else texts
    names = ["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_examples", "example_chars"]
    start, length = F.col("target_start").cast("int"), (F.col("target_end") - F.col("target_start")).cast("int")
    none = F.lit(None).cast("string")
    turns = formatted.select("conv_id", F.col("n").cast("long").alias("n"), "segment", none.alias("reply"), F.col("seg_end").cast("long").alias("chars"))
    replies = texts.select("conv_id", F.col("example").alias("n"), none.alias("segment"), F.substr("text", start + 1, length).alias("reply"),
                           F.length("text").cast("long").alias("chars"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = object()
        now, state, done = nothing, None, []

        def rows_out():
            cols = list(zip(*done)) or [()] * 8
            kinds = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
            out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["conv_id", *names])
            done.clear()
            return out

        def close():
            turns, all_, chars, loss, length, n, spelled = state
            done.append((now, turns, all_.hexdigest(), chars, loss.hexdigest(), length, n, spelled))

        kind = pa.int64()
        for batch in batches:
            kind = batch.column("conv_id").type
            for row in batch.to_pylist():
                if row["conv_id"] != now or now is nothing:
                    if now is not nothing:
                        close()
                    now, state = row["conv_id"], [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0, 0]
                if row["reply"] is None:
                    role, text = parse_segment(row["segment"])
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode())
                    state[4] = row["chars"]
                else:
                    said = unescape(row["reply"])
                    state[2] += len(said)
                    state[3].update(said.encode())
                    state[5] += 1
                    state[6] += row["chars"]
            if done:
                yield rows_out()
        if now is not nothing:
            close()
            yield rows_out()

    kind = formatted.schema["conv_id"].dataType.simpleString()
    return (turns.unionByName(replies).repartition("conv_id").sortWithinPartitions("conv_id", F.col("reply").isNotNull(), "n")
            .mapInArrow(run, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
                             "formatted_chars long, n_examples long, example_chars long"))
