"""Mixing sources to target weights by Pfair scheduling, in DataFrame functions only.

The documents of a source form blocks of equal size, dealt as two half blocks, each with a slot of its own. Target shares
are whole numbers of a billionth. After round k a source with weight w of W, in a round of R slots, has been dealt
floor(k R u / W) - floor(k R (u - w) / W) half blocks, u being the weights up to and with its own: its due k R w / W
rounded up or down, with no drift however many rounds there are, and k R in sum. R is so long that every source has
half a block due in a round. Within a round a source with c of its r slots gives half block x the window from
floor(x r / c) to ceil((x + 1) r / c); earliest deadline first among the released ones fills every slot, and all windows
are met. A source is thus less than one half block off the line between its counts at the round's two ends, which are
themselves less than one half block off its due: less than one block off the target at any time. Each round follows from
its number alone, so rounds are scheduled in parallel. A source that runs out leaves its slots to the others; the rest of
it is spread over its last round, in which the bound holds for that round's own counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazegrid.llm.common import keep, small

#: Documents of a block (two half blocks); slots of a round, at least; rows of a numbering group, about.
BLOCK_DOCS, ROUND_SLOTS, GROUP_ROWS = 16, 512, 8192
#: Parts into which the whole of the target weights is divided, and the least share of a source.
PARTS, LEAST_PARTS = 1_000_000_000, 1000
#: Rounds scheduled one after another in a task, slots put together at a time.
CHUNK_ROUNDS, CHUNK_SLOTS = 4, 64


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def half_block(block_docs: int) -> int:
    """Documents of half a block of ``block_docs``, at least 2."""
    if block_docs < 2:
        raise ValueError("a block has two halves of at least one document each")
    return block_docs // 2


def source_key(source: Column) -> Column:
    """Never null, and different for null and every text."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def _weighed(sources: DataFrame, weights: dict[str | None, float] | None, temper: float) -> DataFrame:
    """Adds ``w``, a source's part of the target weights, at least the least share."""
    if weights is None:
        weight = F.pow(F.col("m").cast("double"), F.lit(temper))
    else:
        weight = F.lit(0.0)
        for name, w in sorted(weights.items(), key=lambda x: str(x[0])):
            weight = F.when(F.col("key") == source_key(F.lit(name)), F.lit(float(max(w, 0.0)))).otherwise(weight)
    whole = Window.partitionBy()  # one row per source
    sources = sources.withColumn("raw", weight).withColumn("all", F.sum("raw").over(whole))
    part = F.when(F.col("all") > 0, F.round(F.lit(float(PARTS)) * F.col("raw") / F.col("all"))).otherwise(F.lit(1.0))
    return sources.withColumn("w", F.greatest(F.lit(LEAST_PARTS), part.cast("long"))).select("key", "m", "w")


def _earliest_deadline_first(c: Column, r: Column) -> Column:
    """The sources (by place in ``c``) of the slots 0..r-1, with the half block's number, release and deadline."""
    def released(x, i, t):
        of = F.greatest(F.get(c, i), F.lit(1))
        return F.when((x < F.get(c, i)) & (_div(x * r, of) <= t),
                      F.struct(_div((x + 1) * r + of - 1, of).alias("deadline"), i.alias("i"), x.alias("x"), _div(x * r, of).alias("release")))

    def slot(state, t):
        best = F.array_min(F.filter(F.transform(state["next"], lambda x, i: released(x, i, t)), lambda s: s.isNotNull()))
        return F.transform(F.array(best), lambda b: F.struct(  # binds the choice, so that it is made once a slot
            F.transform(state["next"], lambda x, i: F.when(i == b["i"], x + 1).otherwise(x)).alias("next"),
            F.concat(state["out"], F.array(b)).alias("out")))[0]

    empty = F.array().cast("array<struct<deadline:bigint,i:int,x:bigint,release:bigint>>").alias("out")

    def stretch(state, g):
        last = F.least(g + CHUNK_SLOTS, r) - 1
        part = F.aggregate(F.sequence(g, last), F.struct(state["next"].alias("next"), empty), slot)
        return F.transform(F.array(part), lambda p: F.struct(p["next"].alias("next"), F.concat(state["out"], p["out"]).alias("out")))[0]

    start = F.struct(F.transform(c, lambda v: F.lit(0).cast("long")).alias("next"), empty)
    return F.aggregate(F.sequence(F.lit(0).cast("long"), r - 1, F.lit(CHUNK_SLOTS).cast("long")), start, stretch)["out"]


def schedule(sources: DataFrame, round_slots: int = ROUND_SLOTS) -> DataFrame:
    """The slot of every half block of sources (key, m half blocks, w parts): key, half, slot, release, deadline.

    One row holds all sources; it is sent to the rounds, which are spread over tasks.
    """
    long = F.lit(0).cast("long")
    upto = F.sum("w").over(Window.orderBy("key").rowsBetween(Window.unboundedPreceding, 0))  # one row per source
    one = (sources.withColumn("upto", upto)
           .agg(F.sort_array(F.collect_list(F.struct("key", "m", "w", "upto"))).alias("src"), F.sum("w").alias("all"), F.min("w").alias("least"))
           .where("size(src) > 0")
           .withColumn("r", F.greatest(F.lit(round_slots), _div(F.col("all") + F.col("least") - 1, F.col("least")))))
    # rounds by whose end all is due, and perhaps an empty one after them
    last = F.array_max(F.transform("src", lambda s: F.floor(s["m"].cast("double") * F.col("all") / (F.col("r") * s["w"])) + 2))

    def dealt(u, k):
        return k * _div(F.col("r") * u, F.col("all")) + _div(k * F.pmod(F.col("r") * u, F.col("all")), F.col("all"))

    def done(k):
        return F.transform("src", lambda s: F.least(s["m"], dealt(s["upto"], k) - dealt(s["upto"] - s["w"], k)))

    tasks = int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rounds = (one.withColumn("last", last)
              .select("src", "all", "r", "last", F.explode(F.sequence(long, F.col("last") - 1, F.lit(CHUNK_ROUNDS).cast("long"))).alias("k0"))
              .repartition(tasks, "k0")
              .select("src", "all", "r", F.explode(F.sequence("k0", F.least(F.col("k0") + CHUNK_ROUNDS, F.col("last")) - 1)).alias("k"))
              .withColumn("done", done(F.col("k"))).withColumn("next", done(F.col("k") + 1))
              .withColumn("c", F.zip_with("done", "next", lambda a, b: b - a))
              .select(F.transform("src", lambda s: s["key"]).alias("keys"), "done", "c",
                      F.aggregate("done", long, lambda x, y: x + y).alias("start"), F.aggregate("c", long, lambda x, y: x + y).alias("n"))
              .where("n > 0"))
    slots = rounds.select("keys", "done", "start", F.posexplode(_earliest_deadline_first(F.col("c"), F.col("n"))).alias("slot", "b"))
    return slots.select(F.get("keys", F.col("b.i")).alias("key"), (F.get("done", F.col("b.i")) + F.col("b.x")).alias("half"),
                        (F.col("start") + F.col("slot")).alias("slot"), (F.col("start") + F.col("b.release")).alias("release"),
                        (F.col("start") + F.col("b.deadline")).alias("deadline"))


def interleave(rows: DataFrame, weights: dict[str | None, float] | None = None, temper: float = 0.5,
               block_docs: int = BLOCK_DOCS, round_slots: int = ROUND_SLOTS, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Adds ``block``, ``slot``, ``place``, ``release`` and ``deadline`` to rows with ``key``, ``id`` and ``tie``.

    A source's rows are numbered by the MD5 of the id, through groups of about ``group_rows`` rows and a table of
    their counts, so that a source of any size is spread over many tasks. A group meets its stretch of the schedule as
    one row, in the partitions in which it was numbered, so rows are shuffled once.
    """
    half = half_block(block_docs)
    salts = keep(rows.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / group_rows).alias("salts")), "sizes")  # one row per source
    digest = F.md5(F.coalesce(F.col("id").cast("string"), F.lit("")).cast("binary"))
    kept = rows.columns
    rows = rows.join(small(salts), "key").withColumn("digest", digest).withColumn(
        "salt", F.floor(F.conv(F.substring("digest", 1, 8), 16, 10).cast("long") * F.col("salts") / F.lit(1 << 32))).drop("salts")
    counts = keep(rows.groupBy("key", "salt").agg(F.count(F.lit(1)).alias("n")), "counts")
    sources = counts.groupBy("key").agg(F.ceil(F.sum("n") / half).alias("m"))
    plan = keep(schedule(keep(_weighed(sources, weights, temper), "weights"), round_slots), "schedule")

    before = Window.partitionBy("key").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    ranges = (counts.withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0)))
              .withColumn("first", F.floor(F.col("offset") / half)))
    stretches = (ranges.select("key", "salt", "offset", "first", F.explode(F.sequence("first", F.floor((F.col("offset") + F.col("n") - 1) / half))).alias("half"))
                 .join(plan, ["key", "half"]).groupBy("key", "salt", "offset", "first")
                 .agg(F.sort_array(F.collect_list(F.struct("half", "slot", "release", "deadline"))).alias("stretch")))  # about group_rows / half
    stretches = keep(stretches.withColumnRenamed("key", "s_key").withColumnRenamed("salt", "s_salt"), "stretches")

    group = Window.partitionBy("key", "salt").orderBy("digest", "id", "tie")
    nth = F.col("number") + F.col("offset") - 1
    at = F.get("stretch", (F.floor(nth / half) - F.col("first")).cast("int"))
    return (rows.withColumn("number", F.row_number().over(group))
            .join(stretches, (F.col("key") == F.col("s_key")) & (F.col("salt") == F.col("s_salt")))
            .select(*kept, F.floor(nth / (2 * half)).alias("block"), at["slot"].alias("slot"), (nth % half).alias("place"),
                    at["release"].alias("release"), at["deadline"].alias("deadline")))


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", **options) -> DataFrame:
    """One row per document: id, source, ``block`` of the source, global ``slot`` of its half block, ``place`` in that half,
    and the half's window (``release``, ``deadline``). By (slot, place) the documents form the mix.

    ``weights`` maps sources to target weights (null: the source null); sources that are not listed, or with a weight
    below a millionth of the whole, get that least share. Without weights a source weighs its number of half blocks to
    the power ``temper``. All rows stay: a source that has run out leaves its share to the others. A null source is a source of
    its own, null ids are numbered like an empty text, equal rows are placed one after another, other columns are
    ignored, and an empty table gives an empty result.
    """
    rows = docs.select(docs[id_col].alias("id"), docs[source_col].alias("source"), source_key(docs[source_col]).alias("key"),
                       F.lit(0).alias("tie"))
    return interleave(rows, **options).select(F.col("id").alias(id_col), F.col("source").alias(source_col), "block", "slot",
                                              "place", "release", "deadline")


def order_key(docs: DataFrame, source_col: str = "source") -> tuple[Column, Column]:
    """The columns ``key`` and ``tie`` by which ``in_mixed_order`` places a row, besides its id."""
    return source_key(docs[source_col]), F.xxhash64(*[c for c, kind in docs.dtypes if "map<" not in kind])


def in_mixed_order(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", **options) -> DataFrame:
    """``docs`` with all columns unchanged, in the order of the mix (written, the files follow it)."""
    key, tie = order_key(docs, source_col)
    rows = docs.select(F.struct(*docs.columns).alias("row"), docs[id_col].alias("id"), key.alias("key"), tie.alias("tie"))
    return interleave(rows, **options).repartitionByRange("slot", "place").sortWithinPartitions("slot", "place").select("row.*")
