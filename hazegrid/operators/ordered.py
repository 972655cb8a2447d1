"""Ordered work per station that never puts one station into one task.

A window partitioned by station alone sorts a station's whole history in one task, and one station
may hold a third of all rows. Two layouts avoid that and stay exact:

* **chunks** for unbounded frames (fills, interpolation). Rows are grouped by (station, time chunk).
  A small table keeps, per chunk, its row count and its first and last valid reading; a window over
  that small table finds what each chunk must know of its past and future. It is joined back on
  the key by which the rows are already partitioned, so the rows are shuffled once.
* **blocks** for bounded row frames (lags, rolling statistics). With the row position known, rows are
  grouped by (station, position div block), and the last rows of a block are copied to the next
  one as a halo. Blocks have equal size, whatever the time density of a station is.

Rows must be unique on station and time (``cleaning.dedup_first``). Rows that lack either have no place in a series:
they stay, with NULL for whatever comes from neighbours, spread over groups of their own.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from hazegrid.constants import STATION, TS
from hazegrid.functions.clock import EPOCH
from hazegrid.session import settle

BEFORE = (Window.unboundedPreceding, -1)
SO_FAR = (Window.unboundedPreceding, 0)


@dataclass(frozen=True)
class Layout:
    """How rows are ordered and cut. ``chunk_days`` may be a fraction for feeds below a minute."""

    key: str = STATION
    ts: str = TS
    chunk_days: float = 30.0
    block_rows: int = 4096

    @property
    def clock(self) -> Column:
        """Time as microseconds, computed once per row."""
        return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'{EPOCH}', CAST(`{self.ts}` AS TIMESTAMP_NTZ))")

    def chunk(self, clock: str = "_us") -> Column:
        return F.expr(f"{clock} div {max(1, int(self.chunk_days * 86_400_000_000))}")

    def timed(self, df: DataFrame) -> DataFrame:
        """Adds ``_us`` and ``_chunk``. Rows without station or time have no ``_us``; their chunks come from a hash."""
        t = df.withColumn("_us", F.when(F.col(self.key).isNotNull(), self.clock))
        return t.withColumn("_chunk", F.coalesce(self.chunk(), spare_group(df, F.lit(1 << 48))))


def spare_group(df: DataFrame, base: Column) -> Column:
    """One of many negative numbers, from a hash of the row: groups for rows that have no place of their own."""
    plain = [c for c, kind in df.dtypes if "map<" not in kind]
    return -base - F.pmod(F.xxhash64(*plain), F.lit(1 << 16))


HOURLY = Layout()
DAILY = Layout(ts="date", chunk_days=1461.0)


def chunked(df: DataFrame, at: Layout) -> tuple[DataFrame, WindowSpec]:
    """Adds ``_chunk`` and the 1-based row number ``_i`` within it; returns the chunk's window too."""
    w = Window.partitionBy(at.key, "_chunk").orderBy(at.ts)
    return at.timed(df).withColumn("_i", F.row_number().over(w).cast("long")), w


def _valid(c: str, reach: int) -> Column:
    """The reading with its place and time, NULL where the reading is missing; with ``reach`` also the
    time ``r`` of the row that many rows later."""
    later = ", 'r', _r" if reach else ""
    return F.expr(f"IF(`{c}` IS NULL OR _us IS NULL, NULL, named_struct('i', _i, 't', _us, 'x', `{c}`{later}))")


def _placed(v: str, reach: int) -> str:
    """Row number within the chunk to position in the series."""
    later = f", 'r', {v}.r" if reach else ""
    return f"IF({v} IS NULL, NULL, named_struct('i', {v}.i + _off, 't', {v}.t, 'x', {v}.x{later}))"


def chunk_table(rows: DataFrame, at: Layout, cols: list[str], ahead: list[str], reach: int = 0) -> DataFrame:
    """One row per (key, chunk): ``_off`` rows before it and, per column, the last valid reading before
    (``_p_c``), the first valid one after (``_q_c``) and the first of the whole series (``_o_c``)."""
    aggs = [F.count(F.lit(1)).alias("_n")]
    if reach:
        # the first few times of a chunk, for readings that end the chunk before
        aggs.append(F.array_compact(F.array(*[F.max(F.when(F.col("_i") == i, F.col("_us"))) for i in range(1, reach + 1)])).alias("_head"))
    for c in cols:
        aggs += [F.min(_valid(c, reach)).alias(f"_f_{c}"), F.max(_valid(c, reach)).alias(f"_l_{c}")]
    s = rows.where("_us IS NOT NULL").groupBy(at.key, "_chunk").agg(*aggs)
    up = Window.partitionBy(at.key).orderBy("_chunk")
    down = Window.partitionBy(at.key).orderBy(F.col("_chunk").desc())
    whole = up.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    extra = []
    if reach:
        # a chunk holds a row at least, so that many chunks are enough
        extra = [F.flatten(F.collect_list("_head").over(up.rowsBetween(1, reach))).alias("_next")]
    s = s.select("*", F.coalesce(F.sum("_n").over(up.rowsBetween(*BEFORE)), F.lit(0)).alias("_off"), *extra)
    if reach:
        s = s.withColumns({c: F.expr(f"IF({c} IS NULL, NULL, named_struct('i', {c}.i, 't', {c}.t, 'x', {c}.x, "
                                     f"'r', coalesce({c}.r, get(_next, int({c}.i + {reach} - _n - 1)))))") for c in [f"_l_{c}" for c in cols]})
    s = s.select(at.key, "_chunk", "_off", *[F.expr(_placed(f"_{d}_{c}", reach)).alias(f"_{d}_{c}") for c in cols for d in "fl"])
    out = [at.key, "_chunk", "_off"]
    for c in cols:
        out.append(F.last(f"_l_{c}", True).over(up.rowsBetween(*BEFORE)).alias(f"_p_{c}"))
        if c in ahead:
            out.append(F.last(f"_f_{c}", True).over(down.rowsBetween(*BEFORE)).alias(f"_q_{c}"))
        else:
            out.append(F.first(f"_f_{c}", True).over(whole).alias(f"_o_{c}"))
    return s.select(*out)


def with_neighbours(df: DataFrame, cols: list[str], at: Layout, ahead: list[str] | None = None, reach: int = 0) -> DataFrame:
    """Adds ``_pos`` (1-based row position in the series) and, per column and for its missing cells, ``_p_c``: the
    last valid reading before. Columns in ``ahead`` (all by default) also get the next one, ``_n_c``; the others
    the first one of the series, ``_o_c``. Cells that are known get nothing of use, which keeps rows narrow."""
    ahead = cols if ahead is None else ahead
    rows, w = chunked(df, at)
    if reach:
        rows = rows.withColumn("_r", F.lead("_us", reach).over(w))
    carry = chunk_table(rows, at, cols, ahead, reach)
    back = Window.partitionBy(at.key, "_chunk").orderBy(F.col(at.ts).desc()).rowsBetween(*SO_FAR)

    def near(rows: DataFrame, frame: WindowSpec, side: str, names: list[str]) -> DataFrame:
        keep = rows.columns
        rows = rows.select("*", *[F.last(_valid(c, reach), True).over(frame).alias(f"_{side}_{c}") for c in names])
        return rows.select(*keep, *[F.expr(f"IF(`{c}` IS NULL, _{side}_{c}, NULL)").alias(f"_{side}_{c}") for c in names])

    rows = near(rows, w.rowsBetween(*SO_FAR), "a", cols)
    if ahead:
        rows = near(rows, back, "b", ahead)
    rows = rows.join(carry, [at.key, "_chunk"], "left")
    found = []
    for c in cols:
        found.append(F.expr(f"coalesce({_placed(f'_a_{c}', reach)}, _p_{c})").alias(f"_p_{c}"))
        if c in ahead:
            found.append(F.expr(f"coalesce({_placed(f'_b_{c}', reach)}, _q_{c})").alias(f"_n_{c}"))
        else:
            found.append(F.col(f"_o_{c}"))
    return rows.select(*df.columns, "_us", (F.col("_off") + F.col("_i")).alias("_pos"), *found)


def with_position(df: DataFrame, at: Layout) -> DataFrame:
    """Adds ``_pos``, the 1-based position of a row in its series."""
    rows, _ = chunked(df, at)
    # the counts need no order: a narrow scan and a partial aggregation
    counts = at.timed(df.select(at.key, at.ts)).where("_us IS NOT NULL").groupBy(at.key, "_chunk").agg(F.count(F.lit(1)).alias("_n"))
    up = Window.partitionBy(at.key).orderBy("_chunk").rowsBetween(*BEFORE)
    offsets = counts.select(at.key, "_chunk", F.coalesce(F.sum("_n").over(up), F.lit(0)).alias("_off"))
    return (rows.join(offsets, [at.key, "_chunk"], "left")
            .select(*df.columns, (F.col("_off") + F.col("_i")).alias("_pos")))


def in_blocks(df: DataFrame, at: Layout, before: int, after: int) -> DataFrame:
    """Rows with their position ``_pos``, the block they belong to (``_home``) and the one they are a copy for
    (``_block``). A block has at most ``block_rows + before + after`` rows, whatever a station holds."""
    size = max(at.block_rows, before, after, 1)
    place = F.col("_pos") - 1
    home = F.coalesce((place / F.lit(size)).cast("long"), spare_group(df, F.lit(1)))
    rest = place % size
    targets = [home]
    if before:
        targets.append(F.when(rest >= size - before, home + 1))
    if after:
        targets.append(F.when((rest < after) & (home > 0), home - 1))
    return with_position(df, at).select(*df.columns, "_pos", home.alias("_home"),
                                        F.explode(F.array_compact(F.array(*targets))).alias("_block"))


def over_rows(df: DataFrame, at: Layout, before: int, after: int, make: Callable[[WindowSpec], dict[str, Column]],
              first: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Adds the columns ``make(window)`` returns; their frames may reach ``before`` rows back and
    ``after`` rows ahead. ``first`` may add columns to the blocks that ``make`` reads."""
    w = Window.partitionBy(at.key, "_block").orderBy("_pos")
    blocks = in_blocks(df, at, before, after)
    return ((first(blocks) if first else blocks)
            .select(*df.columns, "_home", "_block", *[F.when(F.col("_pos").isNotNull(), e).alias(n) for n, e in make(w).items()])
            .where("_home = _block").drop("_home", "_block"))


def with_runs(blocks: DataFrame, at: Layout, col: str, n: int) -> DataFrame:
    """Adds the moments (count, mean, sum of squared deviations) of ``col`` in each row's run of n positions, from the run's
    start to the row (``_up_n``) and from the row to the run's end (``_down_n``). Both frames only grow, so a row costs the same
    whatever n is. A block that starts inside a run lacks the run's beginning."""
    run = Window.partitionBy(at.key, "_block", F.floor((F.col("_pos") - 1) / n))

    def moments(frame: WindowSpec) -> Column:
        f = frame.rowsBetween(*SO_FAR)
        size = F.count(col).over(f)
        return F.struct(size.alias("n"), F.coalesce(F.avg(col).over(f), F.lit(0.0)).alias("mean"),
                        F.coalesce(F.var_pop(col).over(f) * size, F.lit(0.0)).alias("m2"))

    return blocks.withColumns({f"_up_{n}": moments(run.orderBy("_pos")), f"_down_{n}": moments(run.orderBy(F.col("_pos").desc()))})


def before_moments(w: WindowSpec, n: int) -> Column:
    """Moments of the n rows before the current one, from ``with_runs``: the rest of the run in which they begin and the part
    of the next one that they reach, or one whole run. Merging adds no differences of large sums, so flat windows stay flat."""
    none = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))
    whole = (F.col("_pos") - 1) % n == 0
    a = F.when(whole, none).otherwise(F.coalesce(F.lag(f"_down_{n}", n).over(w), none))
    b = F.coalesce(F.lag(f"_up_{n}", 1).over(w), none)
    size = a["n"] + b["n"]
    apart = b["mean"] - a["mean"]
    share = F.when(size > 0, b["n"] / size).otherwise(0.0)
    return F.struct(size.alias("n"), F.when(a["n"] > 0, F.when(b["n"] > 0, a["mean"] + apart * share).otherwise(a["mean"])).otherwise(b["mean"]).alias("mean"),
                    (a["m2"] + b["m2"] + F.when((a["n"] > 0) & (b["n"] > 0), apart * apart * a["n"] * share).otherwise(0.0)).alias("m2"))


def ordered_ids(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Numbers all rows 1..n in a total order without one task seeing them all.

    A global sort is written once; its partitions' row counts (as many as there are partitions) give
    the offsets.
    """
    s = settle(df.orderBy(*order).withColumn("_mid", F.monotonically_increasing_id()))
    s = (s.withColumn("_part", F.shiftright("_mid", 33))
         .withColumn("_row", F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))))
    counts = s.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    # one row per sort partition, so this window stays small whatever the data
    up = Window.orderBy("_part").rowsBetween(*BEFORE)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(up), F.lit(0)).alias("_off"))
    return (s.join(F.broadcast(offsets), "_part")
            .select(*df.columns, (F.col("_off") + F.col("_row") + 1).alias(name)))
