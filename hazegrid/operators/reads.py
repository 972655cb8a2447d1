"""Reads for a table of requests: n requests are one job, not n.

``readings`` has (station, ts) and the six pollutants; a request has ``req_id`` and its own key.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, Window, functions as F

from hazegrid.constants import POLLUTANTS, STATION, TS
from hazegrid.functions.clock import EPOCH
from hazegrid.operators.ordered import HOURLY, Layout

KEY = [STATION, TS]


def latest(readings: DataFrame, requests: DataFrame) -> DataFrame:
    """Newest reading of each requested station. Readings shrink to one row per station and task before
    they are shuffled."""
    best = readings.groupBy(STATION).agg(F.max_by(F.struct(TS, *POLLUTANTS), TS).alias("_r"))
    return (requests.select("req_id", STATION).join(best, STATION, "left")
            .select("req_id", STATION, f"_r.{TS}", *[f"_r.{c}" for c in POLLUTANTS],
                    F.when(F.col("_r").isNotNull(), "ok").otherwise("not_found").alias("status")))


#: Lengths of a cell of time, and of the longest request that one cell answers, in time chunks.
CELL_CHUNKS, REACH_CHUNKS = 4, 2


def range_read(readings: DataFrame, requests: DataFrame, at: Layout = HOURLY) -> DataFrame:
    """Readings from ``start`` to ``end`` per request, in time order; all of them, or as many as the request's
    ``limit`` says if there is such a column and it is not NULL.

    A request is matched through the time chunks it touches, so a station with a long history is not
    compared whole with every request for it.
    """
    if "limit" in requests.columns:
        return _first_readings(readings, requests, at)
    asked = requests.select("req_id", STATION, "start", "end").where(F.col("start") <= F.col("end"))
    first, last = replace(at, ts="start"), replace(at, ts="end")
    spread = (asked.withColumns({"_a": first.clock, "_z": last.clock})
              .withColumn("_chunk", F.explode(F.sequence(at.chunk("_a"), at.chunk("_z")))).drop("_a", "_z"))
    hits = (at.timed(readings.select(*KEY, *POLLUTANTS)).join(spread, [STATION, "_chunk"])
            .where(F.col(TS).between(F.col("start"), F.col("end"))))
    return hits.select("req_id", *KEY, *POLLUTANTS)


def _first_readings(readings: DataFrame, requests: DataFrame, at: Layout) -> DataFrame:
    """``range_read`` with limits. The readings of a cell of time stand in order in one row, with those that follow within
    reach, so the cell of its start answers a request of that length whole, and only what it may return leaves the join.
    Longer requests visit all their cells, and their hits are gathered by number, as are those of requests that share one."""
    chunk = max(1, int(at.chunk_days * 86_400_000_000))
    size, reach = CELL_CHUNKS * chunk, REACH_CHUNKS * chunk

    def cell(us: str) -> Column:
        return F.expr(f"({us} - pmod({us}, {size})) div {size}")

    first, last = replace(at, ts="start"), replace(at, ts="end")
    asked = (requests.select("req_id", STATION, "start", "end", "limit").where(F.col("start") <= F.col("end"))
             .withColumn("_same", F.count(F.lit(1)).over(Window.partitionBy("req_id")))
             .withColumns({"_a": first.clock, "_z": last.clock}))
    # in one condition with the count, so that it stays above the shuffle by number, which both branches read
    alone = F.expr(f"IF(req_id IS NULL OR _z - _a > {reach}, 0, _same) = 1")
    cells = (readings.select(*KEY, *POLLUTANTS).dropna(subset=KEY).withColumn("_us", at.clock)
             .withColumn("_cell", F.explode(F.array_distinct(F.array(cell("_us"), cell(f"(_us - {reach})")))))
             .groupBy(STATION, "_cell").agg(F.array_sort(F.collect_list(F.struct(TS, *POLLUTANTS))).alias("_r")))

    def within(upper: str) -> str:
        return f"filter(_r, r -> r.{TS} >= start AND r.{TS} <= `end` {upper})"

    short = (asked.where(alone).withColumn("_cell", cell("_a")).join(cells, [STATION, "_cell"])
             .select("req_id", STATION, F.expr(within("")).alias("_r"), "limit")
             .select("req_id", STATION, F.inline(F.expr("IF(limit IS NULL, _r, slice(_r, 1, int(least(greatest(limit, 0), 2147483647))))"))))
    # readings within reach belong to the cells that follow
    edge = F.expr(f"TIMESTAMP_NTZ'{EPOCH}' + make_dt_interval(0, 0, 0, CAST((_cell + 1) * {size // 1_000_000} AS DECIMAL(18, 6)))")
    long = (asked.where(~alone).withColumn("_cell", F.explode(F.sequence(cell("_a"), cell("_z")))).join(cells, [STATION, "_cell"])
            .withColumn("_edge", edge).select("req_id", STATION, "limit", F.inline(F.expr(within(f"AND r.{TS} < _edge")))))
    w = Window.partitionBy("req_id").orderBy(TS)
    long = long.withColumn("_rn", F.row_number().over(w)).where(F.col("limit").isNull() | (F.col("_rn") <= F.col("limit")))
    out = ["req_id", *KEY, *POLLUTANTS]
    return short.select(*out).unionByName(long.select(*out))


def range_status(readings: DataFrame, stations: DataFrame, requests: DataFrame, at: Layout = HOURLY) -> DataFrame:
    """What a range request comes to: ``not_found`` for an unknown station, ``empty`` without readings, else ``ok``,
    and how many readings there are, whatever its limit."""
    hits = range_read(readings, requests.select("req_id", STATION, "start", "end"), at).groupBy("req_id").agg(F.count(F.lit(1)).alias("_n"))
    known = stations.select(F.col("station_name").alias(STATION)).distinct().withColumn("_known", F.lit(True))
    status = F.when(F.col("_known").isNull(), "not_found").when(F.col("_n").isNull(), "empty").otherwise("ok")
    return (requests.select("req_id", STATION).join(known, STATION, "left").join(hits, "req_id", "left")
            .select("req_id", STATION, status.alias("status"), F.coalesce("_n", F.lit(0)).alias("n_readings")))


def get(readings: DataFrame, requests: DataFrame) -> DataFrame:
    """The reading of each requested key, or status not_found."""
    found = readings.select(*KEY, *POLLUTANTS).withColumn("_hit", F.lit(True))
    return (requests.select("req_id", *KEY).join(found, KEY, "left")
            .select("req_id", *KEY, *POLLUTANTS, F.when(F.col("_hit"), "ok").otherwise("not_found").alias("status")))
