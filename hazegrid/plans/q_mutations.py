"""Keyed batch and streaming mutations."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from hazegrid.constants import STATION, TS
from hazegrid.operators import mutations
from hazegrid.operators.documents import docs_to_frame
from hazegrid.plans.bindings import Tables
from hazegrid.plans.registry import query
from hazegrid.session import scratch_path
from hazegrid.streaming.ingest import ingest_stream, read_accepted

ROWS = "station, ts, pm2_5, pm10, so2, no2, co, o3"
FIRST = "row_number() OVER (PARTITION BY station, ts ORDER BY req_id)"
TAKEN = "EXISTS (SELECT 1 FROM b4_wide w WHERE w.station = q.station AND w.ts = q.ts)"
KNOWN = "EXISTS (SELECT 1 FROM b4_stations s WHERE s.station_name = q.station)"
CREATE = f"""SELECT *, CASE WHEN NOT {KNOWN} THEN 'not_found' WHEN {TAKEN} OR rn > 1 THEN 'conflict' ELSE 'ok' END AS status
             FROM (SELECT *, {FIRST} AS rn FROM b5_requests) q"""
NEW = "station, ts, pm2_5, pm10, NULL AS so2, NULL AS no2, NULL AS co, NULL AS o3"


@query("create_status", "b4_wide b4_stations b5_requests", f"SELECT req_id, station, ts, status FROM ({CREATE})")
def create_status(t: Tables) -> DataFrame:
    return mutations.create_status(t.b4_readings, t.b4_stations, t.b5_requests)


@query("create_rows", "b4_wide b4_stations b5_requests", f"""
    SELECT {ROWS} FROM b4_wide UNION ALL SELECT {NEW} FROM ({CREATE}) WHERE status = 'ok'""")
def create_rows(t: Tables) -> DataFrame:
    return mutations.create_rows(t.b4_readings, t.b4_stations, t.b5_requests)


@query("update_status", "b4_wide b5_requests", f"""
    SELECT req_id, station, ts, CASE WHEN {TAKEN} THEN 'ok' ELSE 'not_found' END AS status FROM b5_requests q""")
def update_status(t: Tables) -> DataFrame:
    return mutations.update_status(t.b4_readings, t.b5_requests)


@query("update_rows", "b4_wide b5_requests", """
    WITH a AS (SELECT station, ts, arg_max(pm2_5, req_id) FILTER (WHERE pm2_5 IS NOT NULL) AS n25,
                      arg_max(pm10, req_id) FILTER (WHERE pm10 IS NOT NULL) AS n10 FROM b5_requests GROUP BY 1, 2)
    SELECT w.station, w.ts, coalesce(n25, pm2_5) AS pm2_5, coalesce(n10, pm10) AS pm10, so2, no2, co, o3
    FROM b4_wide w LEFT JOIN a ON a.station = w.station AND a.ts = w.ts""")
def update_rows(t: Tables) -> DataFrame:
    return mutations.update_rows(t.b4_readings, t.b5_requests)


@query("delete_status", "b4_wide b5_requests", f"""
    SELECT req_id, station, ts, CASE WHEN {TAKEN} AND rn = 1 THEN 'ok' ELSE 'not_found' END AS status
    FROM (SELECT *, {FIRST} AS rn FROM b5_requests) q""")
def delete_status(t: Tables) -> DataFrame:
    return mutations.delete_status(t.b4_readings, t.b5_requests)


@query("delete_rows", "b4_wide b5_requests", f"""
    SELECT {ROWS} FROM b4_wide w WHERE NOT EXISTS (SELECT 1 FROM b5_requests q WHERE q.station = w.station AND q.ts = w.ts)""")
def delete_rows(t: Tables) -> DataFrame:
    return mutations.delete_rows(t.b4_readings, t.b5_requests)


def _new_docs(t: Tables) -> DataFrame:
    none = F.lit(None).cast("double")
    return t.b5_requests.select(
        "req_id", STATION, F.col(TS).alias("timestamp"),
        F.struct(F.col("pm2_5"), F.col("pm10"), *[none.alias(c) for c in ("so2", "no2", "co", "o3")]).alias("pollutants"))


@query("doc_create", "b4_flat b5_requests", """
    SELECT station, ts, pm2_5, pm10, temp, wind_dir AS wd FROM b4_flat
    UNION ALL SELECT station, ts, pm2_5, pm10, NULL, NULL FROM (SELECT *, row_number() OVER (PARTITION BY station, ts ORDER BY req_id) AS rn FROM b5_requests) q
    WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM b4_flat f WHERE f.station = q.station AND f.ts = q.ts)""")
def doc_create(t: Tables) -> DataFrame:
    return docs_to_frame(mutations.doc_create(t.b4_docs, _new_docs(t))).select(STATION, TS, "pm2_5", "pm10", "temp", "wd")


@query("doc_create_status", "b4_flat b5_requests", """
    SELECT req_id, station, ts, CASE WHEN rn = 1 AND NOT EXISTS (SELECT 1 FROM b4_flat f WHERE f.station = q.station AND f.ts = q.ts)
           THEN 'ok' ELSE 'conflict' END AS status
    FROM (SELECT *, row_number() OVER (PARTITION BY station, ts ORDER BY req_id) AS rn FROM b5_requests) q""")
def doc_create_status(t: Tables) -> DataFrame:
    return mutations.doc_create_status(t.b4_docs, _new_docs(t)).withColumnRenamed("timestamp", TS)


@query("doc_update", "b4_flat b5_requests", """
    WITH q AS (SELECT *, row_number() OVER (PARTITION BY station, ts ORDER BY req_id DESC) AS rn FROM b5_requests),
         last AS (SELECT * FROM q WHERE rn = 1),
         gale AS (SELECT station, ts, arg_max(pm2_5, req_id) AS temp FROM b5_requests WHERE priority = '1-URGENT' GROUP BY 1, 2)
    SELECT f.station, f.ts, CASE WHEN l.req_id IS NOT NULL THEN l.pm2_5 ELSE f.pm2_5 END AS pm2_5,
           CASE WHEN l.req_id IS NOT NULL THEN l.pm10 ELSE f.pm10 END AS pm10, f.so2,
           CASE WHEN g.station IS NOT NULL THEN g.temp ELSE f.temp END AS temp, CASE WHEN g.station IS NULL THEN f.wspm END AS wspm,
           CASE WHEN l.req_id IS NULL THEN f.wind_dir WHEN l.priority <> '1-URGENT' THEN 'NEW' END AS wd
    FROM b4_flat f LEFT JOIN last l ON l.station = f.station AND l.ts = f.ts LEFT JOIN gale g ON g.station = f.station AND g.ts = f.ts""")
def doc_update(t: Tables) -> DataFrame:
    d = docs_to_frame(mutations.doc_update(t.b4_docs, t.b5_doc_requests))
    return d.select(STATION, TS, "pm2_5", "pm10", "so2", "temp", "wspm", "wd")


@query("doc_update_status", "b4_wide b5_requests", f"""
    SELECT req_id, station, ts, CASE WHEN {TAKEN} THEN 'ok' ELSE 'not_found' END AS status FROM b5_requests q""")
def doc_update_status(t: Tables) -> DataFrame:
    return mutations.doc_update_status(t.b4_docs, t.b5_doc_requests).withColumnRenamed("timestamp", TS)


@query("doc_delete", "b4_flat b5_requests", """
    SELECT station, ts, pm2_5, wspm FROM b4_flat f WHERE NOT EXISTS (SELECT 1 FROM b5_requests q WHERE q.station = f.station AND q.ts = f.ts)""")
def doc_delete(t: Tables) -> DataFrame:
    return docs_to_frame(mutations.doc_delete(t.b4_docs, t.b5_requests.withColumnRenamed(TS, "timestamp"))).select(STATION, TS, "pm2_5", "wspm")


@query("doc_delete_status", "b4_wide b5_requests", f"""
    SELECT req_id, station, ts, CASE WHEN {TAKEN} AND rn = 1 THEN 'ok' ELSE 'not_found' END AS status
    FROM (SELECT *, {FIRST} AS rn FROM b5_requests) q""")
def doc_delete_status(t: Tables) -> DataFrame:
    req = t.b5_requests.withColumnRenamed(TS, "timestamp")
    return mutations.doc_delete_status(t.b4_docs, req).withColumnRenamed("timestamp", TS)


@query("stream_ingest", "b4_wide b4_stations b5_requests", f"""
    SELECT {ROWS} FROM b4_wide UNION ALL SELECT {NEW} FROM ({CREATE}) WHERE status = 'ok'""")
def stream_ingest(t: Tables) -> DataFrame:
    """The create requests as a stream of files; the table afterwards."""
    arrivals, sink, state = (scratch_path(t.spark, n) for n in ("arrivals", "sink", "state"))
    req = t.b5_requests.select("req_id", STATION, TS, "pm2_5", "pm10")
    req.write.parquet(arrivals)
    stream = t.spark.readStream.schema(req.schema).parquet(arrivals)
    ingest_stream(stream, t.b4_readings, t.b4_stations, sink, state).awaitTermination()
    return t.b4_readings.unionByName(read_accepted(t.spark, sink).drop("period", "batch"))
