"""Scans and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from hazegrid.constants import STATION, TS
from hazegrid.operators.cleaning import coerce_numeric
from hazegrid.operators.documents import docs_to_frame
from hazegrid.operators.quality import missing_report
from hazegrid.operators.star import denormalise, recent_days, recent_months
from hazegrid.plans.bindings import Tables
from hazegrid.plans.registry import query
from hazegrid.session import scratch_path
from hazegrid.sources.readings import read_readings
from hazegrid.sources.tables import (read_docs, read_report, read_star, read_table, to_json_rows, write_docs, write_report,
                                     write_star)

RAW_NAMES = {"no": "No", "pm2_5": "PM2.5", "pm10": "PM10", "temp": "TEMP"}


@query("csv_scan", "b2_typed", """
    SELECT no, station, year, month, day, hour, pm2_5, pm10, CASE WHEN station NOT IN ('S8', 'S9', 'S10', 'S11') THEN temp END AS temp,
           CAST(NULL AS DOUBLE) AS o3, wd FROM b2_typed""")
def csv_scan(t: Tables) -> DataFrame:
    """Writes the raw rows as three sets of files with different headers and reads them as one."""
    raw = t.b2_raw.withColumnsRenamed(RAW_NAMES)
    folder = scratch_path(t.spark, "csv")
    kinds = {"a": (F.col(STATION).isin("S0", "S1", "S2", "S3"), raw.columns),
             "b": (F.col(STATION).isin("S4", "S5", "S6", "S7"), raw.columns[::-1]),
             "c": (F.col(STATION).isin("S8", "S9", "S10", "S11"), [c for c in raw.columns if c != "TEMP"])}
    for name, (rows, cols) in kinds.items():
        raw.where(rows).select(*[f"`{c}`" for c in cols]).write.csv(f"{folder}/real/{name}", header=True)
    df = read_readings(t.spark, [f"{folder}/absent", f"{folder}/real"], pattern="part-*.csv")
    return coerce_numeric(df, ["pm2_5", "pm10", "temp", "o3"]).select(
        F.col("no").cast("long").alias("no"), STATION, "year", "month", "day", "hour", "pm2_5", "pm10", "temp", "o3", "wd")


@query("table_scan", "", """
    SELECT l_orderkey, l_suppkey, l_shipdate, l_quantity FROM lineitem WHERE l_shipdate >= TIMESTAMP '2000-01-01' AND l_quantity >= 40""")
def table_scan(t: Tables) -> DataFrame:
    return (read_table(t.spark, t.folder, "lineitem", ["l_orderkey", "l_suppkey", "l_shipdate", "l_quantity"])
            .where((F.col("l_shipdate") >= F.expr("TIMESTAMP_NTZ'2000-01-01 00:00:00'")) & (F.col("l_quantity") >= 40)))


@query("recent_window", "b4_wide", """
    SELECT station, ts, pm2_5 FROM b4_wide WHERE ts >= (SELECT max(ts) FROM b4_wide) - INTERVAL 4 MONTH""")
def recent_window(t: Tables) -> DataFrame:
    return recent_months(t.b4_wide.select(STATION, TS, "pm2_5"), 4)


@query("recent_days", "b1_sensor", """
    WITH three AS (SELECT * FROM b1_sensor WHERE station IN ('S0', 'S1', 'S2'))
    SELECT station, ts, pm2_5, wd FROM three WHERE ts >= (SELECT max(ts) FROM three) - INTERVAL 7 DAY""")
def recent_days_query(t: Tables) -> DataFrame:
    return recent_days(t.b1_sensor, 7, ["S0", "S1", "S2"]).select(STATION, TS, "pm2_5", "wd")


@query("star_roundtrip", "b4_wide", "SELECT station, ts, pm2_5, pm10, temp, wspm, wd FROM b4_wide")
def star_roundtrip(t: Tables) -> DataFrame:
    folder = scratch_path(t.spark, "star")
    write_star(t.b4_star, folder)
    return denormalise(read_star(t.spark, folder)).select(STATION, TS, "pm2_5", "pm10", "temp", "wspm", "wd")


@query("doc_roundtrip", "b4_flat", "SELECT station, ts, pm2_5, co, temp, wspm, wind_dir AS wd FROM b4_flat")
def doc_roundtrip(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "docs")
    write_docs(t.b4_docs, path)
    return docs_to_frame(read_docs(t.spark, path)).select(STATION, TS, "pm2_5", "co", "temp", "wspm", "wd")


@query("doc_sample", "b4_flat", "SELECT station, ts, station_type, lat, pm2_5, wspm FROM b4_flat ORDER BY station, ts LIMIT 2")
def doc_sample(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "sample")
    write_docs(t.b4_docs, path, n=2)
    return read_docs(t.spark, path).select(STATION, F.col("timestamp").alias(TS), "station_type", "location.lat",
                                           "pollutants.pm2_5", "weather.wspm")


@query("report_roundtrip", "b1_sensor", """
    SELECT f.fmt AS fmt, c.col AS "column", c.missing, c.pct FROM (
      SELECT 'pm2_5' AS col, count(*) FILTER (WHERE pm2_5 IS NULL) AS missing, round(100 * count(*) FILTER (WHERE pm2_5 IS NULL) / count(*), 2) AS pct FROM b1_sensor
      UNION ALL SELECT 'co', count(*) FILTER (WHERE co IS NULL), round(100 * count(*) FILTER (WHERE co IS NULL) / count(*), 2) FROM b1_sensor
      UNION ALL SELECT 'wd', count(*) FILTER (WHERE wd IS NULL), round(100 * count(*) FILTER (WHERE wd IS NULL) / count(*), 2) FROM b1_sensor) c,
      (SELECT unnest(['csv', 'json']) AS fmt) f""")
def report_roundtrip(t: Tables) -> DataFrame:
    report = missing_report(t.b1_sensor, ["pm2_5", "co", "wd"])
    parts = []
    for fmt in ("csv", "json"):
        path = scratch_path(t.spark, f"report-{fmt}")
        write_report(report, path, fmt)
        parts.append(read_report(t.spark, path, "column string, missing long, pct double", fmt).select(F.lit(fmt).alias("fmt"), "*"))
    return parts[0].unionByName(parts[1])


@query("fn_json", "b1_sensor", "SELECT station, ts, pm2_5, wd FROM b1_sensor")
def fn_json(t: Tables) -> DataFrame:
    """Rows to JSON text and back."""
    rows = to_json_rows(t.b1_sensor.select(STATION, TS, "pm2_5", "wd"))
    back = F.from_json("json", "station string, ts timestamp_ntz, pm2_5 double, wd string").alias("d")
    return rows.select(back).select("d.*")
