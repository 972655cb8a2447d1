"""Documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from hazegrid.constants import STATION, TS
from hazegrid.functions.clock import NTZ
from hazegrid.operators import documents
from hazegrid.plans.bindings import Tables, rounded
from hazegrid.plans.registry import query

ONE = "Supplier#000000005"


def flat(docs: DataFrame) -> DataFrame:
    return documents.docs_to_frame(docs)


@query("to_documents", "b4_flat b4_wide b4_stations", """
    SELECT f.station, CASE WHEN f.station_type = 'EUROPE' THEN 'urban' ELSE f.station_type END AS station_type,
           CASE WHEN f.station_type <> 'EUROPE' THEN lat END AS lat, CASE WHEN f.station_type <> 'EUROPE' THEN lon END AS lon, f.ts,
           CAST(year(f.ts) AS INT) AS year, CAST(day(f.ts) AS INT) AS day, CAST(month(f.ts) IN (11, 12, 1, 2, 3) AS INT) AS is_heating_season,
           pm2_5, pm10, so2, no2, co, o3, temp, pres, dewp, rain, wind_dir, wspm FROM b4_flat f""")
def to_documents(t: Tables) -> DataFrame:
    """The stations of one region are unknown and take the defaults."""
    known = t.b4_stations.where("station_type <> 'EUROPE'")
    d = documents.to_documents(t.b4_wide.drop("station_type"), known)
    return d.select(STATION, "station_type", "location.lat", "location.lon", F.col("timestamp").alias(TS), "time.year", "time.day",
                    "time.is_heating_season", "pollutants.*", "weather.*")


@query("docs_to_frame", "b4_flat", """
    SELECT station, ts, CASE WHEN wind_dir IS NOT NULL THEN pm2_5 END AS pm2_5, CASE WHEN wind_dir IS NOT NULL THEN o3 END AS o3, temp, wspm,
           wind_dir AS wd FROM b4_flat""")
def docs_to_frame(t: Tables) -> DataFrame:
    """Some documents lack their pollutants."""
    holes = t.b4_docs.withColumn("pollutants", F.when(F.col("weather.wind_dir").isNotNull(), F.col("pollutants")))
    return flat(holes).select(STATION, TS, "pm2_5", "o3", "temp", "wspm", "wd")


@query("project_paths", "b4_flat", "SELECT station, ts AS timestamp, pm2_5 AS pollutants_pm2_5, wspm AS weather_wspm FROM b4_flat")
def project_paths(t: Tables) -> DataFrame:
    return documents.project_paths(t.b4_docs, [STATION, "timestamp", "pollutants.pm2_5", "weather.wspm"])


@query("doc_group_avg", "b4_flat", "SELECT station, round(avg(pm2_5), 4) AS avg_pm25, count(*) AS hours FROM b4_flat GROUP BY 1")
def doc_group_avg(t: Tables) -> DataFrame:
    return rounded(documents.doc_station_avg(t.b4_docs, digits=4), ["avg_pm25"], 4)


@query("doc_hazardous", "b4_flat", "SELECT station_type, count(*) AS hazardous_hours FROM b4_flat WHERE pm2_5 > 250 GROUP BY 1")
def doc_hazardous(t: Tables) -> DataFrame:
    return documents.doc_hazardous(t.b4_docs)


@query("doc_latest", "b4_flat", f"SELECT station, ts, pm2_5, wspm FROM b4_flat WHERE station = '{ONE}' ORDER BY ts DESC LIMIT 1")
def doc_latest(t: Tables) -> DataFrame:
    return flat(documents.doc_latest(t.b4_docs, ONE)).select(STATION, TS, "pm2_5", "wspm")


@query("doc_range", "b4_flat", f"""
    SELECT station, ts, pm2_5, temp, wind_dir AS wd FROM b4_flat WHERE station = '{ONE}'
    AND ts BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '2000-12-31' ORDER BY ts LIMIT 1000""")
def doc_range(t: Tables) -> DataFrame:
    lo, hi = (F.lit(d).cast(NTZ) for d in ("1997-01-01 00:00:00", "2000-12-31 00:00:00"))
    return flat(documents.doc_range(t.b4_docs, ONE, lo, hi)).select(STATION, TS, "pm2_5", "temp", "wd")


@query("doc_get", "b4_flat b5_requests", """
    SELECT q.req_id, q.station, q.ts, f.station_type, f.pm2_5, f.wind_dir, CASE WHEN f.station IS NULL THEN 'not_found' ELSE 'ok' END AS status
    FROM b5_requests q LEFT JOIN b4_flat f ON f.station = q.station AND f.ts = q.ts""")
def doc_get(t: Tables) -> DataFrame:
    keys = t.b5_requests.withColumnRenamed(TS, "timestamp")
    return documents.doc_get(t.b4_docs, keys).select("req_id", STATION, F.col("timestamp").alias(TS), "station_type", "pollutants.pm2_5",
                                                     "weather.wind_dir", "status")


