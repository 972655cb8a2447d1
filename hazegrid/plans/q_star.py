"""Star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from hazegrid.constants import STATION, TS
from hazegrid.functions.clock import NTZ
from hazegrid.operators import reads, star
from hazegrid.plans.bindings import Tables
from hazegrid.plans.registry import query

STAR = "b4_poll b4_weather b4_stations b4_wind"
CONTEXT = ("b4_poll p JOIN b4_stations s ON s.station_id = p.station_id JOIN b4_weather w ON w.station_id = p.station_id AND w.ts = p.ts "
           "LEFT JOIN b4_wind d ON d.wind_dir_id = w.wind_dir_id")
HALF = "station_type IN ('AFRICA', 'ASIA')"


def _meta(t: Tables) -> DataFrame:
    """Only some stations are known, so that the others take the defaults."""
    return t.b4_stations.where(HALF).drop("station_id")


def _labels(t: Tables) -> DataFrame:
    return t.b4_wind.where("wd_code < 'Brand#2'").select("wd_code", "wd_label")


NAMES = "SELECT station, row_number() OVER (ORDER BY station) AS id FROM (SELECT DISTINCT station FROM b4_wide)"
CODES = "SELECT wd, row_number() OVER (ORDER BY wd) AS id FROM (SELECT DISTINCT wd FROM b4_wide WHERE wd IS NOT NULL)"


@query("normalise_stations", "b4_wide b4_stations", f"""
    SELECT CAST(n.id AS INT) AS station_id, n.station AS station_name, coalesce(m.station_type, 'urban') AS station_type,
           CAST(m.latitude AS DOUBLE) AS latitude, CAST(m.longitude AS DOUBLE) AS longitude
    FROM ({NAMES}) n LEFT JOIN (SELECT * FROM b4_stations WHERE {HALF}) m ON m.station_name = n.station""")
def normalise_stations(t: Tables) -> DataFrame:
    d = star.normalise_stations(t.b4_wide, _meta(t))
    return d.withColumns({c: F.col(c).cast("double") for c in ("latitude", "longitude")})


@query("normalise_wind", "b4_wide b4_wind", f"""
    SELECT CAST(n.id AS INT) AS wind_dir_id, n.wd AS wd_code, coalesce(m.wd_label, n.wd) AS wd_label
    FROM ({CODES}) n LEFT JOIN (SELECT * FROM b4_wind WHERE wd_code < 'Brand#2') m ON m.wd_code = n.wd""")
def normalise_wind(t: Tables) -> DataFrame:
    return star.normalise_wind(t.b4_wide, _labels(t))


@query("normalise_pollutants", "b4_wide", f"""
    SELECT CAST(n.id AS INT) AS station_id, ts, pm2_5, pm10, so2, no2, co, o3 FROM b4_wide w JOIN ({NAMES}) n ON n.station = w.station""")
def normalise_pollutants(t: Tables) -> DataFrame:
    return star.normalise_pollutants(t.b4_wide, star.normalise_stations(t.b4_wide, _meta(t)))


@query("normalise_weather", "b4_wide", f"""
    SELECT CAST(n.id AS INT) AS station_id, ts, temp, pres, dewp, rain, wspm, CAST(c.id AS INT) AS wind_dir_id
    FROM b4_wide w JOIN ({NAMES}) n ON n.station = w.station LEFT JOIN ({CODES}) c ON c.wd = w.wd""")
def normalise_weather(t: Tables) -> DataFrame:
    return star.normalise(t.b4_wide, _meta(t), _labels(t))["weather_readings"]


@query("latest_per_station", "b4_poll b4_stations", """
    SELECT s.station_name, p.ts, p.pm2_5, p.pm10, p.no2, p.co FROM b4_poll p JOIN b4_stations s ON s.station_id = p.station_id
    WHERE p.ts = (SELECT max(p2.ts) FROM b4_poll p2 WHERE p2.station_id = p.station_id)""")
def latest_per_station(t: Tables) -> DataFrame:
    return star.latest_per_station(t.b4_star)


@query("date_range", STAR, f"""
    SELECT p.ts, p.pm2_5, p.pm10, w.temp, w.wspm, d.wd_code FROM {CONTEXT}
    WHERE s.station_name = 'Supplier#000000007' AND p.ts BETWEEN TIMESTAMP '1998-01-01' AND TIMESTAMP '2000-12-31'""")
def date_range(t: Tables) -> DataFrame:
    lo, hi = (F.lit(d).cast(NTZ) for d in ("1998-01-01 00:00:00", "2000-12-31 00:00:00"))
    return star.range_with_context(t.b4_star, "Supplier#000000007", lo, hi)


@query("monthly_by_station", "b4_poll b4_stations", """
    SELECT s.station_name, strftime(p.ts, '%Y-%m') AS month, round(avg(p.pm2_5), 1) AS avg_pm25, count(*) AS n_hours
    FROM b4_poll p JOIN b4_stations s ON s.station_id = p.station_id GROUP BY 1, 2""")
def monthly_by_station(t: Tables) -> DataFrame:
    return star.monthly_by_station(t.b4_star)


@query("monthly_one_station", "b4_poll b4_stations", """
    SELECT s.station_name, strftime(p.ts, '%Y-%m') AS month, round(avg(p.pm2_5), 1) AS avg_pm25, count(*) AS n_hours
    FROM b4_poll p JOIN b4_stations s ON s.station_id = p.station_id WHERE s.station_name = 'Supplier#000000003'
    GROUP BY 1, 2 ORDER BY 1, 2 LIMIT 12""")
def monthly_one_station(t: Tables) -> DataFrame:
    """The report of one station's first twelve months."""
    return star.monthly_by_station(t.b4_star, "Supplier#000000003", 12)


@query("top_hours", STAR, f"""
    SELECT s.station_name, p.ts, p.pm2_5, w.wspm, d.wd_code FROM {CONTEXT} ORDER BY p.pm2_5 DESC, s.station_name, p.ts LIMIT 10""")
def top_hours(t: Tables) -> DataFrame:
    return star.top_hours(t.b4_star)


@query("type_season_rollup", "b4_poll b4_stations", """
    SELECT s.station_type, CASE WHEN month(p.ts) IN (11, 12, 1, 2, 3) THEN 'heating' ELSE 'non-heating' END AS season_kind,
           round(avg(p.pm2_5), 1) AS avg_pm25 FROM b4_poll p JOIN b4_stations s ON s.station_id = p.station_id GROUP BY 1, 2""")
def type_season_rollup(t: Tables) -> DataFrame:
    return star.type_season_rollup(t.b4_star)


@query("denormalise", "b4_wide", "SELECT station, station_type, ts, pm2_5, pm10, so2, no2, co, o3, temp, pres, dewp, rain, wspm, wd FROM b4_wide")
def denormalise(t: Tables) -> DataFrame:
    return star.denormalise(t.b4_star)


@query("load_counts", "b4_poll b4_weather b4_stations", """
    SELECT (SELECT count(*) FROM b4_poll) AS pollutant_rows, (SELECT count(*) FROM b4_weather) AS weather_rows,
           (SELECT count(DISTINCT station_name) FROM b4_stations) AS stations""")
def load_counts(t: Tables) -> DataFrame:
    return star.load_counts(t.b4_star)


READ = "pm2_5, pm10, so2, no2, co, o3"


@query("latest_for_station", "b4_wide b5_requests", f"""
    SELECT q.req_id, q.station, r.ts, {', '.join('r.' + c for c in READ.split(', '))}, CASE WHEN r.ts IS NULL THEN 'not_found' ELSE 'ok' END AS status
    FROM b5_requests q LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY station ORDER BY ts DESC) AS rn FROM b4_wide)
    WHERE rn = 1) r ON r.station = q.station""")
def latest_for_station(t: Tables) -> DataFrame:
    return reads.latest(t.b4_readings, t.b5_requests)


@query("range_for_station", "b4_wide b5_requests", f"""
    SELECT req_id, station, ts, {READ} FROM (
      SELECT q.req_id, r.station, r.ts, {', '.join('r.' + c for c in READ.split(', '))}, row_number() OVER (PARTITION BY q.req_id ORDER BY r.ts) AS rn
      FROM b5_requests q JOIN b4_wide r ON r.station = q.station AND r.ts BETWEEN q.ts - INTERVAL 20 DAY AND q.ts + INTERVAL 20 DAY) WHERE rn <= 5""")
def range_for_station(t: Tables) -> DataFrame:
    """At most five readings from twenty days around each request."""
    span = F.expr("INTERVAL 20 DAYS")
    asked = t.b5_requests.select("req_id", STATION, (F.col(TS) - span).alias("start"), (F.col(TS) + span).alias("end"), F.lit(5).alias("limit"))
    return reads.range_read(t.b4_readings, asked)


@query("range_status", "b4_wide b4_stations b5_requests", """
    WITH n AS (SELECT q.req_id, count(*) AS n FROM b5_requests q JOIN b4_wide r ON r.station = q.station AND r.ts BETWEEN q.ts AND q.ts + INTERVAL 5 DAY
               GROUP BY 1)
    SELECT q.req_id, q.station, CASE WHEN s.station_name IS NULL THEN 'not_found' WHEN n.n IS NULL THEN 'empty' ELSE 'ok' END AS status,
           coalesce(n.n, 0) AS n_readings
    FROM b5_requests q LEFT JOIN n ON n.req_id = q.req_id LEFT JOIN (SELECT DISTINCT station_name FROM b4_stations) s ON s.station_name = q.station""")
def range_status(t: Tables) -> DataFrame:
    """What became of a request for the five days after its time."""
    asked = t.b5_requests.select("req_id", STATION, F.col(TS).alias("start"), (F.col(TS) + F.expr("INTERVAL 5 DAYS")).alias("end"))
    return reads.range_status(t.b4_readings, t.b4_stations, asked)


@query("get_by_key", "b4_wide b5_requests", f"""
    SELECT q.req_id, q.station, q.ts, {', '.join('r.' + c for c in READ.split(', '))}, CASE WHEN r.station IS NULL THEN 'not_found' ELSE 'ok' END AS status
    FROM b5_requests q LEFT JOIN b4_wide r ON r.station = q.station AND r.ts = q.ts""")
def get_by_key(t: Tables) -> DataFrame:
    return reads.get(t.b4_readings, t.b5_requests)
