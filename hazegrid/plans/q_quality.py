"""Data-quality reports."""

from __future__ import annotations

from pyspark.sql import DataFrame

from hazegrid.operators import quality
from hazegrid.plans.bindings import B3_CHANNELS, Tables, rounded
from hazegrid.plans.registry import query

SENSOR = ["pm2_5", "pm10", "so2", "no2", "co", "temp", "wspm", "wd"]


def _each(cols, template: str) -> str:
    return " UNION ALL ".join(template.format(c=c) for c in cols)


@query("overview", "b4_wide", """
    SELECT count(*) AS rows, count(DISTINCT station) AS stations, min(ts) AS start, max(ts) AS "end",
           CAST(date_diff('second', min(ts), max(ts)) // 86400 AS INT) AS span_days, CAST(11 AS INT) AS n_numeric_cols FROM b4_wide""")
def overview(t: Tables) -> DataFrame:
    return quality.overview(t.b4_wide)


@query("overview_stations", "b4_wide", "SELECT DISTINCT station FROM b4_wide ORDER BY station")
def overview_stations(t: Tables) -> DataFrame:
    return quality.station_names(t.b4_wide)


@query("infer_frequency", "b4_wide", """
    SELECT station, step AS frequency_seconds FROM (
      SELECT station, step, row_number() OVER (PARTITION BY station ORDER BY count(*) DESC, step) AS rn FROM (
        SELECT station, date_diff('second', lag(ts) OVER (PARTITION BY station ORDER BY ts), ts) AS step FROM b4_wide)
      WHERE step IS NOT NULL GROUP BY station, step) WHERE rn = 1""")
def infer_frequency(t: Tables) -> DataFrame:
    return quality.infer_frequency(t.b4_wide)


@query("missing_report", "b1_sensor", _each(SENSOR, """
    SELECT '{c}' AS "column", count(*) - count({c}) AS missing, round(100.0::DOUBLE * (count(*) - count({c})) / count(*), 2) AS pct FROM b1_sensor"""))
def missing_report(t: Tables) -> DataFrame:
    return quality.missing_report(t.b1_sensor)


@query("missing_by_station", "b1_hourly", """
    SELECT station, count(*) - count(pm2_5) AS missing, count(*) AS n, round(100.0::DOUBLE * (count(*) - count(pm2_5)) / count(*), 2) AS pct
    FROM b1_hourly GROUP BY 1""")
def missing_by_station(t: Tables) -> DataFrame:
    return quality.missing_by_station(t.b1_hourly)


@query("describe_numeric", "b3_daily", _each(B3_CHANNELS, """
    SELECT '{c}' AS channel, count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, round(min({c}), 4) AS min,
           round(quantile_cont({c}, 0.25), 4) AS p25, round(quantile_cont({c}, 0.5), 4) AS p50, round(quantile_cont({c}, 0.75), 4) AS p75,
           round(max({c}), 4) AS max, round(skewness({c}), 4) AS skew FROM b3_daily"""))
def describe_numeric(t: Tables) -> DataFrame:
    return quality.describe_numeric(t.b3_daily, digits=4)


@query("histogram", "b3_daily", """
    WITH long AS (SELECT 'pm2_5' AS channel, pm2_5 AS v FROM b3_daily UNION ALL SELECT 'temp', temp FROM b3_daily
                  UNION ALL SELECT 'co', co FROM b3_daily),
         span AS (SELECT channel, min(v) AS lo, max(v) AS hi FROM long GROUP BY 1),
         n AS (SELECT channel, least(floor((v - lo) * 60 / (hi - lo)), 59) AS bin, count(*) AS n FROM long JOIN span USING (channel) GROUP BY 1, 2)
    SELECT s.channel, CAST(b.bin AS INT) AS bin, round(lo + b.bin * ((hi - lo) / 60), 6) AS left_edge,
           round(lo + (b.bin + 1) * ((hi - lo) / 60), 6) AS right_edge, coalesce(n.n, 0) AS n
    FROM span s CROSS JOIN (SELECT unnest(range(60)) AS bin) b LEFT JOIN n ON n.channel = s.channel AND n.bin = b.bin""")
def histogram(t: Tables) -> DataFrame:
    return rounded(quality.histogram(t.b3_daily, ["pm2_5", "temp", "co"]), ["left_edge", "right_edge"])


@query("constraint_checks", "b4_stations b4_wind b4_poll b4_weather", """
    SELECT 'station_name is unique' AS rule, count(*) AS violations FROM (SELECT 1 FROM b4_stations GROUP BY station_name HAVING count(*) > 1)
    UNION ALL SELECT 'station_id is unique', count(*) FROM (SELECT 1 FROM b4_stations GROUP BY station_id HAVING count(*) > 1)
    UNION ALL SELECT 'wd_code is unique', count(*) FROM (SELECT 1 FROM b4_wind GROUP BY wd_code HAVING count(*) > 1)
    UNION ALL SELECT 'pollutant grain is unique', count(*) FROM (SELECT 1 FROM b4_poll GROUP BY station_id, ts HAVING count(*) > 1)
    UNION ALL SELECT 'weather grain is unique', count(*) FROM (SELECT 1 FROM b4_weather GROUP BY station_id, ts HAVING count(*) > 1)
    UNION ALL SELECT 'pollutant station exists', count(DISTINCT station_id) FROM b4_poll WHERE station_id NOT IN (SELECT station_id FROM b4_stations)
    UNION ALL SELECT 'weather station exists', count(DISTINCT station_id) FROM b4_weather WHERE station_id NOT IN (SELECT station_id FROM b4_stations)
    UNION ALL SELECT 'weather wind exists', count(DISTINCT wind_dir_id) FROM b4_weather WHERE wind_dir_id NOT IN (SELECT wind_dir_id FROM b4_wind)
    UNION ALL SELECT 'station_type is allowed', count(*) FROM b4_stations WHERE station_type NOT IN ('AFRICA', 'AMERICA', 'ASIA', 'EUROPE')
    UNION ALL SELECT 'pollutant row has weather row', count(*) FROM b4_poll p WHERE NOT EXISTS (SELECT 1 FROM b4_weather w WHERE w.station_id = p.station_id AND w.ts = p.ts)
    UNION ALL SELECT 'weather row has pollutant row', count(*) FROM b4_weather w WHERE NOT EXISTS (SELECT 1 FROM b4_poll p WHERE w.station_id = p.station_id AND w.ts = p.ts)""")
def constraint_checks(t: Tables) -> DataFrame:
    """One region is left out of the allowed types, so that a rule has violations to count."""
    return quality.check_constraints(t.b4_star, ("AFRICA", "AMERICA", "ASIA", "EUROPE"))
