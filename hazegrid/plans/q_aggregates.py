"""Aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame

from hazegrid.constants import STATION, TS
from hazegrid.operators import aggregates
from hazegrid.plans.bindings import B3_CHANNELS, Tables, rounded
from hazegrid.plans.q_gaps import ON, UP, _struct
from hazegrid.plans.registry import query

SEASON = ("CASE WHEN month(ts) IN (12, 1, 2) THEN 'Winter' WHEN month(ts) IN (3, 4, 5) THEN 'Spring' "
          "WHEN month(ts) IN (6, 7, 8) THEN 'Summer' ELSE 'Autumn' END")


@query("daily_means", "b1_sensor", """
    SELECT station, date_trunc('day', ts)::TIMESTAMP AS date, round(avg(pm2_5), 6) AS pm2_5, round(avg(pm10), 6) AS pm10, round(avg(co), 6) AS co,
           round(avg(wspm), 6) AS wspm FROM b1_sensor GROUP BY 1, 2""")
def daily_means(t: Tables) -> DataFrame:
    return rounded(aggregates.daily_means(t.b1_sensor).select(STATION, "date", "pm2_5", "pm10", "co", "wspm"), ["pm2_5", "pm10", "co", "wspm"])


@query("monthly_trend", "b4_wide", """
    WITH m AS (SELECT date_trunc('month', ts)::TIMESTAMP AS month, avg(pm2_5) AS v FROM b4_wide GROUP BY 1)
    SELECT month, round(v, 6) AS avg_pm2_5, round(CASE WHEN count(v) OVER w >= 6 THEN avg(v) OVER w END, 6) AS ma6 FROM m
    WINDOW w AS (ORDER BY month ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)""")
def monthly_trend(t: Tables) -> DataFrame:
    return rounded(aggregates.monthly_trend(t.b4_wide), ["avg_pm2_5", "ma6"])


@query("season_means", "b4_wide", f"SELECT {SEASON} AS season, round(avg(pm2_5), 6) AS avg_pm2_5 FROM b4_wide GROUP BY 1")
def season_means(t: Tables) -> DataFrame:
    return rounded(aggregates.season_means(t.b4_wide), ["avg_pm2_5"])


@query("season_extremes", "b4_wide", f"""
    WITH m AS (SELECT {SEASON} AS season, avg(pm2_5) AS v FROM b4_wide GROUP BY 1)
    SELECT arg_max(season, v) AS highest, round(max(v), 6) AS highest_mean, arg_min(season, v) AS lowest, round(min(v), 6) AS lowest_mean,
           round(max(v) / min(v), 6) AS ratio FROM m""")
def season_extremes(t: Tables) -> DataFrame:
    return rounded(aggregates.season_extremes(t.b4_wide), ["highest_mean", "lowest_mean", "ratio"])


@query("climatology", "b4_wide", "SELECT CAST(month(ts) AS INT) AS month, round(avg(pm2_5), 6) AS avg_pm2_5 FROM b4_wide GROUP BY 1")
def climatology(t: Tables) -> DataFrame:
    return rounded(aggregates.climatology(t.b4_wide), ["avg_pm2_5"])


@query("diurnal_pivot", "b1_hourly", """
    SELECT CAST(hour(ts) AS INT) AS hour, round(avg(pm2_5) FILTER (WHERE isodow(ts) < 6), 6) AS weekday,
           round(avg(pm2_5) FILTER (WHERE isodow(ts) >= 6), 6) AS weekend FROM b1_hourly GROUP BY 1""")
def diurnal_pivot(t: Tables) -> DataFrame:
    return rounded(aggregates.diurnal_profile(t.b1_hourly), ["weekday", "weekend"])


@query("diurnal_extremes", "b1_hourly", """
    WITH m AS (SELECT CAST(hour(ts) AS INT) AS hour, avg(pm2_5) FILTER (WHERE isodow(ts) < 6) AS v FROM b1_hourly GROUP BY 1)
    SELECT (SELECT hour FROM m WHERE v IS NOT NULL ORDER BY v DESC, hour LIMIT 1) AS peak_hour,
           (SELECT hour FROM m WHERE v IS NOT NULL ORDER BY v, hour LIMIT 1) AS trough_hour""")
def diurnal_extremes(t: Tables) -> DataFrame:
    return aggregates.diurnal_extremes(t.b1_hourly)


@query("station_means", "b4_wide", "SELECT station, round(avg(pm2_5), 6) AS avg_pm2_5 FROM b4_wide GROUP BY 1")
def station_means(t: Tables) -> DataFrame:
    return rounded(aggregates.station_means(t.b4_wide), ["avg_pm2_5"])


@query("station_extremes", "b4_wide", """
    WITH m AS (SELECT station, avg(pm2_5) AS v FROM b4_wide GROUP BY 1)
    SELECT arg_max(station, v) AS dirtiest, round(max(v), 6) AS dirtiest_mean, arg_min(station, v) AS cleanest,
           round(min(v), 6) AS cleanest_mean, round(max(v) - min(v), 6) AS gap FROM m""")
def station_extremes(t: Tables) -> DataFrame:
    return rounded(aggregates.station_extremes(t.b4_wide), ["dirtiest_mean", "cleanest_mean", "gap"])


@query("corr_matrix", "b3_daily", " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM b3_daily" for a in B3_CHANNELS for b in B3_CHANNELS))
def corr_matrix(t: Tables) -> DataFrame:
    return rounded(aggregates.corr_matrix(t.b3_daily), ["r"])


@query("corr_drivers", "b3_daily", f"""
    WITH c AS ({' UNION ALL '.join(f"SELECT '{c}' AS channel, corr(pm2_5, {c}) AS r FROM b3_daily" for c in B3_CHANNELS if c != 'pm2_5')})
    SELECT arg_max(channel, r) AS strongest_positive, round(max(r), 6) AS max_r, arg_min(channel, r) AS strongest_negative,
           round(min(r), 6) AS min_r FROM c""")
def corr_drivers(t: Tables) -> DataFrame:
    return rounded(aggregates.corr_drivers(t.b3_daily), ["max_r", "min_r"])


@query("lag_corr", "b1_hourly", " UNION ALL ".join(
    f"SELECT station, {k} AS lag, round(corr(pm2_5, x), 6) AS r FROM (SELECT station, pm2_5, lag(pm2_5, {k}) OVER (PARTITION BY station ORDER BY ts) AS x "
    f"FROM b1_hourly) GROUP BY 1" for k in (1, 24, 168)))
def lag_corr(t: Tables) -> DataFrame:
    return rounded(aggregates.lag_corr(t.b1_hourly), ["r"])


@query("acf", "b1_hourly", f"""
    WITH f AS (SELECT station, ts, CASE WHEN pm2_5 IS NOT NULL THEN pm2_5 WHEN p.i IS NOT NULL THEN
                 coalesce(p.x + (q.x - p.x) * (rn - p.i) / (q.i - p.i), p.x) END AS x
               FROM (SELECT *, last_value({_struct('pm2_5')} IGNORE NULLS) OVER {UP} AS p, first_value({_struct('pm2_5')} IGNORE NULLS) OVER {ON} AS q
                     FROM (SELECT *, row_number() OVER (PARTITION BY station ORDER BY ts) AS rn FROM b1_hourly))),
         c AS (SELECT station, x - avg(x) OVER (PARTITION BY station) AS x, row_number() OVER (PARTITION BY station ORDER BY ts) AS rn
               FROM f WHERE x IS NOT NULL),
         v AS (SELECT station, sum(x * x) AS v FROM c GROUP BY 1),
         s AS (SELECT a.station, k.lag, sum(a.x * b.x) AS s FROM (SELECT unnest(range(201)) AS lag) k, c a, c b
               WHERE b.station = a.station AND b.rn = a.rn - k.lag GROUP BY 1, 2)
    SELECT v.station, CAST(s.lag AS INT) AS lag, round(s.s / v.v, 6) AS acf FROM v JOIN s USING (station)""")
def acf(t: Tables) -> DataFrame:
    return rounded(aggregates.acf(t.b1_hourly.select(STATION, TS, "pm2_5")), ["acf"])


@query("class_counts", "b6_scored six", "SELECT six.y, count(b.y) AS n FROM six LEFT JOIN b6_scored b ON b.y = six.y GROUP BY 1")
def class_counts(t: Tables) -> DataFrame:
    return aggregates.class_counts(t.b6_scored)
