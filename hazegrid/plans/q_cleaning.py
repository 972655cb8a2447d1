"""Projections, predicates and cleaning."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from hazegrid.constants import STATION, TS
from hazegrid.functions import clock
from hazegrid.functions.category import category, category_ordinal
from hazegrid.operators.cleaning import add_datetime, clean, coerce_numeric, dedup_first, null_negatives
from hazegrid.operators.features import add_time_features
from hazegrid.plans.bindings import CATEGORY_SQL, LABEL_SQL, Tables, r
from hazegrid.plans.registry import query

NUMERIC = ["pm2_5", "pm10", "temp"]


@query("add_datetime", "b2_typed", "SELECT no, station, ts FROM b2_typed")
def add_datetime_query(t: Tables) -> DataFrame:
    return add_datetime(t.b2_raw).select("no", STATION, TS)


@query("coerce_numeric", "b2_typed", "SELECT no, station, pm2_5, pm10, temp FROM b2_typed")
def coerce_numeric_query(t: Tables) -> DataFrame:
    return coerce_numeric(t.b2_raw, NUMERIC).select("no", STATION, *NUMERIC)


@query("null_negatives", "b2_typed", """
    SELECT no, station, CASE WHEN pm2_5 >= 0 THEN pm2_5 END AS pm2_5, CASE WHEN pm10 >= 0 THEN pm10 END AS pm10, temp FROM b2_typed""")
def null_negatives_query(t: Tables) -> DataFrame:
    return null_negatives(coerce_numeric(t.b2_raw, NUMERIC), ["pm2_5", "pm10"]).select("no", STATION, *NUMERIC)


@query("dedup_first", "b2_raw", """
    SELECT no, station, year, month, day, hour, pm2_5, pm10, temp, wd FROM (
      SELECT *, row_number() OVER (PARTITION BY station, year, month, day, hour
             ORDER BY no, pm2_5 NULLS LAST, pm10 NULLS LAST, temp NULLS LAST, wd NULLS LAST) AS rn FROM b2_raw) WHERE rn = 1""")
def dedup_first_query(t: Tables) -> DataFrame:
    keys = [STATION, "year", "month", "day", "hour"]
    return dedup_first(t.b2_raw, keys, ["no", "pm2_5", "pm10", "temp", "wd"]).select("no", *keys, "pm2_5", "pm10", "temp", "wd")


@query("clean", "b2_clean", "SELECT no, station, ts, pm2_5, pm10, temp, wd FROM b2_clean")
def clean_query(t: Tables) -> DataFrame:
    return clean(t.b2_raw).select("no", STATION, TS, *NUMERIC, "wd")


@query("time_features", "b1_hourly", """
    SELECT station, ts, CAST(hour(ts) AS INT) AS hour, CAST(isodow(ts) - 1 AS INT) AS dayofweek, CAST(month(ts) AS INT) AS month,
           CAST(isodow(ts) >= 6 AS INT) AS is_weekend, CAST(month(ts) IN (11, 12, 1, 2, 3) AS INT) AS is_heating_season,
           CASE WHEN month(ts) IN (12, 1, 2) THEN 'Winter' WHEN month(ts) IN (3, 4, 5) THEN 'Spring'
                WHEN month(ts) IN (6, 7, 8) THEN 'Summer' ELSE 'Autumn' END AS season FROM b1_hourly""")
def time_features(t: Tables) -> DataFrame:
    return add_time_features(t.b1_hourly).select(STATION, TS, "hour", "dayofweek", "month", "is_weekend", "is_heating_season", "season")


@query("cyclical_features", "b4_wide", """
    SELECT station, ts, round(sin(2 * pi() * hour(ts) / 24), 6) AS hour_sin, round(cos(2 * pi() * hour(ts) / 24), 6) AS hour_cos,
           round(sin(2 * pi() * month(ts) / 12), 6) AS month_sin, round(cos(2 * pi() * month(ts) / 12), 6) AS month_cos
    FROM (SELECT station, ts + INTERVAL 1 HOUR * CAST(o3 AS INT) AS ts FROM b4_wide)""")
def cyclical_features(t: Tables) -> DataFrame:
    shifted = t.b4_wide.select(STATION, (F.col(TS) + F.make_dt_interval(F.lit(0), F.col("o3").cast("int"))).alias(TS))
    f = add_time_features(shifted)
    return f.select(STATION, TS, *[r(c).alias(c) for c in ("hour_sin", "hour_cos", "month_sin", "month_cos")])


@query("aqi_category", "b3_daily", f"""
    SELECT station, date, pm2_5, o AS ordinal, {LABEL_SQL.format('o')} AS label
    FROM (SELECT station, date, pm2_5, {CATEGORY_SQL.format('pm2_5')} AS o FROM b3_daily)""")
def aqi_category(t: Tables) -> DataFrame:
    v = F.col("pm2_5")
    return t.b3_daily.select(STATION, "date", "pm2_5", category_ordinal(v).alias("ordinal"), category(v).alias("label"))


@query("range_predicate", "", """
    SELECT l_orderkey, l_shipdate, l_quantity FROM lineitem
    WHERE l_shipdate BETWEEN TIMESTAMP '1999-01-01' AND TIMESTAMP '1999-06-30'""")
def range_predicate(t: Tables) -> DataFrame:
    lo, hi = (F.lit(d).cast(clock.NTZ) for d in ("1999-01-01 00:00:00", "1999-06-30 00:00:00"))
    return t.table("lineitem", "l_orderkey", "l_shipdate", "l_quantity").where(F.col("l_shipdate").between(lo, hi))


@query("fn_date", "b4_wide", """
    SELECT station, ts, date_trunc('month', ts) AS month_start, strftime(ts, '%Y-%m') AS month, CAST(dayofyear(ts) AS INT) AS doy,
           ts - INTERVAL 4 MONTH AS months_back, ts - INTERVAL 200 DAY AS days_back, ts + INTERVAL 6 HOUR AS hours_on FROM b4_wide""")
def fn_date(t: Tables) -> DataFrame:
    ts = F.col(TS)
    return t.b4_wide.select(STATION, TS, clock.truncate("month", ts).alias("month_start"), F.date_format(ts, "yyyy-MM").alias("month"),
                            F.dayofyear(ts).alias("doy"), (ts - F.make_ym_interval(F.lit(0), F.lit(4))).alias("months_back"),
                            (ts - F.make_dt_interval(F.lit(200))).alias("days_back"), (ts + F.expr("INTERVAL 6 HOURS")).alias("hours_on"))


@query("fn_math", "b3_daily", """
    SELECT station, date, round(sin(temp), 6) AS s, round(cos(temp), 6) AS c, round(sqrt(pm2_5), 6) AS q, round(exp(-wspm), 6) AS e,
           least(pm2_5, 100.0) AS clipped, abs(dewp - wspm) AS gap, CAST(month(date) % 12 // 3 AS INT) AS slot FROM b3_daily""")
def fn_math(t: Tables) -> DataFrame:
    return t.b3_daily.select(STATION, "date", r(F.sin("temp")).alias("s"), r(F.cos("temp")).alias("c"), r(F.sqrt("pm2_5")).alias("q"),
                             r(F.exp(-F.col("wspm"))).alias("e"), F.least("pm2_5", F.lit(100.0)).alias("clipped"),
                             F.abs(F.col("dewp") - F.col("wspm")).alias("gap"),
                             F.floor((F.month("date") % 12) / 3).cast("int").alias("slot"))


@query("fn_string", "b4_wide", """
    SELECT station, ts, lower(wd) AS lowered, replace(lower(wd), '#', '_') AS name, split_part(station, '#', 1) AS head,
           station || ' @ ' || strftime(ts, '%Y-%m-%d %H:%M:%S') AS label, coalesce(wd, 'N') AS filled FROM b4_wide""")
def fn_string(t: Tables) -> DataFrame:
    return t.b4_wide.select(STATION, TS, F.lower("wd").alias("lowered"), F.replace(F.lower("wd"), F.lit("#"), F.lit("_")).alias("name"),
                            F.split_part(STATION, F.lit("#"), F.lit(1)).alias("head"),
                            F.concat(STATION, F.lit(" @ "), F.date_format(TS, "yyyy-MM-dd HH:mm:ss")).alias("label"),
                            F.coalesce("wd", F.lit("N")).alias("filled"))
