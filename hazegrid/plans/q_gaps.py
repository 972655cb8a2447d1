"""Gap filling and outliers."""

from __future__ import annotations

from pyspark.sql import DataFrame

from hazegrid.constants import STATION, TS
from hazegrid.operators import gaps, outliers
from hazegrid.plans.bindings import Tables, rounded
from hazegrid.plans.registry import query

SENSOR = ("pm2_5", "pm10", "so2", "no2", "co", "temp", "wspm")
UP = "(PARTITION BY station ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
ON = "(PARTITION BY station ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"


def _struct(c: str) -> str:
    return f"CASE WHEN {c} IS NOT NULL THEN {{'x': {c}, 't': ts, 'i': rn}} END"


def interpolated_sql(source: str, cols, extra: str = "") -> str:
    """Time interpolation, at most 6 rows from a valid cell."""
    near = ", ".join(f"last_value({_struct(c)} IGNORE NULLS) OVER {UP} AS p_{c}, first_value({_struct(c)} IGNORE NULLS) OVER {ON} AS n_{c}" for c in cols)
    done = ", ".join(
        f"CASE WHEN {c} IS NOT NULL THEN {c} WHEN rn - p_{c}.i <= 6 OR n_{c}.i - rn <= 6 THEN coalesce("
        f"p_{c}.x + (n_{c}.x - p_{c}.x) * date_diff('second', p_{c}.t, ts) / date_diff('second', p_{c}.t, n_{c}.t), p_{c}.x, n_{c}.x) END AS {c}"
        for c in cols)
    return (f"SELECT station, ts{extra}, {done} FROM (SELECT *, {near} FROM "
            f"(SELECT *, row_number() OVER (PARTITION BY station ORDER BY ts) AS rn FROM {source}))")


def filled_sql(source: str, cols, wind: bool = False) -> str:
    def ff(c):
        return f"last_value({c} IGNORE NULLS) OVER {UP}, first_value({c} IGNORE NULLS) OVER {ON}"
    done = ", ".join(f"coalesce({ff(c)}) AS {c}" for c in cols)
    w = f", coalesce({ff('wd')}, 'N') AS wd" if wind else ""
    return f"SELECT station, ts, {done}{w} FROM {source}"


def imputed_sql(source: str, cols) -> str:
    return filled_sql(f"({interpolated_sql(source, cols, ', wd')})", cols, wind=True)


def _r(cols, digits: int = 6) -> str:
    return ", ".join(f"round({c}, {digits}) AS {c}" for c in cols)


@query("interpolate_time", "b1_hourly", f"SELECT station, ts, {_r(['pm2_5'])} FROM ({interpolated_sql('b1_hourly', ['pm2_5'])})")
def interpolate_time(t: Tables) -> DataFrame:
    return rounded(gaps.interpolate_time(t.b1_hourly.select(STATION, TS, "pm2_5"), ["pm2_5"]), ["pm2_5"])


@query("interpolate_time_sensor", "b1_sensor", f"SELECT station, ts, {_r(SENSOR)} FROM ({interpolated_sql('b1_sensor', SENSOR)})")
def interpolate_time_sensor(t: Tables) -> DataFrame:
    return rounded(gaps.interpolate_time(t.b1_sensor.drop("wd"), list(SENSOR)), SENSOR)


@query("ffill_bfill", "b1_sensor", filled_sql("b1_sensor", SENSOR))
def ffill_bfill(t: Tables) -> DataFrame:
    return gaps.ffill_bfill(t.b1_sensor.drop("wd"), list(SENSOR))


@query("fill_categorical", "b1_sensor", f"""
    SELECT station, ts, coalesce(last_value(wd IGNORE NULLS) OVER {UP}, first_value(wd IGNORE NULLS) OVER {ON}, 'N') AS wd FROM b1_sensor""")
def fill_categorical(t: Tables) -> DataFrame:
    return gaps.fill_categorical(t.b1_sensor.select(STATION, TS, "wd"))


@query("impute", "b1_sensor", f"SELECT station, ts, {_r(SENSOR)}, wd FROM ({imputed_sql('b1_sensor', SENSOR)})")
def impute(t: Tables) -> DataFrame:
    return rounded(gaps.impute(t.b1_sensor), SENSOR)


@query("interpolate_linear", "b1_hourly", f"""
    SELECT station, ts, round(CASE WHEN pm2_5 IS NOT NULL THEN pm2_5 WHEN p.i IS NOT NULL THEN
             coalesce(p.x + (q.x - p.x) * (rn - p.i) / (q.i - p.i), p.x) END, 6) AS pm2_5
    FROM (SELECT *, last_value({_struct('pm2_5')} IGNORE NULLS) OVER {UP} AS p, first_value({_struct('pm2_5')} IGNORE NULLS) OVER {ON} AS q
          FROM (SELECT *, row_number() OVER (PARTITION BY station ORDER BY ts) AS rn FROM b1_hourly))""")
def interpolate_linear(t: Tables) -> DataFrame:
    return rounded(gaps.interpolate_linear(t.b1_hourly.select(STATION, TS, "pm2_5"), "pm2_5"), ["pm2_5"])


@query("resample_daily", "b4_wide", """
    WITH m AS (SELECT station, date_trunc('day', ts)::TIMESTAMP AS date, avg(pm2_5) AS v FROM b4_wide GROUP BY 1, 2),
         g AS (SELECT station, unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS date FROM m GROUP BY 1)
    SELECT g.station, g.date, round(m.v, 6) AS pm2_5 FROM g LEFT JOIN m ON m.station = g.station AND m.date = g.date""")
def resample_daily(t: Tables) -> DataFrame:
    return rounded(gaps.resample_daily(t.b4_wide, "pm2_5"), ["pm2_5"])


FENCES = " UNION ALL ".join(
    f"SELECT station, '{c}' AS channel, q1, q3, q3 - q1 AS iqr, q3 + 3 * (q3 - q1) AS fence FROM (SELECT station, "
    f"quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM {{s}} WHERE {c} IS NOT NULL GROUP BY 1)" for c in ("pm2_5", "wspm"))


@query("iqr_fences", "b1_sensor", f"SELECT station, channel, {_r(['q1', 'q3', 'iqr', 'fence'])} FROM ({FENCES.format(s='b1_sensor')})")
def iqr_fences(t: Tables) -> DataFrame:
    return rounded(outliers.fit_fences(t.b1_sensor), ["q1", "q3", "iqr", "fence"])


def capped_sql(source: str, rest: str) -> str:
    cap = ", ".join(f"CASE WHEN f_{c}.iqr > 0 AND s.{c} > f_{c}.fence THEN f_{c}.fence ELSE s.{c} END AS {c}" for c in ("pm2_5", "wspm"))
    joins = " ".join(f"LEFT JOIN (SELECT * FROM fences WHERE channel = '{c}') f_{c} ON f_{c}.station = s.station" for c in ("pm2_5", "wspm"))
    return f"SELECT {rest}, {cap} FROM {source} s {joins}"


# a third of the usual width, so that there is something to cap
@query("cap_outliers", "b3_daily", f"""
    WITH fences AS ({FENCES.format(s='b3_daily').replace('3 * (q3 - q1)', '0.5 * (q3 - q1)')})
    SELECT station, date, round(pm2_5, 6) AS pm2_5, round(wspm, 6) AS wspm FROM ({capped_sql('b3_daily', 's.station, s.date')})""")
def cap_outliers(t: Tables) -> DataFrame:
    d = t.b3_daily.select(STATION, "date", "pm2_5", "wspm")
    return rounded(outliers.cap_outliers(d, outliers.fit_fences(d, k=0.5)), ["pm2_5", "wspm"])


@query("cap_report", "b3_daily", f"""
    WITH fences AS ({FENCES.format(s='b3_daily').replace('3 * (q3 - q1)', '0.5 * (q3 - q1)')})
    SELECT channel, capped, round(100.0::DOUBLE * capped / n, 3) AS pct FROM (
      SELECT f.channel, count(*) FILTER (WHERE f.iqr > 0 AND CASE f.channel WHEN 'pm2_5' THEN b.pm2_5 ELSE b.wspm END > f.fence) AS capped,
             count(*) AS n FROM b3_daily b JOIN fences f ON f.station = b.station GROUP BY 1)""")
def cap_report(t: Tables) -> DataFrame:
    d = t.b3_daily.select(STATION, "date", "pm2_5", "wspm")
    return outliers.cap_report(d, outliers.fit_fences(d, k=0.5))
