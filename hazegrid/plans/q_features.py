"""Window features."""

from __future__ import annotations

from pyspark.sql import DataFrame

from hazegrid.constants import HOURLY_LAGS, HOURLY_WINDOWS, STATION, TS
from hazegrid.operators import features
from hazegrid.operators.gaps import resample_daily as densify
from hazegrid.operators.ordered import DAILY
from hazegrid.plans.bindings import CATEGORY_SQL, Tables, rounded
from hazegrid.plans.q_gaps import FENCES, _r, capped_sql, imputed_sql
from hazegrid.plans.registry import query

W = "PARTITION BY station ORDER BY {o}"
LAGS = ", ".join(f"lag(pm2_5, {k}) OVER (PARTITION BY station ORDER BY ts) AS pm2_5_lag{k}" for k in HOURLY_LAGS)


def past(fn: str, name: str) -> str:
    out = []
    for n in HOURLY_WINDOWS:
        w = f"OVER (PARTITION BY station ORDER BY ts ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
        out.append(f"round(CASE WHEN count(pm2_5) {w} >= {max(2, n // 4)} THEN {fn}(pm2_5) {w} END, 6) AS pm2_5_{name}{n}")
    return ", ".join(out)


def incl(fn: str, n: int, least: int, order: str = "date", col: str = "pm2_5") -> str:
    w = f"OVER (PARTITION BY station ORDER BY {order} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN count({col}) {w} >= {least} THEN {fn}({col}) {w} END"


@query("lag_features", "b1_hourly", f"SELECT station, ts, pm2_5, {LAGS} FROM b1_hourly")
def lag_features(t: Tables) -> DataFrame:
    return features.add_lag_features(t.b1_hourly.select(STATION, TS, "pm2_5"))


@query("moving_average", "b1_hourly", f"SELECT station, ts, {past('avg', 'ma')} FROM b1_hourly")
def moving_average(t: Tables) -> DataFrame:
    d = features.add_moving_averages(t.b1_hourly.select(STATION, TS, "pm2_5"), std=False)
    return rounded(d.drop("pm2_5"), d.columns[3:])


@query("moving_std", "b1_hourly", f"SELECT station, ts, {past('stddev_samp', 'mstd')} FROM b1_hourly")
def moving_std(t: Tables) -> DataFrame:
    d = features.add_moving_averages(t.b1_hourly.select(STATION, TS, "pm2_5"), mean=False)
    return rounded(d.drop("pm2_5"), d.columns[3:])


@query("rolling_daily", "b3_daily", f"""
    SELECT station, date, round({incl('avg', 7, 3)}, 6) AS pm2_5_roll7_mean, round({incl('stddev_samp', 7, 3)}, 6) AS pm2_5_roll7_std,
           round({incl('avg', 30, 10)}, 6) AS pm2_5_roll30_mean, round({incl('stddev_samp', 30, 10)}, 6) AS pm2_5_roll30_std FROM b3_daily""")
def rolling_daily(t: Tables) -> DataFrame:
    d = features.rolling_stats(t.b3_daily.select(STATION, "date", "pm2_5"), "pm2_5", ((7, 3), (30, 10)))
    return rounded(d.drop("pm2_5"), d.columns[3:])


@query("weekly_deviation", "b3_daily", f"SELECT station, date, round(pm2_5 - {incl('avg', 7, 3)}, 6) AS pm_dev7 FROM b3_daily")
def weekly_deviation(t: Tables) -> DataFrame:
    return rounded(features.deviation(t.b3_daily.select(STATION, "date", "pm2_5"), "pm2_5").drop("pm2_5"), ["pm_dev7"])


@query("rolling_full", "b1_hourly", f"""
    WITH part AS (SELECT station, ts, pm2_5 FROM b1_hourly WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-26')
    SELECT station, ts, pm2_5, round({incl('avg', 24, 24, 'ts')}, 6) AS pm2_5_ma24, round({incl('avg', 168, 168, 'ts')}, 6) AS pm2_5_ma168 FROM part""")
def rolling_full(t: Tables) -> DataFrame:
    part = features.date_slice(t.b1_hourly.select(STATION, TS, "pm2_5"), "2024-01-05", "2024-01-25")
    return rounded(features.rolling_full(part, "pm2_5", (24, 168)), ["pm2_5_ma24", "pm2_5_ma168"])


@query("rolling_full_daily", "b4_wide", f"""
    WITH m AS (SELECT station, date_trunc('day', ts)::TIMESTAMP AS date, avg(pm2_5) AS v FROM b4_wide GROUP BY 1, 2),
         g AS (SELECT station, unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS date FROM m GROUP BY 1),
         d AS (SELECT g.station, g.date, m.v AS pm2_5 FROM g LEFT JOIN m ON m.station = g.station AND m.date = g.date)
    SELECT station, date, round(pm2_5, 6) AS pm2_5, round({incl('avg', 30, 30)}, 6) AS pm2_5_ma30 FROM d""")
def rolling_full_daily(t: Tables) -> DataFrame:
    """Daily means of every station with their 30-day moving average."""
    d = features.rolling_full(densify(t.b4_wide, "pm2_5"), "pm2_5", (30,), DAILY)
    return rounded(d, ["pm2_5", "pm2_5_ma30"])


@query("next_day_label", "b3_daily", f"""
    SELECT station, date, lead({CATEGORY_SQL.format('pm2_5')}) OVER (PARTITION BY station ORDER BY date) AS y FROM b3_daily""")
def next_day_label(t: Tables) -> DataFrame:
    return features.next_label(t.b3_daily.select(STATION, "date", "pm2_5")).drop("pm2_5")


@query("smoothing_std", "b1_hourly", f"""
    SELECT station, round(stddev_samp(pm2_5), 6) AS raw_std, round(stddev_samp(ma), 6) AS ma_std
    FROM (SELECT station, pm2_5, {incl('avg', 24, 24, 'ts')} AS ma FROM b1_hourly) GROUP BY 1""")
def smoothing_std(t: Tables) -> DataFrame:
    return rounded(features.smoothing_std(t.b1_hourly), ["raw_std", "ma_std"])


SENSOR = ("pm2_5", "wspm", "temp")


@query("build_features", "b1_sensor", f"""
    WITH clean AS (SELECT station, ts, CASE WHEN pm2_5 >= 0 THEN pm2_5 END AS pm2_5, CASE WHEN wspm >= 0 THEN wspm END AS wspm, temp, wd FROM b1_sensor),
         imputed AS ({imputed_sql('clean', SENSOR)}),
         fences AS ({FENCES.format(s='imputed')}),
         capped AS ({capped_sql('imputed', 's.station, s.ts, s.temp, s.wd')})
    SELECT station, ts, {_r(SENSOR)}, wd, CAST(hour(ts) AS INT) AS hour, CAST(isodow(ts) >= 6 AS INT) AS is_weekend,
           {', '.join(f'round(lag(pm2_5, {k}) OVER (PARTITION BY station ORDER BY ts), 6) AS pm2_5_lag{k}' for k in HOURLY_LAGS)},
           {past('avg', 'ma')}, {past('stddev_samp', 'mstd')} FROM capped""")
def build_features(t: Tables) -> DataFrame:
    d = features.build_features(t.b1_sensor.select(STATION, TS, *SENSOR, "wd"))
    made = [c for c in d.columns if "_lag" in c or "_ma" in c or "_mstd" in c]
    return rounded(d.select(STATION, TS, *SENSOR, "wd", "hour", "is_weekend", *made), [*SENSOR, *made])


CLEANED = "SELECT station, ts, CASE WHEN pm2_5 >= 0 THEN pm2_5 END AS pm2_5, CASE WHEN wspm >= 0 THEN wspm END AS wspm, temp, wd FROM b1_sensor"


def features_sql(source: str) -> str:
    return f"""
    SELECT station, ts, {_r(SENSOR)}, wd, CAST(hour(ts) AS INT) AS hour, CAST(isodow(ts) >= 6 AS INT) AS is_weekend,
           {', '.join(f'round(lag(pm2_5, {k}) OVER (PARTITION BY station ORDER BY ts), 6) AS pm2_5_lag{k}' for k in HOURLY_LAGS)},
           {past('avg', 'ma')}, {past('stddev_samp', 'mstd')} FROM {source}"""


def shown_features(t: Tables, **switches: bool) -> DataFrame:
    d = features.build_features(t.b1_sensor.select(STATION, TS, *SENSOR, "wd"), **switches)
    made = [c for c in d.columns if "_lag" in c or "_ma" in c or "_mstd" in c]
    return rounded(d.select(STATION, TS, *SENSOR, "wd", "hour", "is_weekend", *made), [*SENSOR, *made])


@query("build_features_raw", "b1_sensor", f"WITH clean AS ({CLEANED}) {features_sql('clean')}")
def build_features_raw(t: Tables) -> DataFrame:
    """Neither filled nor capped."""
    return shown_features(t, do_impute=False, do_cap=False)


@query("build_features_uncapped", "b1_sensor", f"WITH clean AS ({CLEANED}), imputed AS ({imputed_sql('clean', SENSOR)}) {features_sql('imputed')}")
def build_features_uncapped(t: Tables) -> DataFrame:
    """Filled, but not capped."""
    return shown_features(t, do_cap=False)
