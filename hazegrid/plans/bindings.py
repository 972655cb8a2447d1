"""The test tables seen as station readings.

Each binding exists twice: as DataFrame code (``Tables``) and as SQL text for the independent check
(``SQL``). Both take whole tables. Station and wind ids come from the keys the tables have, so no
binding numbers its rows.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hazegrid.constants import DATE, FEATURES, N_CLASSES, STATION, TS
from hazegrid.functions import clock
from hazegrid.functions.category import category_ordinal
from hazegrid.learning.dataset import from_daily, temporal_split
from hazegrid.operators.cleaning import dedup_first
from hazegrid.operators.documents import to_documents
from hazegrid.operators.ordered import DAILY, over_rows
from hazegrid.session import prepare, settle
from hazegrid.sources.tables import read_table

STEPS = (6, 24, 45, 103, 200, 320)      # class centres of the made-up scores

# Fixed weights of the scoring checks.
WEIGHTS = ([[((i * 7 + c * 3) % 11 - 5) / 10.0 for i in range(len(FEATURES))] for c in range(N_CLASSES)],
           [(c - 2.5) / 5.0 for c in range(N_CLASSES)])

B3_CHANNELS = ("pm2_5", "pm10", "so2", "no2", "co", "o3", "temp", "pres", "dewp", "rain", "wspm")


def r(c: Column | str, digits: int = 6) -> Column:
    return F.round(c, digits)


def made(c: Column, by: float = 3.07) -> Column:
    """A made-up reading. The last division leaves values without a short decimal form, so that no mean of a few
    of them lies half-way between two rounded numbers, where engines differ."""
    return F.round(c / by, 4) / 1.0007


def rounded(df: DataFrame, cols, digits: int = 6) -> DataFrame:
    cols = set(cols)
    return df.select(*[r(c, digits).alias(c) if c in cols else F.col(c) for c in df.columns])


#: Rows of a dimension that is sent to all tasks, at most.
BROADCAST_ROWS = 400_000


def small(df: DataFrame) -> DataFrame:
    """``df``, to be broadcast if it has no more than BROADCAST_ROWS rows: the readings that meet it stay where they are. A larger
    one is joined by shuffle. Counts it."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


class Tables:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = prepare(spark), folder

    def table(self, name: str, *cols: str) -> DataFrame:
        return read_table(self.spark, self.folder, name, list(cols) or None)

    def _grid(self, stations: DataFrame, events: DataFrame) -> DataFrame:
        """Every hour between the first and the last event for each station."""
        span = events.agg(F.struct(F.min(clock.truncate("hour", F.col(TS))).alias("lo"),
                                   F.max(clock.truncate("hour", F.col(TS))).alias("hi"))).scalar()
        return stations.select(STATION, F.explode(F.sequence(span["lo"], span["hi"], F.expr("INTERVAL 1 HOUR"))).alias(TS))

    @cached_property
    def b1_hourly(self) -> DataFrame:
        e = self.table("events", "ts", "event_type", "value")
        hour = clock.truncate("hour", F.col(TS))
        m = e.groupBy(F.col("event_type").alias(STATION), hour.alias(TS)).agg(
            made(F.avg("value")).alias("pm2_5"), F.count(F.lit(1)).alias("n"))
        grid = self._grid(e.select(F.col("event_type").alias(STATION)).distinct(), e)
        return grid.join(m, [STATION, TS], "left").select(STATION, TS, "pm2_5", "n")

    @cached_property
    def b1_sensor(self) -> DataFrame:
        e = self.table("events", "ts", "user_id", "event_type", "value").withColumn(
            STATION, F.concat(F.lit("S"), (F.col("user_id") % 12).cast("string")))

        def mean(kind: str) -> Column:
            return made(F.avg(F.when(F.col("event_type") == kind, F.col("value"))))

        m = e.groupBy(STATION, clock.truncate("hour", F.col(TS)).alias(TS)).agg(
            mean("view").alias("pm2_5"), mean("click").alias("pm10"), mean("error").alias("so2"),
            mean("purchase").alias("no2"), mean("signup").alias("co"),
            made(F.max("value") - 50).alias("temp"), made(F.min("value"), 30.7).alias("wspm"),
            F.min("event_type").alias("wd"))
        return self._grid(e.select(STATION).distinct(), e).join(m, [STATION, TS], "left").select(
            STATION, TS, "pm2_5", "pm10", "so2", "no2", "co", "temp", "wspm", "wd")

    @cached_property
    def b2_raw(self) -> DataFrame:
        text = lambda c: c.cast("string")
        l = self.table("lineitem")
        pm = (F.when(F.col("l_partkey") % 11 == 0, "NA").when(F.col("l_partkey") % 97 == 0, "abc")
              .when(F.col("l_tax") == 0, text(-F.col("l_quantity"))).otherwise(text(F.col("l_quantity") * 6)))
        return l.select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("no"),
            F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("month"), F.day("l_shipdate").alias("day"),
            F.col("l_linenumber").alias("hour"), pm.alias("pm2_5"),
            F.when(F.col("l_suppkey") % 13 != 0, text(F.col("l_extendedprice"))).alias("pm10"),
            text(F.col("l_discount") * 100 - 2).alias("temp"),
            F.when(F.col("l_partkey") % 7 != 0, F.col("l_returnflag")).alias("wd"),
            F.concat(F.lit("S"), text(F.col("l_suppkey") % 12)).alias(STATION))

    @cached_property
    def b3_daily(self) -> DataFrame:
        l = self.table("lineitem")
        return l.groupBy(F.concat("l_returnflag", "l_linestatus").alias(STATION), F.col("l_shipdate").alias(DATE)).agg(
            made(F.avg("l_extendedprice"), 307).alias("pm2_5"), made(F.avg("l_quantity")).alias("pm10"),
            made(F.avg("l_discount") * 100).alias("so2"), made(F.avg("l_tax") * 100).alias("no2"),
            made(F.sum("l_extendedprice"), 307).alias("co"), F.count(F.lit(1)).cast("double").alias("o3"),
            made(F.avg("l_partkey"), 307).alias("temp"), (1000 + made(F.avg("l_suppkey"), 307)).alias("pres"),
            F.round(F.min("l_discount") * 100, 4).alias("dewp"),
            F.round(F.coalesce(F.sum(F.when(F.col("l_discount") == 0, F.col("l_quantity"))), F.lit(0.0)), 4).alias("rain"),
            F.round(F.max("l_tax") * 100, 4).alias("wspm"))

    @cached_property
    def b3_hourly(self) -> DataFrame:
        """The daily rows as readings taken at midnight."""
        return self.b3_daily.withColumnRenamed(DATE, TS)

    @cached_property
    def places(self) -> DataFrame:
        return (self.table("supplier").join(self.table("nation"), F.col("n_nationkey") == F.col("s_nationkey"))
                .join(self.table("region"), F.col("r_regionkey") == F.col("n_regionkey")))

    @cached_property
    def b4_stations(self) -> DataFrame:
        return self.places.select(
            (F.col("s_suppkey") + 1).cast("int").alias("station_id"), F.col("s_name").alias("station_name"),
            F.col("r_name").alias("station_type"), (F.col("s_acctbal") / 1000).cast("decimal(8,5)").alias("latitude"),
            F.col("s_nationkey").cast("decimal(8,5)").alias("longitude"))

    @cached_property
    def b4_wide(self) -> DataFrame:
        l = self.table("lineitem").drop("l_returnflag", "l_linestatus")
        one = dedup_first(l, ["l_suppkey", "l_shipdate"], ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity",
                                                          "l_extendedprice", "l_discount", "l_tax"])
        q, d = F.col("l_quantity"), F.col("l_discount")
        return (one.join(self.table("part", "p_partkey", "p_brand", "p_size"), F.col("p_partkey") == F.col("l_partkey"))
                .join(small(self.places.select("s_suppkey", "s_name", "r_name")), F.col("s_suppkey") == F.col("l_suppkey")).select(
            F.col("s_name").alias(STATION), F.col("r_name").alias("station_type"), F.col("l_shipdate").alias(TS),
            (F.col("l_extendedprice") / 307.0009).alias("pm2_5"), q.alias("pm10"), d.alias("so2"),
            F.col("l_tax").alias("no2"), F.col("l_extendedprice").alias("co"), F.col("l_linenumber").cast("double").alias("o3"),
            (q - 10).alias("temp"), (1000 + q).alias("pres"), (d * 10).alias("dewp"), F.col("l_tax").alias("rain"),
            F.round(F.col("l_tax") * 50, 4).alias("wspm"), F.when(F.col("p_size") <= 40, F.col("p_brand")).alias("wd")))

    @cached_property
    def b4_wind(self) -> DataFrame:
        codes = self.b4_wide.select(F.col("wd").alias("wd_code")).where("wd IS NOT NULL").distinct()
        return codes.select(F.substring("wd_code", 7, 9).cast("int").alias("wind_dir_id"), "wd_code",
                            F.concat(F.lit("Label "), F.col("wd_code")).alias("wd_label"))

    @cached_property
    def b4_star(self) -> dict[str, DataFrame]:
        w = self.b4_wide.join(self.b4_stations.select("station_id", "station_name"), F.col("station_name") == F.col(STATION))
        wx = w.join(self.b4_wind, F.col("wd_code") == F.col("wd"), "left")
        return {"stations": self.b4_stations, "wind_directions": self.b4_wind,
                "pollutant_readings": w.select("station_id", TS, "pm2_5", "pm10", "so2", "no2", "co", "o3"),
                "weather_readings": wx.select("station_id", TS, "temp", "pres", "dewp", "rain", "wspm", "wind_dir_id")}

    @cached_property
    def b4_readings(self) -> DataFrame:
        return self.b4_wide.select(STATION, TS, "pm2_5", "pm10", "so2", "no2", "co", "o3")

    @cached_property
    def b4_docs(self) -> DataFrame:
        return to_documents(self.b4_wide.drop("station_type"), small(self.b4_stations))

    @cached_property
    def b5_requests(self) -> DataFrame:
        """One request per order line, numbered by its key, part and day (the tables repeat line numbers): status F
        asks for an existing hour, the others for one half a day later; low priorities name an unknown station."""
        l = self.table("lineitem", "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_tax")
        j = l.join(self.table("orders"), F.col("o_orderkey") == F.col("l_orderkey"))
        return j.select(
            (((F.col("l_orderkey") * 10 + F.col("l_linenumber")) * 1_000_000 + F.col("l_partkey")) * 10_000
             + F.datediff(F.col("l_shipdate").cast("date"), F.lit("1990-01-01").cast("date"))).alias("req_id"),
            F.when(F.col("o_orderpriority") == "5-LOW", "nowhere")
            .otherwise(F.concat(F.lit("Supplier#"), F.lpad(F.col("l_suppkey").cast("string"), 9, "0"))).alias(STATION),
            F.when(F.col("o_orderstatus") == "F", F.col("l_shipdate"))
            .otherwise(F.col("l_shipdate") + F.expr("INTERVAL 12 HOURS")).alias(TS),
            F.col("l_quantity").alias("pm2_5"), F.when(F.col("l_linenumber") != 1, F.col("l_tax")).alias("pm10"),
            F.col("o_orderpriority").alias("priority"))

    @cached_property
    def b5_doc_requests(self) -> DataFrame:
        """The requests as document updates: some set leaves, urgent ones replace the weather."""
        q = self.b5_requests.withColumnRenamed(TS, "timestamp")
        urgent = F.col("priority") == "1-URGENT"
        one = lambda path, value: F.struct(F.lit(path).alias("path"), value.alias("value"))
        num = F.col("pm2_5").cast("string")
        sets = F.array(one("pollutants.pm2_5", num), one("pollutants.pm10", F.col("pm10").cast("string")),
                       F.when(urgent, one("weather", F.concat(F.lit('{"temp": '), num, F.lit("}")))),
                       F.when(~urgent, one("weather.wind_dir", F.lit('"NEW"'))), one("station", F.lit('"other"')))
        return (q.select("req_id", STATION, "timestamp", F.explode(F.array_compact(sets)).alias("s"))
                .select("req_id", STATION, "timestamp", "s.path", "s.value"))

    @cached_property
    def b6_scored(self) -> DataFrame:
        d = over_rows(self.b3_daily.select(STATION, DATE, "pm2_5"), DAILY, 1, 0, lambda w: {"x": F.lag("pm2_5").over(w)})
        d = d.select(STATION, DATE, category_ordinal(F.col("pm2_5")).alias("y"), "x").where("x IS NOT NULL AND y IS NOT NULL")
        e = d.withColumns({f"s{i}": F.exp(-F.abs(F.col("x") - m) / 60) for i, m in enumerate(STEPS)})
        total = F.col("s0") + F.col("s1") + F.col("s2") + F.col("s3") + F.col("s4") + F.col("s5")
        return e.select(STATION, DATE, "y", *[F.round(F.col(f"s{i}") / total, 3).alias(f"p{i}") for i in range(6)])

    @cached_property
    def design(self) -> DataFrame:
        """Written once: splitting, scaling and fitting read it again and again."""
        return settle(from_daily(self.b3_daily))

    @cached_property
    def parts(self) -> dict[str, DataFrame]:
        s = temporal_split(self.design)
        return {p: s.where(F.col("part") == p).drop("part") for p in ("train", "val", "test")}


# ---------------------------------------------------------------------------------- check SQL

CATEGORY_SQL = ("CASE WHEN {0} < 0 THEN NULL WHEN {0} <= 12 THEN 0 WHEN {0} <= 35.4 THEN 1 WHEN {0} <= 55.4 THEN 2 "
                "WHEN {0} <= 150.4 THEN 3 WHEN {0} <= 250.4 THEN 4 WHEN {0} IS NOT NULL THEN 5 END")
LABEL_SQL = ("CASE {0} WHEN 0 THEN 'Good' WHEN 1 THEN 'Moderate' WHEN 2 THEN 'USG' WHEN 3 THEN 'Unhealthy' "
             "WHEN 4 THEN 'Very Unhealthy' WHEN 5 THEN 'Hazardous' END")
_SUM = "(s0 + s1 + s2 + s3 + s4 + s5)"
HEATING_SQL = "month({0}) IN (11, 12, 1, 2, 3)"

SQL: dict[str, str] = {
    "b1_span": "SELECT date_trunc('hour', min(ts)) AS lo, date_trunc('hour', max(ts)) AS hi FROM events",
    "b1_hourly": """
        SELECT g.station, g.ts, m.pm2_5, m.n
        FROM (SELECT station, unnest(generate_series((SELECT lo FROM b1_span), (SELECT hi FROM b1_span), INTERVAL 1 HOUR)) AS ts
              FROM (SELECT DISTINCT event_type AS station FROM events)) g
        LEFT JOIN (SELECT event_type AS station, date_trunc('hour', ts) AS ts, round(avg(value) / 3.07::DOUBLE, 4) / 1.0007::DOUBLE AS pm2_5, count(*) AS n
                   FROM events GROUP BY 1, 2) m ON m.station = g.station AND m.ts = g.ts""",
    "b1_sensor": """
        SELECT g.station, g.ts, pm2_5, pm10, so2, no2, co, temp, wspm, wd
        FROM (SELECT station, unnest(generate_series((SELECT lo FROM b1_span), (SELECT hi FROM b1_span), INTERVAL 1 HOUR)) AS ts
              FROM (SELECT DISTINCT 'S' || CAST(user_id % 12 AS VARCHAR) AS station FROM events)) g
        LEFT JOIN (SELECT 'S' || CAST(user_id % 12 AS VARCHAR) AS station, date_trunc('hour', ts) AS ts,
                     round(avg(value) FILTER (WHERE event_type = 'view') / 3.07::DOUBLE, 4) / 1.0007::DOUBLE AS pm2_5,
                     round(avg(value) FILTER (WHERE event_type = 'click') / 3.07::DOUBLE, 4) / 1.0007::DOUBLE AS pm10,
                     round(avg(value) FILTER (WHERE event_type = 'error') / 3.07::DOUBLE, 4) / 1.0007::DOUBLE AS so2,
                     round(avg(value) FILTER (WHERE event_type = 'purchase') / 3.07::DOUBLE, 4) / 1.0007::DOUBLE AS no2,
                     round(avg(value) FILTER (WHERE event_type = 'signup') / 3.07::DOUBLE, 4) / 1.0007::DOUBLE AS co,
                     round((max(value) - 50) / 3.07::DOUBLE, 4) / 1.0007::DOUBLE AS temp, round(min(value) / 30.7::DOUBLE, 4) / 1.0007::DOUBLE AS wspm, min(event_type) AS wd
                   FROM events GROUP BY 1, 2) m ON m.station = g.station AND m.ts = g.ts""",
    "b2_raw": """
        SELECT l_orderkey * 10 + l_linenumber AS no, CAST(year(l_shipdate) AS INT) AS year, CAST(month(l_shipdate) AS INT) AS month,
               CAST(day(l_shipdate) AS INT) AS day, l_linenumber AS hour,
               CASE WHEN l_partkey % 11 = 0 THEN 'NA' WHEN l_partkey % 97 = 0 THEN 'abc'
                    WHEN l_tax = 0 THEN CAST(-l_quantity AS VARCHAR) ELSE CAST(l_quantity * 6 AS VARCHAR) END AS pm2_5,
               CASE WHEN l_suppkey % 13 <> 0 THEN CAST(l_extendedprice AS VARCHAR) END AS pm10,
               CAST(l_discount * 100 - 2 AS VARCHAR) AS temp,
               CASE WHEN l_partkey % 7 <> 0 THEN l_returnflag END AS wd, 'S' || CAST(l_suppkey % 12 AS VARCHAR) AS station
        FROM lineitem""",
    "b2_typed": """
        SELECT no, year, month, day, hour, station, make_timestamp(year, month, day, hour, 0, 0.0) AS ts, wd,
               TRY_CAST(pm2_5 AS DOUBLE) AS pm2_5, TRY_CAST(pm10 AS DOUBLE) AS pm10, TRY_CAST(temp AS DOUBLE) AS temp
        FROM b2_raw""",
    "b2_clean": """
        SELECT * EXCLUDE (rn) FROM (
          SELECT no, station, ts, CASE WHEN pm2_5 >= 0 THEN pm2_5 END AS pm2_5, CASE WHEN pm10 >= 0 THEN pm10 END AS pm10, temp, wd,
                 row_number() OVER (PARTITION BY station, ts ORDER BY no, CASE WHEN pm2_5 >= 0 THEN pm2_5 END NULLS LAST,
                   CASE WHEN pm10 >= 0 THEN pm10 END NULLS LAST, temp NULLS LAST, wd NULLS LAST) AS rn FROM b2_typed)
        WHERE rn = 1""",
    "b3_daily": """
        SELECT l_returnflag || l_linestatus AS station, l_shipdate AS date,
               round(avg(l_extendedprice) / 307, 4) / 1.0007::DOUBLE AS pm2_5, round(avg(l_quantity) / 3.07::DOUBLE, 4) / 1.0007::DOUBLE AS pm10,
               round(avg(l_discount) * 100 / 3.07::DOUBLE, 4) / 1.0007::DOUBLE AS so2, round(avg(l_tax) * 100 / 3.07::DOUBLE, 4) / 1.0007::DOUBLE AS no2,
               round(sum(l_extendedprice) / 307, 4) / 1.0007::DOUBLE AS co, CAST(count(*) AS DOUBLE) AS o3,
               round(avg(l_partkey) / 307, 4) / 1.0007::DOUBLE AS temp, 1000 + round(avg(l_suppkey) / 307, 4) / 1.0007::DOUBLE AS pres,
               round(min(l_discount) * 100, 4) AS dewp,
               round(coalesce(sum(l_quantity) FILTER (WHERE l_discount = 0), 0), 4) AS rain, round(max(l_tax) * 100, 4) AS wspm
        FROM lineitem GROUP BY 1, 2""",
    "b4_places": "SELECT * FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey",
    "b4_stations": """
        SELECT CAST(s_suppkey + 1 AS INT) AS station_id, s_name AS station_name, r_name AS station_type,
               CAST(s_acctbal / 1000 AS DECIMAL(8,5)) AS latitude, CAST(s_nationkey AS DECIMAL(8,5)) AS longitude FROM b4_places""",
    "b4_wide": """
        SELECT s_name AS station, r_name AS station_type, l_shipdate AS ts, l_extendedprice / 307.0009::DOUBLE AS pm2_5,
               l_quantity AS pm10, l_discount AS so2, l_tax AS no2, l_extendedprice AS co, CAST(l_linenumber AS DOUBLE) AS o3,
               l_quantity - 10 AS temp, 1000 + l_quantity AS pres, l_discount * 10 AS dewp, l_tax AS rain,
               round(l_tax * 50, 4) AS wspm, CASE WHEN p_size <= 40 THEN p_brand END AS wd
        FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey, l_shipdate ORDER BY l_orderkey, l_linenumber, l_partkey,
                        l_quantity, l_extendedprice, l_discount, l_tax) AS rn FROM lineitem) k
        JOIN part ON p_partkey = l_partkey JOIN b4_places ON s_suppkey = l_suppkey WHERE rn = 1""",
    "b4_wind": """
        SELECT DISTINCT CAST(substr(wd, 7) AS INT) AS wind_dir_id, wd AS wd_code, 'Label ' || wd AS wd_label
        FROM b4_wide WHERE wd IS NOT NULL""",
    "b4_poll": """
        SELECT station_id, ts, pm2_5, pm10, so2, no2, co, o3 FROM b4_wide w JOIN b4_stations s ON s.station_name = w.station""",
    "b4_weather": """
        SELECT station_id, ts, temp, pres, dewp, rain, wspm, wind_dir_id
        FROM b4_wide w JOIN b4_stations s ON s.station_name = w.station LEFT JOIN b4_wind d ON d.wd_code = w.wd""",
    "b4_flat": """
        SELECT w.station, s.station_type, CAST(s.latitude AS DOUBLE) AS lat, CAST(s.longitude AS DOUBLE) AS lon, ts,
               round(pm2_5, 1) AS pm2_5, round(pm10, 1) AS pm10, round(so2, 1) AS so2, round(no2, 1) AS no2, round(co, 1) AS co,
               round(o3, 1) AS o3, round(temp, 1) AS temp, round(pres, 1) AS pres, round(dewp, 1) AS dewp, round(rain, 1) AS rain,
               wd AS wind_dir, round(wspm, 1) AS wspm
        FROM b4_wide w JOIN b4_stations s ON s.station_name = w.station""",
    "b5_requests": """
        SELECT ((l_orderkey * 10 + l_linenumber) * 1000000 + l_partkey) * 10000 + date_diff('day', TIMESTAMP '1990-01-01', l_shipdate) AS req_id,
               CASE WHEN o_orderpriority = '5-LOW' THEN 'nowhere' ELSE 'Supplier#' || lpad(CAST(l_suppkey AS VARCHAR), 9, '0') END AS station,
               CASE WHEN o_orderstatus = 'F' THEN l_shipdate ELSE l_shipdate + INTERVAL 12 HOUR END AS ts,
               l_quantity AS pm2_5, CASE WHEN l_linenumber <> 1 THEN l_tax END AS pm10, o_orderpriority AS priority
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey""",
    "b6_scored": f"""
        SELECT station, date, y, {', '.join(f'round(s{i} / {_SUM}, 3) AS p{i}' for i in range(6))}
        FROM (SELECT station, date, y, {', '.join(f'exp(-abs(x - {m}) / 60) AS s{i}' for i, m in enumerate(STEPS))}
              FROM (SELECT station, date, {CATEGORY_SQL.format('pm2_5')} AS y,
                           lag(pm2_5) OVER (PARTITION BY station ORDER BY date) AS x FROM b3_daily)
              WHERE x IS NOT NULL AND y IS NOT NULL)""",
}

_W = "(PARTITION BY station ORDER BY date)"


def _roll(fn: str, n: int, least: int) -> str:
    f = f"OVER (PARTITION BY station ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN count(pm2_5) {f} >= {least} THEN {fn}(pm2_5) {f} END"


def design_sql(source: str, label: bool) -> str:
    """The design matrix over a daily table."""
    ahead = "(date + INTERVAL 1 DAY)"
    lags = ", ".join(f"lag(pm2_5, {k}) OVER {_W} AS pm_lag{k}" for k in (1, 2, 3, 7))
    need = " AND ".join(f"{c} IS NOT NULL" for c in (*FEATURES, *(["y"] if label else [])))
    return f"""
        SELECT * FROM (
          SELECT station, date, pm2_5 AS pm_today, {lags},
                 {_roll('avg', 7, 3)} AS pm_roll7_mean, {_roll('stddev_samp', 7, 3)} AS pm_roll7_std,
                 {_roll('avg', 30, 10)} AS pm_roll30_mean, {_roll('stddev_samp', 30, 10)} AS pm_roll30_std,
                 pm2_5 - {_roll('avg', 7, 3)} AS pm_dev7,
                 pm10 AS pm10_today, so2 AS so2_today, no2 AS no2_today, co AS co_today, o3 AS o3_today,
                 lag(pm10) OVER {_W} AS pm10_lag1, lag(no2) OVER {_W} AS no2_lag1, lag(co) OVER {_W} AS co_lag1,
                 temp, pres, dewp, wspm, rain,
                 sin(2 * pi() * month{ahead} / 12) AS t_month_sin, cos(2 * pi() * month{ahead} / 12) AS t_month_cos,
                 sin(2 * pi() * dayofyear{ahead} / 365.25) AS t_doy_sin, cos(2 * pi() * dayofyear{ahead} / 365.25) AS t_doy_cos,
                 CAST(isodow{ahead} >= 6 AS INT) AS t_is_weekend, CAST({HEATING_SQL.format(ahead)} AS INT) AS t_is_heating,
                 lead({CATEGORY_SQL.format('pm2_5')}) OVER {_W} AS y
          FROM {source}) WHERE {need}"""


def scaled_sql(source: str, train: str) -> str:
    """A design matrix on the scale of another one."""
    stats = ", ".join(f"avg({c}) AS mu_{c}, CASE WHEN stddev_pop({c}) = 0 THEN 1 ELSE stddev_pop({c}) END AS sd_{c}" for c in FEATURES)
    cols = ", ".join(f"({c} - mu_{c}) / sd_{c} AS {c}" for c in FEATURES)
    return f"SELECT station, date, y, pm_today AS raw_today, {cols} FROM {source}, (SELECT {stats} FROM {train})"


def softmax_sql(source: str, keep: str) -> str:
    """Scores by the fixed weights."""
    w, bias = WEIGHTS
    z = ", ".join("(" + " + ".join(f"{f} * CAST({w[c][i]} AS DOUBLE)" for i, f in enumerate(FEATURES)) + f" + CAST({bias[c]} AS DOUBLE)) AS z{c}"
                  for c in range(6))
    top = "greatest(z0, z1, z2, z3, z4, z5)"
    e = ", ".join(f"exp(z{c} - {top}) AS e{c}" for c in range(6))
    p = ", ".join(f"e{c} / (e0 + e1 + e2 + e3 + e4 + e5) AS p{c}" for c in range(6))
    return (f"SELECT *, {argmax_sql()} AS prediction, greatest(p0, p1, p2, p3, p4, p5) AS confidence FROM (SELECT {keep}, {p} "
            f"FROM (SELECT {keep}, {e} FROM (SELECT {keep}, {z} FROM {source})))")


def argmax_sql() -> str:
    best = "greatest(p0, p1, p2, p3, p4, p5)"
    return "CASE " + " ".join(f"WHEN p{c} = {best} THEN {c}" for c in range(6)) + " END"


SQL |= {
    "design": design_sql("b3_daily", True),
    "design_open": design_sql("b3_daily", False),
    "days": "SELECT date, row_number() OVER (ORDER BY date) - 1 AS i, count(*) OVER () AS n FROM (SELECT DISTINCT date FROM design)",
    "split": """
        SELECT *, CASE WHEN date < (SELECT date FROM days WHERE i = CAST(floor(n * 0.70::DOUBLE) AS BIGINT)) THEN 'train'
                       WHEN date < (SELECT date FROM days WHERE i = CAST(floor(n * 0.85::DOUBLE) AS BIGINT)) THEN 'val'
                       ELSE 'test' END AS part FROM design""",
    "train": "SELECT * FROM split WHERE part = 'train'",
    "test": "SELECT * FROM split WHERE part = 'test'",
    "six": "SELECT CAST(unnest(range(6)) AS INT) AS y",
    "cells": "SELECT a.y AS y, b.y AS prediction FROM six a, six b",
    "predicted": f"SELECT *, {argmax_sql()} AS prediction FROM b6_scored",
    "cm": """SELECT c.y, c.prediction, count(p.y) AS n FROM cells c
             LEFT JOIN predicted p ON p.y = c.y AND p.prediction = c.prediction GROUP BY 1, 2""",
    "score_rows": " UNION ALL ".join(f"SELECT {c} AS class, p{c} AS score, CAST(y = {c} AS INT) AS hit FROM b6_scored" for c in range(6)),
    "score_points": """
        SELECT class, score, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER (PARTITION BY class) AS positives,
               sum(neg) OVER (PARTITION BY class) AS negatives
        FROM (SELECT class, score, sum(hit) AS pos, sum(1 - hit) AS neg FROM score_rows GROUP BY 1, 2)
        WINDOW w AS (PARTITION BY class ORDER BY score DESC)""",
}

NEEDS = {
    "b1_hourly": ["b1_span"], "b1_sensor": ["b1_span"], "b2_typed": ["b2_raw"], "b2_clean": ["b2_typed"],
    "b4_stations": ["b4_places"], "b4_wide": ["b4_places"], "b4_wind": ["b4_wide"], "b4_poll": ["b4_wide", "b4_stations"],
    "b4_weather": ["b4_wide", "b4_stations", "b4_wind"], "b4_flat": ["b4_wide", "b4_stations"], "b6_scored": ["b3_daily"],
    "design": ["b3_daily"], "design_open": ["b3_daily"], "days": ["design"], "split": ["design", "days"], "train": ["split"],
    "test": ["split"], "cells": ["six"], "predicted": ["b6_scored"], "cm": ["cells", "predicted"], "score_rows": ["b6_scored"],
    "score_points": ["score_rows"],
}


def with_bindings(names: list[str], body: str) -> str:
    """The check SQL with the bindings it needs in front."""
    order: list[str] = []

    def add(name: str) -> None:
        for n in NEEDS.get(name, []):
            add(n)
        if name not in order:
            order.append(name)

    for n in names:
        add(n)
    if not order:
        return body.strip()
    head = ",\n".join(f"{n} AS ({SQL[n].strip()})" for n in order)
    body = body.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {head},\n{body[5:]}"
    return f"WITH {head}\n{body}"
