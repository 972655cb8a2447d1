"""Star schema: normalise, load subsets, and the relational queries.

``star`` is a dict of DataFrames: stations, wind_directions, pollutant_readings, weather_readings.
Joins to the two dimensions carry no hint: Spark broadcasts a dimension when its measured size
allows it, and otherwise shuffles, splitting a hot station's partition (adaptive skew join).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import DecimalType, StringType, StructField, StructType

from hazegrid.constants import POLLUTANTS, STATION, STATION_META, TS, WEATHER, WIND, WIND_LABELS
from hazegrid.functions.clock import is_heating
from hazegrid.operators.ordered import ordered_ids
from hazegrid.session import settle

Star = dict[str, DataFrame]
GRAIN = ["station_id", "ts"]
CANDIDATES = 20_000     # rows of a top-k list that are sent to every task, at most


def station_meta(spark: SparkSession, meta: dict[str, tuple] = STATION_META) -> DataFrame:
    """Known stations: type and coordinates."""
    rows = [(k, t, lat, lon) for k, (t, lat, lon) in meta.items()]
    df = spark.createDataFrame(rows, "station_name string, station_type string, lat double, lon double")
    return df.select("station_name", "station_type", F.col("lat").cast(DecimalType(8, 5)).alias("latitude"),
                     F.col("lon").cast(DecimalType(8, 5)).alias("longitude"))


def wind_labels(spark: SparkSession, labels: dict[str, str] = WIND_LABELS) -> DataFrame:
    schema = StructType([StructField("wd_code", StringType()), StructField("wd_label", StringType())])
    return spark.createDataFrame(list(labels.items()), schema)


def normalise_stations(wide: DataFrame, meta: DataFrame, default_type: str = "urban") -> DataFrame:
    """One row per station, numbered 1..n in name order; unknown stations get the default type."""
    names = wide.select(F.col(STATION).alias("station_name")).where(F.col(STATION).isNotNull()).distinct()
    ids = ordered_ids(names, [F.col("station_name")], "station_id")
    return (ids.join(meta, "station_name", "left")
            .select(F.col("station_id").cast("int").alias("station_id"), "station_name",
                    F.coalesce("station_type", F.lit(default_type)).alias("station_type"), "latitude", "longitude"))


def normalise_wind(wide: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per wind code in code order; an unknown code is its own label."""
    codes = wide.select(F.col(WIND).alias("wd_code")).where(F.col(WIND).isNotNull()).distinct()
    ids = ordered_ids(codes, [F.col("wd_code")], "wind_dir_id")
    return (ids.join(labels, "wd_code", "left")
            .select(F.col("wind_dir_id").cast("int").alias("wind_dir_id"), "wd_code",
                    F.coalesce("wd_label", "wd_code").alias("wd_label")))


def normalise_pollutants(wide: DataFrame, stations: DataFrame) -> DataFrame:
    """Pollutant fact; ``stations`` from ``normalise_stations``."""
    return wide.join(stations.select("station_id", F.col("station_name").alias(STATION)), STATION).select(*GRAIN, *POLLUTANTS)


def normalise_weather(wide: DataFrame, stations: DataFrame, wind: DataFrame) -> DataFrame:
    """Weather fact; an hour without wind has no wind id."""
    keyed = wide.join(stations.select("station_id", F.col("station_name").alias(STATION)), STATION)
    return (keyed.join(wind.select("wind_dir_id", F.col("wd_code").alias(WIND)), WIND, "left")
            .select(*GRAIN, *WEATHER, "wind_dir_id"))


def normalise(wide: DataFrame, meta: DataFrame, labels: DataFrame) -> Star:
    """Wide rows to two dimensions and two facts; the parts have functions of their own."""
    st, wd = normalise_stations(wide, meta), normalise_wind(wide, labels)
    return {"stations": st, "wind_directions": wd, "pollutant_readings": normalise_pollutants(wide, st),
            "weather_readings": normalise_weather(wide, st, wd)}


def recent_months(df: DataFrame, n: int, ts: str = TS) -> DataFrame:
    """Rows of the last n months before the newest one; 0 keeps all. The newest time is a scalar
    subquery, evaluated once before the scan."""
    if not n:
        return df
    newest = df.agg(F.max(ts)).scalar()
    return df.where(F.col(ts) >= newest - F.make_ym_interval(F.lit(0), F.lit(n)))


def recent_days(df: DataFrame, days: int, stations: list[str] | None = None, ts: str = TS) -> DataFrame:
    """Rows of the last ``days`` days (to the same clock time) of the chosen stations."""
    if stations is not None:
        df = df.where(F.col(STATION).isin(*stations))
    newest = df.agg(F.max(ts)).scalar()
    return df.where(F.col(ts) >= newest - F.make_dt_interval(F.lit(days)))


def recent_days_by_station(df: DataFrame, days: int, ts: str = TS) -> DataFrame:
    """As ``recent_days``, but each station counts back from its own newest reading."""
    newest = df.groupBy(STATION).agg(F.max(ts).alias("_hi"))
    return (df.join(newest, STATION)
            .where(F.col(ts) >= F.col("_hi") - F.make_dt_interval(F.lit(days))).drop("_hi"))


def monthly_by_station(star: Star, station: str | None = None, n: int | None = None) -> DataFrame:
    """Monthly mean and hours per station. Facts are summed by station id before the names are joined."""
    poll, st = star["pollutant_readings"], star["stations"]
    if station is not None:
        st = st.where(F.col("station_name") == station)
        poll = poll.join(st.select("station_id"), "station_id", "left_semi")
    m = poll.groupBy("station_id", F.date_format(TS, "yyyy-MM").alias("month")).agg(
        F.round(F.avg("pm2_5"), 1).alias("avg_pm25"), F.count(F.lit(1)).alias("n_hours"))
    out = m.join(st, "station_id").select("station_name", "month", "avg_pm25", "n_hours")
    out = out.orderBy("station_name", "month")
    return out.limit(n) if n else out


def type_season_rollup(star: Star) -> DataFrame:
    """Mean by station type and heating season, from per-station sums."""
    poll, st = star["pollutant_readings"], star["stations"]
    heat = F.when(is_heating(F.col(TS)) == 1, "heating").otherwise("non-heating")
    part = poll.groupBy("station_id", heat.alias("season_kind")).agg(
        F.sum("pm2_5").alias("_s"), F.count("pm2_5").alias("_n"))
    return (part.join(st, "station_id").groupBy("station_type", "season_kind")
            .agg(F.round(F.sum("_s") / F.sum("_n"), 1).alias("avg_pm25")).orderBy("station_type", "season_kind"))


def load_counts(star: Star) -> DataFrame:
    poll = star["pollutant_readings"].agg(F.count(F.lit(1))).scalar()
    wx = star["weather_readings"].agg(F.count(F.lit(1))).scalar()
    return star["stations"].agg(poll.alias("pollutant_rows"), wx.alias("weather_rows"),
                                F.countDistinct("station_name").alias("stations"))


def latest_per_station(star: Star) -> DataFrame:
    """Newest reading of every station; ties are all kept. One scan: a task passes on only the newest rows of each
    station that it has seen."""
    newest = Window.partitionBy("station_id").orderBy(F.col(TS).desc())
    poll = star["pollutant_readings"].where(F.col(TS).isNotNull()).withColumn("_rank", F.rank().over(newest)).where("_rank = 1")
    return (poll.join(star["stations"], "station_id")
            .select("station_name", TS, "pm2_5", "pm10", "no2", "co").orderBy("station_name"))


def _context(star: Star, poll: DataFrame) -> DataFrame:
    """Pollutant rows with station, weather and, where known, wind."""
    return (poll.join(star["weather_readings"], GRAIN)
            .join(star["wind_directions"], "wind_dir_id", "left")
            .join(star["stations"], "station_id"))


def range_with_context(star: Star, station: str, lo: Column, hi: Column) -> DataFrame:
    """One station's readings between two times, both included, with weather and wind. The time bound
    reaches both file scans, and both facts are cut to the station before they meet."""
    st = star["stations"].where(F.col("station_name") == station)
    inside = F.col(TS).between(lo, hi)

    def own(fact: DataFrame) -> DataFrame:
        return fact.where(inside).join(st.select("station_id"), "station_id", "left_semi")

    cut = {**star, "stations": st, "weather_readings": own(star["weather_readings"])}
    return (_context(cut, own(star["pollutant_readings"]))
            .select(TS, "pm2_5", "pm10", "temp", "wspm", "wd_code").orderBy(TS))


def top_hours(star: Star, n: int = 10, first: int = 4) -> DataFrame:
    """The n worst hours with their context; equal values are ordered by station and time.

    Candidates come from the pollutant table alone: its ``first`` x n worst hours that have a station. Only they meet the
    weather. While fewer than n of them have weather, eight times as many are taken; beyond ``CANDIDATES`` rows the facts are
    joined whole. Up to there weather is read for a handful of keys, and no fact is shuffled. Runs a job per round.
    """
    order = [F.col("pm2_5").desc_nulls_last(), F.col("station_name"), F.col(TS)]
    cols = ["station_name", TS, "pm2_5", "wspm", "wd_code"]
    named = star["pollutant_readings"].join(star["stations"].select("station_id", "station_name"), "station_id").select(
        *GRAIN, "station_name", "pm2_5")
    size = first * n
    while size <= CANDIDATES:
        worst = settle(named.orderBy(*order).limit(size))
        found = settle(star["weather_readings"].join(F.broadcast(worst), GRAIN)
                       .join(star["wind_directions"], "wind_dir_id", "left").select(*cols).orderBy(*order).limit(n))
        if found.count() >= n or worst.count() < size:
            return found.orderBy(*order)
        size *= 8
    return _context(star, star["pollutant_readings"]).select(*cols).orderBy(*order).limit(n)


def denormalise(star: Star) -> DataFrame:
    """Back to one wide row per station and hour."""
    return _context(star, star["pollutant_readings"]).select(
        F.col("station_name").alias(STATION), "station_type", TS, *POLLUTANTS, *WEATHER, F.col("wd_code").alias(WIND))
