"""Nested station-hour documents and the queries on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from hazegrid.constants import HEATING_MONTHS, POLLUTANTS, STATION, TS, WEATHER, WIND

SUBDOCUMENTS = ("pollutants", "weather")
WEATHER_PATHS = ("temp", "pres", "dewp", "rain", "wind_dir", "wspm")
DOCUMENT_SCHEMA = (
    "station string, station_type string, location struct<lat double, lon double>, timestamp timestamp_ntz, "
    "time struct<year int, month int, day int, hour int, is_heating_season int>, "
    "pollutants struct<pm2_5 double, pm10 double, so2 double, no2 double, co double, o3 double>, "
    "weather struct<temp double, pres double, dewp double, rain double, wind_dir string, wspm double>")


def to_documents(wide: DataFrame, stations: DataFrame, default_type: str = "urban") -> DataFrame:
    """One document per row; measurements have one decimal, unknown stations the default type and no place."""
    def f(c: str) -> Column:
        return F.round(F.when(~F.isnan(c), F.col(c)), 1).alias(c)

    place = stations.select(F.col("station_name").alias(STATION), F.col("station_type").alias("_type"),
                            F.col("latitude").cast("double").alias("_lat"), F.col("longitude").cast("double").alias("_lon"))
    t = F.col(TS)
    return wide.join(place, STATION, "left").select(
        STATION, F.coalesce("_type", F.lit(default_type)).alias("station_type"),
        F.struct(F.col("_lat").alias("lat"), F.col("_lon").alias("lon")).alias("location"),
        t.alias("timestamp"),
        F.struct(F.year(t).alias("year"), F.month(t).alias("month"), F.day(t).alias("day"), F.hour(t).alias("hour"),
                 F.month(t).isin(*HEATING_MONTHS).cast("int").alias("is_heating_season")).alias("time"),
        F.struct(*[f(c) for c in POLLUTANTS]).alias("pollutants"),
        F.struct(f("temp"), f("pres"), f("dewp"), f("rain"), F.col(WIND).alias("wind_dir"), f("wspm")).alias("weather"))


def docs_to_frame(docs: DataFrame) -> DataFrame:
    """Documents to wide rows; a missing sub-document or field gives NULL."""
    return docs.select(STATION, F.col("timestamp").alias(TS), *[F.col(f"pollutants.{c}").alias(c) for c in POLLUTANTS],
                       *[F.col(f"weather.{c}").alias(c) for c in WEATHER], F.col("weather.wind_dir").alias(WIND))


def project_paths(docs: DataFrame, paths: list[str]) -> DataFrame:
    """Dotted paths as columns ``a_b``; only these leaves are read from a columnar file."""
    return docs.select(*[F.col(p).alias(p.replace(".", "_")) for p in paths])


def doc_station_avg(docs: DataFrame, path: str = "pollutants.pm2_5", digits: int = 1) -> DataFrame:
    """Mean of a path and number of documents per station, worst first."""
    g = docs.groupBy(STATION).agg(F.avg(path).alias("_m"), F.count(F.lit(1)).alias("hours"))
    return (g.orderBy(F.col("_m").desc_nulls_last(), STATION)
            .select(STATION, F.round("_m", digits).alias("avg_pm25"), "hours"))


def doc_hazardous(docs: DataFrame, threshold: float = 250.0) -> DataFrame:
    """Documents above a threshold per station type, most first."""
    return (docs.where(F.col("pollutants.pm2_5") > threshold).groupBy("station_type")
            .agg(F.count(F.lit(1)).alias("hazardous_hours")).orderBy(F.col("hazardous_hours").desc(), "station_type"))


def doc_latest(docs: DataFrame, station: str) -> DataFrame:
    return docs.where(F.col(STATION) == station).orderBy(F.col("timestamp").desc()).limit(1)


def doc_range(docs: DataFrame, station: str, lo: Column, hi: Column, limit: int | None = None) -> DataFrame:
    """Documents of one station between two times in time order; an unknown station gives none."""
    out = docs.where((F.col(STATION) == station) & F.col("timestamp").between(lo, hi)).orderBy("timestamp")
    return out.limit(limit) if limit else out


def doc_get(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """The document of each requested (station, timestamp), or status not_found."""
    found = docs.withColumn("_hit", F.lit(True))
    return (keys.select("req_id", STATION, "timestamp").join(found, [STATION, "timestamp"], "left")
            .select("req_id", STATION, "timestamp", "station_type", "pollutants", "weather",
                    F.when(F.col("_hit"), "ok").otherwise("not_found").alias("status")))
