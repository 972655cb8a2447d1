"""Keyed batch mutations: a table and a table of requests give the next table version and one status per
request (ok, conflict, not_found). Requests of a batch take effect in the order of ``req_id``.

Requests on one key are reduced by aggregation (which combines before the shuffle) and joined back, never
gathered in one window, so a key that holds a third of all requests is no bottleneck.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from hazegrid.constants import POLLUTANTS, STATION, TS
from hazegrid.operators.documents import SUBDOCUMENTS, WEATHER_PATHS
from hazegrid.session import settle

KEY = [STATION, TS]
DOC_KEY = [STATION, "timestamp"]


def _status(hit: Column, miss: str) -> Column:
    return F.when(hit, "ok").otherwise(miss).alias("status")


def _keys(df: DataFrame, key: list[str], mark: str) -> DataFrame:
    return df.select(*key).withColumn(mark, F.lit(True))


def _first_per_key(req: DataFrame, key: list[str]) -> DataFrame:
    return req.groupBy(*key).agg(F.min("req_id").alias("_first"))


def create_status(readings: DataFrame, stations: DataFrame, req: DataFrame) -> DataFrame:
    """Unknown station: not_found. Key taken, by the table or by an earlier request: conflict."""
    known = stations.select(F.col("station_name").alias(STATION)).withColumn("_known", F.lit(True))
    return (req.select("req_id", *KEY).join(known, STATION, "left")
            .join(_keys(readings, KEY, "_taken"), KEY, "left").join(_first_per_key(req, KEY), KEY, "left")
            .select("req_id", *KEY,
                    F.when(F.col("_known").isNull(), "not_found")
                    .when(F.col("_taken").isNotNull() | (F.col("_first") < F.col("req_id")), "conflict")
                    .otherwise("ok").alias("status")))


def create_rows(readings: DataFrame, stations: DataFrame, req: DataFrame) -> DataFrame:
    """The table with the accepted readings; fields a request leaves out are NULL. Only the pollutant
    table grows: an hour without weather stays out of the queries that join weather."""
    values = [F.col(c).cast("double").alias(c) if c in req.columns else F.lit(None).cast("double").alias(c)
              for c in POLLUTANTS]
    accepted = (req.join(_first_per_key(req, KEY), KEY).where(F.col("req_id") == F.col("_first"))
                .join(stations.select(F.col("station_name").alias(STATION)), STATION, "left_semi")
                .join(readings.select(*KEY), KEY, "left_anti").select(*KEY, *values))
    return readings.select(*KEY, *POLLUTANTS).unionByName(accepted)


def update_rows(readings: DataFrame, req: DataFrame) -> DataFrame:
    """Only the six pollutants can change, and only to known values; the last request on a field wins."""
    fields = [c for c in POLLUTANTS if c in req.columns]
    last = req.groupBy(*KEY).agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("req_id"))).alias(f"_new_{c}")
                                   for c in fields])
    return (readings.select(*KEY, *POLLUTANTS).join(last, KEY, "left")
            .select(*KEY, *[F.coalesce(f"_new_{c}", c).alias(c) if c in fields else F.col(c) for c in POLLUTANTS]))


def update_status(readings: DataFrame, req: DataFrame) -> DataFrame:
    return (req.select("req_id", *KEY).join(_keys(readings, KEY, "_hit"), KEY, "left")
            .select("req_id", *KEY, _status(F.col("_hit"), "not_found")))


def delete_rows(readings: DataFrame, req: DataFrame) -> DataFrame:
    return readings.join(req.select(*KEY).distinct(), KEY, "left_anti")


def delete_status(readings: DataFrame, req: DataFrame, key: list[str] | None = None) -> DataFrame:
    """The first request on an existing key deletes it, later ones find nothing."""
    key = key or KEY
    return (req.select("req_id", *key).join(_keys(readings, key, "_hit"), key, "left")
            .join(_first_per_key(req, key), key, "left")
            .select("req_id", *key, _status(F.col("_hit") & (F.col("_first") == F.col("req_id")), "not_found")))


def doc_create(docs: DataFrame, req: DataFrame) -> DataFrame:
    """The collection with the new documents; a key that exists, or came earlier in the batch, is refused.
    Stations need not be known. The documents are read for their keys and for the result: they are written to the shared
    folder once, so this runs a job."""
    docs = settle(docs)
    # the rank is a group limit before the shuffle too; the shuffle by key serves the look-up among the documents as well
    first = Window.partitionBy(*DOC_KEY).orderBy("req_id")
    fresh = (req.dropna(subset=["req_id", *DOC_KEY]).withColumn("_rank", F.rank().over(first)).where("_rank = 1")
             .join(docs.select(*DOC_KEY), DOC_KEY, "left_anti"))
    cols = [F.col(c) if c in req.columns else F.lit(None).cast(docs.schema[c].dataType).alias(c) for c in docs.columns]
    return docs.unionByName(fresh.select(*cols))


def doc_create_status(docs: DataFrame, req: DataFrame) -> DataFrame:
    return (req.select("req_id", *DOC_KEY).join(_keys(docs, DOC_KEY, "_taken"), DOC_KEY, "left")
            .join(_first_per_key(req, DOC_KEY), DOC_KEY, "left")
            .select("req_id", *DOC_KEY, _status(F.col("_taken").isNull() & (F.col("_first") == F.col("req_id")), "conflict")))


def doc_update(docs: DataFrame, req: DataFrame) -> DataFrame:
    """Requests are (req_id, station, timestamp, path, value): ``value`` is JSON text, a NULL or ``null`` is
    written as such. A dotted path sets one leaf; ``pollutants`` or ``weather`` alone replaces the whole
    sub-document. Every other path is ignored. Leaves outside the schema are ignored as well."""
    types = {f"pollutants.{c}": "double" for c in POLLUTANTS}
    types |= {f"weather.{c}": "string" if c == "wind_dir" else "double" for c in WEATHER_PATHS}
    shapes = {s: ", ".join(f"{p.split('.')[1]} {t}" for p, t in types.items() if p.startswith(s)) for s in SUBDOCUMENTS}

    def written(path: str) -> Column:
        """The last value a batch writes to a leaf, wrapped so that a written NULL differs from none."""
        sub, leaf = path.split(".")
        whole = F.from_json("value", shapes[sub])[leaf]
        single = F.from_json(F.concat(F.lit('{"v":'), F.col("value"), F.lit("}")), f"v {types[path]}")["v"]
        hits = F.col("path").isin(sub, path)
        value = F.when(F.col("path") == path, single).otherwise(whole)
        # within one request the leaf is more specific than its sub-document
        return F.max_by(F.struct(value.alias("v")), F.when(hits, F.struct("req_id", F.col("path") == path)))

    last = (req.where(F.split_part("path", F.lit("."), F.lit(1)).isin(*SUBDOCUMENTS)).groupBy(*DOC_KEY)
            .agg(*[written(p).alias(f"_w_{p.replace('.', '_')}") for p in types]))
    j = docs.join(last, DOC_KEY, "left")

    def rebuilt(sub: str) -> Column:
        new = {p: F.col(f"_w_{p.replace('.', '_')}") for p in types if p.startswith(sub)}
        leaves = [F.when(w.isNotNull(), w["v"]).otherwise(F.col(p)).alias(p.split(".")[1]) for p, w in new.items()]
        touched = F.coalesce(*new.values()).isNotNull()
        return F.when(F.col(sub).isNotNull() | touched, F.struct(*leaves)).alias(sub)

    return j.select(*[rebuilt(c) if c in SUBDOCUMENTS else F.col(c) for c in docs.columns])


def doc_update_status(docs: DataFrame, req: DataFrame) -> DataFrame:
    asked = req.select("req_id", *DOC_KEY).distinct()
    return (asked.join(_keys(docs, DOC_KEY, "_hit"), DOC_KEY, "left")
            .select("req_id", *DOC_KEY, _status(F.col("_hit"), "not_found")))


def doc_delete(docs: DataFrame, req: DataFrame) -> DataFrame:
    return docs.join(req.select(*DOC_KEY).distinct(), DOC_KEY, "left_anti")


def doc_delete_status(docs: DataFrame, req: DataFrame) -> DataFrame:
    return delete_status(docs, req, DOC_KEY)
