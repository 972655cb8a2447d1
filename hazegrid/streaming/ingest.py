"""Readings that arrive as a stream."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from hazegrid.constants import POLLUTANTS, TS
from hazegrid.operators.mutations import KEY, create_status

ACCEPTED = "station string, ts timestamp_ntz, " + ", ".join(f"{c} double" for c in POLLUTANTS) + ", period string, batch int"
#: Accepted readings lie in a folder per month (a finer pattern suits a feed whose batches span little time), those
#: without a time in one of their own.
PERIOD, NO_PERIOD = "yyyy-MM", "none"


def _period(pattern: str) -> Column:
    return F.coalesce(F.date_format(TS, pattern), F.lit(NO_PERIOD))


def read_accepted(spark: SparkSession, sink: str, periods: list[str] | None = None) -> DataFrame:
    """What the stream has accepted so far, with its period and the batch that did; no rows before the first one. With
    ``periods`` only their folders are listed and read."""
    folder = f"{sink}/accepted"
    try:
        return spark.read.schema(ACCEPTED).option("basePath", folder).parquet(
            folder if periods is None else f"{folder}/period={{{','.join(sorted(periods))}}}")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], ACCEPTED)


def ingest_stream(stream: DataFrame, readings: DataFrame, stations: DataFrame, sink: str,
                  checkpoint: str, period: str = PERIOD) -> StreamingQuery:
    """Applies create requests (req_id, station, ts, pollutants) as they arrive, takes what is there and stops.

    A key is taken by ``readings``, by an earlier batch or by an earlier request of the same batch. Every
    request ends in ``sink``/accepted or, with its status, in ``sink``/refused; none is dropped by a
    watermark, however late it comes: a late one meets the keys of its own time. What was accepted lies in a folder per
    period (a date pattern), and a batch lists and reads the folders of its own periods only, so its cost does not grow
    with the batches of other times. Within a period each batch owns one folder that is overwritten when the batch is run
    again, so a restart after a failure writes nothing twice. Of ``readings`` only the time range of the batch is read.
    """
    spark = stream.sparkSession

    def apply(batch_df: DataFrame, batch: int) -> None:
        req = batch_df.withColumn(TS, F.col(TS).cast("timestamp_ntz")).persist()
        try:
            span = req.groupBy(_period(period).alias("period")).agg(F.min(TS).alias("lo"), F.max(TS).alias("hi")).collect()  # periods of a batch
            if not span:
                return
            times = [t for r in span for t in (r.lo, r.hi) if t is not None]
            taken = readings.select(*KEY).where(F.lit(False))
            if times:
                taken = readings.where(F.col(TS).between(*[F.lit(t).cast("timestamp_ntz") for t in (min(times), max(times))])).select(*KEY)
            # a batch that is run again must not see its own earlier output
            earlier = read_accepted(spark, sink, [r.period for r in span]).where(F.col("batch") < batch)
            judged = req.join(create_status(taken.unionByName(earlier.select(*KEY)), stations, req).select("req_id", "status"), "req_id").persist()
            values = [F.col(c).cast("double").alias(c) if c in req.columns else F.lit(None).cast("double").alias(c)
                      for c in POLLUTANTS]
            (judged.where("status = 'ok'").select(*KEY, *values, _period(period).alias("period"), F.lit(batch).alias("batch"))
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("period", "batch").parquet(f"{sink}/accepted"))
            (judged.where("status <> 'ok'").select("req_id", *KEY, "status")
             .write.mode("overwrite").parquet(f"{sink}/refused/batch={batch}"))
            judged.unpersist()
        finally:
            req.unpersist()

    return (stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
