"""Data-quality reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from hazegrid.constants import CHANNELS, STATION, STATION_TYPES, TARGET, TS, WIND
from hazegrid.functions.clock import seconds_between
from hazegrid.operators.ordered import HOURLY, Layout, over_rows
from hazegrid.operators.quantiles import exact_quantiles, unpivot


def overview(df: DataFrame, numeric: int = len(CHANNELS)) -> DataFrame:
    """Row and station counts and the covered time. The names come from ``station_names``: their list
    grows with the network and does not belong into one row."""
    span = F.floor(seconds_between(F.col("start"), F.col("end")) / 86400).cast("int")
    return (df.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct(STATION).alias("stations"),
                   F.min(TS).alias("start"), F.max(TS).alias("end"))
            .select("*", span.alias("span_days"), F.lit(numeric).alias("n_numeric_cols")))


def station_names(df: DataFrame) -> DataFrame:
    return df.select(STATION).distinct().orderBy(STATION)


def infer_frequency(df: DataFrame, at: Layout = HOURLY) -> DataFrame:
    """Most frequent step between consecutive readings of each station, in seconds; ties give the
    smallest step. Steps are counted per station and step first, so no task holds a station."""
    steps = over_rows(df.select(at.key, at.ts), at, 1, 0, lambda w: {"_prev": F.lag(at.ts).over(w)})
    counts = (steps.where("_prev IS NOT NULL")
              .groupBy(at.key, seconds_between(F.col("_prev"), F.col(at.ts)).alias("step"))
              .agg(F.count(F.lit(1)).alias("n")))
    return counts.groupBy(at.key).agg(
        F.min_by("step", F.struct(-F.col("n"), F.col("step"))).alias("frequency_seconds"))


def missing_report(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Missing cells per column with their share in percent, worst first; one pass."""
    cols = cols or [c for c in (*CHANNELS, WIND) if c in df.columns]
    one = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return (one.unpivot(["_n"], cols, "column", "missing")
            .select("column", "missing", F.round(100 * F.col("missing") / F.col("_n"), 2).alias("pct"))
            .orderBy(F.col("missing").desc(), "column"))


def missing_by_station(df: DataFrame, col: str = TARGET) -> DataFrame:
    g = df.groupBy(STATION).agg(F.count_if(F.col(col).isNull()).alias("missing"), F.count(F.lit(1)).alias("n"))
    return (g.withColumn("pct", F.round(100 * F.col("missing") / F.col("n"), 2))
            .orderBy(F.col("pct").desc(), STATION))


def describe_numeric(df: DataFrame, cols: list[str] | None = None, digits: int = 2) -> DataFrame:
    """count, mean, std, min, quartiles, max and bias-corrected skew, one row per channel."""
    cols = cols or [c for c in CHANNELS if c in df.columns]
    long = unpivot(df.select(*cols), [], cols)
    n = F.col("count")
    # the built-in skewness is the population one
    bias = F.sqrt(n * (n - 1).cast("double")) / (n - 2)
    moments = long.groupBy("channel").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"), F.skewness("value").alias("_g"))
    quartiles = exact_quantiles(long, ["channel"], "value", (0.25, 0.5, 0.75))
    j = moments.join(quartiles.drop("n"), "channel", "left")
    skew = F.when((n > 2) & (F.col("std") > 0), F.col("_g") * bias).when(n > 2, F.lit(0.0))

    def r(c):
        return F.round(c, digits)

    return j.select("channel", "count", r(F.col("mean")).alias("mean"), r(F.col("std")).alias("std"),
                    r(F.col("min")).alias("min"), r(F.col("q0")).alias("p25"), r(F.col("q1")).alias("p50"),
                    r(F.col("q2")).alias("p75"), r(F.col("max")).alias("max"), r(skew).alias("skew"))


def histogram(df: DataFrame, cols: list[str], bins: int = 60) -> DataFrame:
    """Equal-width bins between the smallest and the largest value of each channel, empty bins included;
    the last bin holds its right edge."""
    limits = df.agg(*[F.struct(F.min(c).alias("lo"), F.max(c).alias("hi")).alias(c) for c in cols])
    # one row per channel
    spans = limits.unpivot([], cols, "channel", "s").select("channel", "s.lo", "s.hi")
    spine = (spans.where("lo IS NOT NULL").withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1)))))
    where = F.when(F.col("hi") > F.col("lo"),
                   F.least(F.floor((F.col("value") - F.col("lo")) * bins / (F.col("hi") - F.col("lo"))),
                           F.lit(bins - 1).cast("long"))).otherwise(F.lit(0).cast("long"))
    # ``spans`` has one row per channel name, so it can always be sent to every task
    counts = (unpivot(df.select(*cols), [], cols).where("value IS NOT NULL")
              .join(F.broadcast(spans), "channel")
              .groupBy("channel", where.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n")))
    width = (F.col("hi") - F.col("lo")) / bins
    return (spine.join(counts, ["channel", "bin"], "left")
            .select("channel", "bin", (F.col("lo") + F.col("bin") * width).alias("left_edge"),
                    (F.col("lo") + (F.col("bin") + 1) * width).alias("right_edge"),
                    F.coalesce("n", F.lit(0).cast("long")).alias("n")))


def check_constraints(star: dict[str, DataFrame], types: tuple[str, ...] = STATION_TYPES) -> DataFrame:
    """Counts what breaks the star schema's rules, one row per rule.

    Both facts are grouped together, once by grain and once by station, which answers six rules.
    """
    st, wd, poll, wx = (star[k] for k in ("stations", "wind_directions", "pollutant_readings", "weather_readings"))
    grain = ["station_id", "ts"]
    facts = (poll.select(*grain, F.lit(1).alias("p"), F.lit(0).alias("w"))
             .unionByName(wx.select(*grain, F.lit(0).alias("p"), F.lit(1).alias("w"))))
    hours = facts.groupBy(*grain).agg(F.sum("p").alias("p"), F.sum("w").alias("w"))
    keyless = F.col("station_id").isNull() | F.col("ts").isNull()      # matches nothing
    by_hour = hours.agg(
        F.count_if(F.col("p") > 1).alias("pollutant grain is unique"), F.count_if(F.col("w") > 1).alias("weather grain is unique"),
        F.coalesce(F.sum(F.when((F.col("w") == 0) | keyless, F.col("p"))), F.lit(0)).alias("pollutant row has weather row"),
        F.coalesce(F.sum(F.when((F.col("p") == 0) | keyless, F.col("w"))), F.lit(0)).alias("weather row has pollutant row"))
    used = facts.where("station_id IS NOT NULL").groupBy("station_id").agg(F.max("p").alias("p"), F.max("w").alias("w"))
    by_station = used.join(st, "station_id", "left_anti").agg(
        F.count_if(F.col("p") > 0).alias("pollutant station exists"), F.count_if(F.col("w") > 0).alias("weather station exists"))
    winds = wx.select("wind_dir_id").where("wind_dir_id IS NOT NULL").distinct().join(wd, "wind_dir_id", "left_anti")

    def twice(df: DataFrame, key: str) -> DataFrame:
        return df.groupBy(key).count().agg(F.count_if(F.col("count") > 1).alias(f"{key} is unique"))

    parts = [twice(st, "station_name"), twice(st, "station_id"), twice(wd, "wd_code"), by_hour, by_station,
             winds.agg(F.count(F.lit(1)).alias("weather wind exists")),
             st.agg(F.count_if(~F.col("station_type").isin(*types)).alias("station_type is allowed"))]
    rules = [p.unpivot([], p.columns, "rule", "violations") for p in parts]
    out = rules[0]
    for r in rules[1:]:
        out = out.unionByName(r)
    return out
