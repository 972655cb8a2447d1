"""Scoring, forecast and backtest for all stations at once."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from hazegrid.constants import DATE, FEATURES, N_CLASSES, STATION
from hazegrid.functions.category import argmax, category, category_label, probabilities
from hazegrid.learning.dataset import apply_scaler, build_daily_classification
from hazegrid.operators.documents import docs_to_frame
from hazegrid.operators.outliers import CAPPED, cap_outliers, fit_fences
from hazegrid.operators.star import recent_days_by_station
from hazegrid.session import settle

Weights = tuple[list[list[float]], list[float]]      # [class][feature], [class]


def score_softmax(df: DataFrame, weights: Weights, features: tuple[str, ...] = FEATURES) -> DataFrame:
    """Adds p0..p5, the predicted class and its confidence from stored weights; plain column arithmetic."""
    w, bias = weights

    def logit(c: int) -> Column:
        return F.expr(" + ".join([f"`{f}` * {float(x)!r}D" for f, x in zip(features, w[c])] + [f"{float(bias[c])!r}D"]))

    z = df.withColumns({f"_z{c}": logit(c) for c in range(N_CLASSES)})
    top = F.greatest(*[f"_z{c}" for c in range(N_CLASSES)])
    e = z.withColumn("_top", top).withColumns({f"_e{c}": F.exp(F.col(f"_z{c}") - F.col("_top")) for c in range(N_CLASSES)})
    total = reduce(lambda a, b: a + b, [F.col(f"_e{c}") for c in range(N_CLASSES)])
    p = e.withColumn("_sum", total).select(*df.columns, *[(F.col(f"_e{c}") / F.col("_sum")).alias(f"p{c}") for c in range(N_CLASSES)])
    return with_decision(p)


def with_decision(df: DataFrame) -> DataFrame:
    cols = [F.col(p) for p in probabilities()]
    return df.withColumn("prediction", argmax(cols)).withColumn("confidence", F.greatest(*cols))


def top_classes(scored: DataFrame, n: int = 3) -> DataFrame:
    """The n likeliest classes of each row, best first; ties go to the lower class. Sorts six cells within
    the row, so nothing is shuffled."""
    cells = F.array(*[F.struct((-F.col(p)).alias("neg"), F.lit(c).alias("class")) for c, p in enumerate(probabilities())])
    best = F.posexplode(F.slice(F.array_sort(cells), 1, n)).alias("_pos", "_c")
    return (scored.select(STATION, DATE, best)
            .select(STATION, DATE, (F.col("_pos") + 1).alias("rank"), F.col("_c.class").alias("class"),
                    category_label(F.col("_c.class")).alias("category"), (-F.col("_c.neg")).alias("probability")))


def recent_design(hourly: DataFrame, days: int = 200, fences: DataFrame | None = None) -> DataFrame:
    """The design matrix of each station's last ``days`` days, last day kept. Fences are fitted on the window
    unless a stored table is given."""
    # a bounded window per station, read by the fences, the cap and the row positions
    recent = settle(recent_days_by_station(hourly, days))
    capped = cap_outliers(recent, fences if fences is not None else fit_fences(recent, CAPPED), CAPPED)
    return build_daily_classification(capped, require_label=False)


def forecast_rows(docs: DataFrame, score: Callable[[DataFrame], DataFrame], days: int = 200, least: int = 5,
                  fences: DataFrame | None = None) -> DataFrame:
    """One row per station with at least ``least`` feature days: tomorrow's category, by any function that scores design
    rows. Only the last day of each station is scored."""
    d = recent_design(docs_to_frame(docs), days, fences)
    last = d.groupBy(STATION).agg(F.count(F.lit(1)).alias("feature_days"), F.max_by(F.struct(DATE, *FEATURES), DATE).alias("_l"))
    last = last.where(F.col("feature_days") >= least).select(STATION, "feature_days", "_l.*")
    today = last.withColumn("today_category", category(F.col("pm_today")))
    return score(today).select(
        STATION, "feature_days", (F.col(DATE) + F.expr("INTERVAL 1 DAY")).alias("forecast_date"), "today_category",
        category_label(F.col("prediction")).alias("forecast_category"), "confidence", *probabilities())


def forecast_next_day(docs: DataFrame, scaler: DataFrame, weights: Weights, days: int = 200, least: int = 5,
                      fences: DataFrame | None = None) -> DataFrame:
    """The forecast from given softmax weights."""
    return forecast_rows(docs, lambda d: score_softmax(apply_scaler(d, scaler), weights), days, least, fences)


def last_known(design: DataFrame, days: int = 90) -> DataFrame:
    """Each station's last ``days`` rows whose next category is known; at most that many per station and
    task are shuffled."""
    w = Window.partitionBy(STATION).orderBy(F.col(DATE).desc())
    return design.where("y IS NOT NULL").withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= days).drop("_rn")


def backtest_rows(hourly: DataFrame, score: Callable[[DataFrame], DataFrame], window: int = 200, days: int = 90,
                  fences: DataFrame | None = None) -> DataFrame:
    """Accuracy of the next-day category over each station's last ``days`` known rows."""
    scored = score(last_known(recent_design(hourly, window, fences), days))
    return scored.groupBy(STATION).agg(F.count(F.lit(1)).alias("days"),
                                       F.avg((F.col("y") == F.col("prediction")).cast("int")).alias("accuracy"))


def backtest(hourly: DataFrame, scaler: DataFrame, weights: Weights, window: int = 200, days: int = 90,
             fences: DataFrame | None = None) -> DataFrame:
    return backtest_rows(hourly, lambda d: score_softmax(apply_scaler(d, scaler), weights), window, days, fences)
