"""Next-day design matrix, temporal split, scaling, class weights and simple baselines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from hazegrid.constants import DAILY_LAGS, DAILY_ROLLS, DATE, FEATURES, N_CLASSES, STATION, TARGET
from hazegrid.functions import clock
from hazegrid.functions.category import category_ordinal
from hazegrid.operators.aggregates import class_counts, daily_means
from hazegrid.operators.features import rolling_columns
from hazegrid.operators.ordered import DAILY, Layout, over_rows


def _history(w: WindowSpec) -> dict[str, Column]:
    out = {f"pm_lag{k}": F.lag(TARGET, k).over(w) for k in DAILY_LAGS}
    for n, least in DAILY_ROLLS:
        out |= rolling_columns(w, TARGET, n, least, "pm")
    out |= {f"{c}_lag1": F.lag(c).over(w) for c in ("pm10", "no2", "co")}
    out["y"] = F.lead(category_ordinal(F.col(TARGET))).over(w)
    return out


def from_daily(daily: DataFrame, require_label: bool = True, at: Layout = DAILY) -> DataFrame:
    """One row per station-day: what is known by its end, the calendar of the day after, and the category
    ``y`` of the station's next row. Rows with an unknown input are left out, and without
    ``require_label=False`` those with an unknown label."""
    d = over_rows(daily, at, max(n for n, _ in DAILY_ROLLS) - 1, 1, _history)
    ahead = F.col(DATE) + F.expr("INTERVAL 1 DAY")
    month_sin, month_cos = clock.cycle(F.month(ahead), 12)
    doy_sin, doy_cos = clock.cycle(F.dayofyear(ahead), 365.25)
    d = d.withColumns({
        "pm_today": F.col(TARGET), "pm_dev7": F.col(TARGET) - F.col("pm_roll7_mean"),
        **{f"{c}_today": F.col(c) for c in ("pm10", "so2", "no2", "co", "o3")},
        "t_month_sin": month_sin, "t_month_cos": month_cos, "t_doy_sin": doy_sin, "t_doy_cos": doy_cos,
        "t_is_weekend": clock.is_weekend(ahead), "t_is_heating": clock.is_heating(ahead),
    })
    need = [*FEATURES, "y"] if require_label else list(FEATURES)
    return d.select(STATION, DATE, *FEATURES, "y").dropna(subset=need)


def build_daily_classification(hourly: DataFrame, require_label: bool = True, at: Layout = DAILY) -> DataFrame:
    """Hourly readings (clean, filled, capped) to the design matrix."""
    return from_daily(daily_means(hourly), require_label, at)


def split_bounds(df: DataFrame, train: float = 0.70, val: float = 0.15) -> DataFrame:
    """First date of the validation and of the test part, by position among the distinct dates. The list
    holds calendar days, so its length does not grow with the number of stations."""
    u = df.agg(F.sort_array(F.collect_set(DATE)).alias("u"))
    n = F.size("u").cast("double")
    return u.select(F.get("u", F.floor(n * train).cast("int")).alias("val_from"),
                    F.get("u", F.floor(n * (train + val)).cast("int")).alias("test_from"))


def temporal_split(df: DataFrame, train: float = 0.70, val: float = 0.15) -> DataFrame:
    """Adds ``part``: train, val or test, strictly by date."""
    bounds = split_bounds(df, train, val).select(F.struct("val_from", "test_from")).scalar()
    return df.withColumn("part", F.when(F.col(DATE) < bounds["val_from"], "train")
                         .when(F.col(DATE) < bounds["test_from"], "val").otherwise("test"))


def fit_scaler(df: DataFrame, cols: tuple[str, ...] = FEATURES) -> DataFrame:
    """One row: mean and population deviation per column; a flat column gets deviation 1."""
    def spread(c: str) -> Column:
        s = F.stddev_pop(c)
        return F.when(s == 0, 1.0).otherwise(s)
    return df.agg(*[F.avg(c).alias(f"mu_{c}") for c in cols], *[spread(c).alias(f"sd_{c}") for c in cols])


def apply_scaler(df: DataFrame, scaler: DataFrame, cols: tuple[str, ...] = FEATURES) -> DataFrame:
    one = scaler.select(F.struct(*scaler.columns)).scalar()
    j = df.withColumn("_sc", one)
    return j.withColumns({c: F.expr(f"(`{c}` - _sc.mu_{c}) / _sc.sd_{c}") for c in cols}).drop("_sc")


def standardize(train: DataFrame, *others: DataFrame, cols: tuple[str, ...] = FEATURES) -> list[DataFrame]:
    """The train part and the others on the scale of the train part."""
    scaler = fit_scaler(train, cols)
    return [apply_scaler(d, scaler, cols) for d in (train, *others)]


def class_weights(df: DataFrame, beta: float = 1.0, label: str = "y") -> DataFrame:
    """(N / (K n_c)) ** beta per class, scaled so that the mean weight of the rows is 1; an empty class
    counts as one row. Works on the six class counts."""
    c = class_counts(df, label).select("y", F.col("n").alias("_rows"), F.greatest("n", F.lit(1)).cast("double").alias("_n"))
    all_classes = Window.partitionBy(F.lit(0))      # six rows
    raw = c.withColumn("_w", F.pow(F.sum("_n").over(all_classes) / (N_CLASSES * F.col("_n")), F.lit(beta)))
    scale = F.sum("_rows").over(all_classes) / F.sum(F.col("_w") * F.col("_rows")).over(all_classes)
    return raw.select("y", (F.col("_w") * scale).alias("weight"))


def with_weights(df: DataFrame, beta: float, label: str = "y") -> DataFrame:
    """Adds the weight of each row's class; the weight table has six rows."""
    w = class_weights(df, beta, label).withColumnRenamed("y", label)
    return df.join(F.broadcast(w), label)


def predict_persistence(df: DataFrame) -> DataFrame:
    """Tomorrow is like today."""
    return df.withColumn("prediction", category_ordinal(F.col("pm_today")))


def predict_majority(train: DataFrame, df: DataFrame, label: str = "y") -> DataFrame:
    """Always the most frequent class of the train part; ties go to the lowest."""
    best = class_counts(train, label).agg(F.min_by("y", F.struct(-F.col("n"), F.col("y")))).scalar()
    return df.withColumn("prediction", best)


