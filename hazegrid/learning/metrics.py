"""Classification metrics over all six classes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from hazegrid.constants import N_CLASSES
from hazegrid.functions.category import probabilities
from hazegrid.session import settle


def confusion(df: DataFrame, label: str = "y", prediction: str = "prediction") -> DataFrame:
    """Rows per (actual, predicted) class, all 36 cells."""
    cells = [(a, b) for a in range(N_CLASSES) for b in range(N_CLASSES)]
    one = df.agg(*[F.count_if((F.col(label) == a) & (F.col(prediction) == b)).alias(f"{a}_{b}") for a, b in cells])
    part = lambda i: F.split_part("_k", F.lit("_"), F.lit(i)).cast("int")
    return (one.unpivot([], [f"{a}_{b}" for a, b in cells], "_k", "n")
            .select(part(1).alias("y"), part(2).alias("prediction"), "n"))


def accuracy(df: DataFrame, label: str = "y", prediction: str = "prediction") -> DataFrame:
    return df.agg(F.avg((F.col(label) == F.col(prediction)).cast("int")).alias("accuracy"))


def confusion_normalised(cm: DataFrame) -> DataFrame:
    """Share of each predicted class within the actual one."""
    row = F.sum("n").over(Window.partitionBy("y"))      # six cells each
    return cm.select("y", "prediction", (F.col("n") / F.greatest(row, F.lit(1))).alias("share"))


def class_report(cm: DataFrame) -> DataFrame:
    """Precision, recall and F1 per class from the 36 cells; 0 where undefined."""
    hit = F.sum(F.when(F.col("y") == F.col("prediction"), F.col("n")).otherwise(0))
    actual = cm.groupBy("y").agg(hit.alias("tp"), F.sum("n").alias("actual"))
    predicted = cm.groupBy(F.col("prediction").alias("y")).agg(F.sum("n").alias("predicted"))
    zero = F.lit(0.0)

    def ratio(a: Column, b: Column) -> Column:
        return F.when(b > 0, a / b).otherwise(zero)

    j = actual.join(predicted, "y").select(
        "y", ratio(F.col("tp"), F.col("predicted")).alias("precision"), ratio(F.col("tp"), F.col("actual")).alias("recall"))
    p, r = F.col("precision"), F.col("recall")
    return j.withColumn("f1", ratio(2 * p * r, p + r))


def macro_f1(cm: DataFrame) -> DataFrame:
    return class_report(cm).agg(F.avg("f1").alias("macro_f1"))


def summary(df: DataFrame, label: str = "y", prediction: str = "prediction") -> DataFrame:
    """Accuracy and macro-F1 of a prediction in one pass over it, without a shuffle but the final merge."""
    y, p = F.col(label), F.col(prediction)
    classes = range(N_CLASSES)
    one = df.agg(F.avg((y == p).cast("int")).alias("accuracy"),
                 *[F.count_if((y == c) & (p == c)).alias(f"t{c}") for c in classes],
                 *[(F.count_if(y == c) + F.count_if(p == c)).alias(f"s{c}") for c in classes])
    # 2 P R / (P + R) with P = t / predicted and R = t / actual
    f1 = [F.when(F.col(f"t{c}") > 0, 2 * F.col(f"t{c}") / F.col(f"s{c}")).otherwise(0.0) for c in classes]
    return one.select("accuracy", (sum(f1[1:], f1[0]) / N_CLASSES).alias("macro_f1"))


def score_counts(df: DataFrame, label: str = "y") -> DataFrame:
    """Positives and negatives per class and distinct score; the combine runs before the shuffle."""
    probs = probabilities()
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("class"), F.col(p).alias("score"),
                                        (F.col(label) == c).cast("long").alias("hit")) for c, p in enumerate(probs)]))
    return (df.select(each.alias("_s")).select("_s.*").groupBy("class", "score")
            .agg(F.sum("hit").alias("pos"), F.sum(1 - F.col("hit")).alias("neg")))


def cumulative(counts: DataFrame, parts: int | None = None) -> DataFrame:
    """Positives and negatives at or above each score, per class, with the class totals.

    Prefix sums in parallel: rows are range-partitioned by class and falling score and written; totals per class and
    partition, of which there are few, are accumulated, then the scores within each partition. Partitions follow
    the data, so scores may crowd anywhere.
    """
    order = ["class", F.col("score").desc()]
    ranged = counts.repartitionByRange(parts, *order) if parts else counts.repartitionByRange(*order)
    c = settle(ranged.withColumn("_part", F.spark_partition_id()))
    totals = c.groupBy("class", "_part").agg(F.sum("pos").alias("_bp"), F.sum("neg").alias("_bn"))
    before = Window.partitionBy("class").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("class")
    offsets = totals.select(
        "class", "_part", F.coalesce(F.sum("_bp").over(before), F.lit(0)).alias("_op"),
        F.coalesce(F.sum("_bn").over(before), F.lit(0)).alias("_on"),
        F.sum("_bp").over(whole).alias("positives"), F.sum("_bn").over(whole).alias("negatives"))
    inside = Window.partitionBy("class", "_part").orderBy(F.col("score").desc()).rowsBetween(Window.unboundedPreceding, 0)
    rows = c.select("class", "_part", "score", F.sum("pos").over(inside).alias("_cp"), F.sum("neg").over(inside).alias("_cn"),
                    "pos", "neg")
    return (rows.join(offsets, ["class", "_part"])
            .select("class", "score", "pos", "neg", (F.col("_op") + F.col("_cp")).alias("tp"),
                    (F.col("_on") + F.col("_cn")).alias("fp"), "positives", "negatives"))


def roc_curve(df: DataFrame, label: str = "y") -> DataFrame:
    """One-vs-rest ROC points per class, one per distinct score, from (0, 0). A class without positives or
    without negatives gets the diagonal's two ends."""
    cum = cumulative(score_counts(df, label))
    fine = (F.col("positives") > 0) & (F.col("negatives") > 0)
    points = cum.where(fine).select("class", "score", (F.col("fp") / F.col("negatives")).alias("fpr"),
                                    (F.col("tp") / F.col("positives")).alias("tpr"))
    totals = cum.groupBy("class").agg(F.max("positives").alias("p"), F.max("negatives").alias("n"))
    none = F.lit(None).cast("double")
    start = totals.select("class", none.alias("score"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    flat = totals.where("p = 0 OR n = 0").select("class", none.alias("score"), F.lit(1.0).alias("fpr"), F.lit(1.0).alias("tpr"))
    return points.unionByName(start).unionByName(flat)


def class_auc(df: DataFrame, label: str = "y") -> DataFrame:
    """Area under each class's ROC points by trapezoids. Between two points the true positives before and
    after are known from the running sums, so the areas just add up."""
    cum = cumulative(score_counts(df, label)).where("positives > 0 AND negatives > 0")
    step = F.col("neg").cast("double") * (2 * F.col("tp") - F.col("pos"))
    return cum.groupBy("class").agg(
        (F.sum(step) / (2.0 * F.max("positives") * F.max("negatives"))).alias("auc"))


def macro_auc(df: DataFrame, label: str = "y") -> DataFrame:
    """Mean area over the classes that have both positives and negatives."""
    return class_auc(df, label).agg(F.avg("auc").alias("macro_auc"))


def pr_curve(df: DataFrame, label: str = "y") -> DataFrame:
    """Precision and recall per class at each distinct score."""
    cum = cumulative(score_counts(df, label))
    return cum.select("class", "score", (F.col("tp") / F.greatest(F.col("positives"), F.lit(1))).alias("recall"),
                      (F.col("tp") / F.greatest(F.col("tp") + F.col("fp"), F.lit(1))).alias("precision"))
