import numpy as np
import pytest
from pyspark.sql import functions as F

from hazegrid.operators.quantiles import exact_quantiles

PROBS = (0.0, 0.25, 0.5, 0.75, 1.0)


def check(spark, groups, ranges):
    rows = [(k, None if v is None else float(v)) for k, vs in groups.items() for v in vs]
    df = spark.createDataFrame(rows, "k string, v double").repartition(6)
    got = {r.k: r for r in exact_quantiles(df, ["k"], "v", PROBS, ranges).collect()}
    known = {k: [v for v in vs if v is not None] for k, vs in groups.items()}
    assert set(got) == {k for k, vs in known.items() if vs}
    for k, r in got.items():
        assert r.n == len(known[k])
        assert np.allclose([r[f"q{i}"] for i in range(5)], np.quantile(known[k], PROBS), rtol=1e-12, atol=0)


@pytest.mark.parametrize("ranges", [1, 7, 1 << 16])
def test_any_distribution(spark, ranges):
    """Ties, single values, outliers of 18 orders of magnitude, crowded values, nulls; few ranges leave more to the last pass."""
    r = np.random.RandomState(3)
    check(spark, {
        "one": [4.0], "two": [1.0, 2.0], "flat": [7.0] * 50, "ties": r.randint(0, 4, 900), "normal": r.randn(3001),
        "outliers": [*r.rand(1500), 1e18, -1e18], "crowded": 1 + r.rand(2000) * 1e-12, "nulls": [None, 3.0, None, 5.0], "none": [None, None],
        "heavy": r.standard_cauchy(2500) ** 3}, ranges)


def test_one_key_with_many_values(spark):
    """No task after the scan gets more rows than there are ranges, and the last pass sees a handful of values."""
    n = 400_000
    df = spark.range(n).select(F.lit("c").alias("k"), (F.pmod(F.xxhash64("id"), F.lit(10 ** 12)) / 1e6).alias("v"))
    r = exact_quantiles(df, ["k"], "v", (0.25, 0.75)).first()
    v = np.array([x.v for x in df.collect()])
    assert np.allclose([r.q0, r.q1], np.quantile(v, (0.25, 0.75)), rtol=1e-12)
    from hazegrid.operators import quantiles
    width = (np.quantile(v, 0.25 + quantiles.SLACK) - np.quantile(v, 0.25 - quantiles.SLACK)) / quantiles.RANGES
    assert ((v >= r.q0 - width) & (v <= r.q0 + width)).sum() < 50
