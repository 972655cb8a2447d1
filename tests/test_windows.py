"""Row frames, positions and quantiles with tiny blocks against pandas and numpy."""

import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from hazegrid.operators import aggregates, features, quality, quantiles
from hazegrid.operators.ordered import Layout, in_blocks, ordered_ids, with_position

TINY = Layout(chunk_days=0.4, block_rows=7)


@pytest.fixture(scope="module")
def data(series):
    r = random.Random(3)
    x = [None if r.random() < 0.2 else round(r.uniform(0, 300), 1) for _ in range(400)]
    return series({"hot": x, "short": x[:5], "flat": [3.0] * 40}, {"short": [0, 30, 31, 200, 900]})


def by_station(df):
    return {k: g.sort_values("ts").reset_index(drop=True) for k, g in df.toPandas().astype({"pm2_5": float}).groupby("station")}


def check(got, want):
    pd.testing.assert_series_equal(got.astype(float), want.astype(float), check_names=False, rtol=1e-9, atol=1e-6)


def test_history_matches_pandas(data):
    out = features.add_history(data.select("station", "ts", "pm2_5"), at=TINY)
    for g in by_station(out).values():
        s = g["pm2_5"]
        for k in (1, 2, 3, 24, 168):
            check(g[f"pm2_5_lag{k}"], s.shift(k))
        for n in (3, 24, 168):
            past = s.shift(1).rolling(n, min_periods=max(2, n // 4))
            check(g[f"pm2_5_ma{n}"], past.mean())
            check(g[f"pm2_5_mstd{n}"], past.std())


def test_rolling_full_and_lead(data):
    d = data.select("station", "ts", "pm2_5")
    full = by_station(features.rolling_full(d, "pm2_5", (24,), TINY))
    lead = by_station(features.next_label(d, at=TINY))
    for name in full:
        check(full[name]["pm2_5_ma24"], full[name]["pm2_5"].rolling(24).mean())
        cat = pd.cut(lead[name]["pm2_5"], [0, 12, 35.4, 55.4, 150.4, 250.4, np.inf], labels=False, include_lowest=True)
        check(lead[name]["y"], cat.shift(-1))


def test_positions_are_consecutive(data):
    for g in by_station(with_position(data, TINY)).values():
        assert list(g["_pos"]) == list(range(1, len(g) + 1))


def test_no_group_grows_with_a_station(data):
    """Whatever a station holds, a block has its own rows and the halo, and a chunk what fits into its time."""
    blocks = in_blocks(data, TINY, 5, 2).groupBy("station", "_block").count().agg(F.max("count")).first()[0]
    chunks = TINY.timed(data).groupBy("station", "_chunk").count().agg(F.max("count")).first()[0]
    assert blocks <= 7 + 5 + 2 and chunks <= 10


def test_acf_matches_definition(data):
    rows = aggregates.acf(data, nlags=50, at=TINY).where("station = 'hot'").collect()
    s = by_station(data)["hot"]["pm2_5"].interpolate().dropna().to_numpy()
    s = s - s.mean()
    want = [1.0] + [float(s[k:] @ s[:-k] / (s @ s)) for k in range(1, 51)]
    got = [r.acf for r in sorted(rows, key=lambda r: r.lag)]
    assert np.allclose(got, want, atol=1e-9)


def test_infer_frequency(data):
    got = {r.station: r.frequency_seconds for r in quality.infer_frequency(data, TINY).collect()}
    assert got == {"hot": 3600, "flat": 3600, "short": 3600}


def test_quantiles_of_small_and_hot_groups(spark, monkeypatch):
    # a low limit sends the big group through the brackets
    monkeypatch.setattr(quantiles, "SKETCH", 50)
    monkeypatch.setattr(quantiles, "SLACK", 4.0 / 50)
    r = np.random.default_rng(5)
    groups = {"hot": np.round(r.lognormal(3, 1, 20000), 1), "tied": np.repeat([0.0, 1.0, 5.0], [3000, 10, 3000]),
              "two": np.array([1.0, 2.0]), "one": np.array([7.0]), **{f"n{n}": r.integers(0, 9, n).astype(float) for n in range(1, 41)}}
    df = spark.createDataFrame([(k, float(v)) for k, vs in groups.items() for v in vs], "k string, v double")
    got = {x.k: x for x in quantiles.exact_quantiles(df, ["k"], "v", (0.25, 0.5, 0.75)).collect()}
    for k, vs in groups.items():
        assert got[k].n == len(vs)
        assert np.allclose([got[k].q0, got[k].q1, got[k].q2], np.quantile(vs, [0.25, 0.5, 0.75]))


def test_ordered_ids(spark):
    df = spark.range(1000).select(F.concat(F.lit("n"), F.lpad(F.col("id").cast("string"), 5, "0")).alias("name")).repartition(7)
    rows = ordered_ids(df, [F.col("name")], "i").orderBy("name").collect()
    assert [r.i for r in rows] == list(range(1, 1001))


def test_describe_matches_pandas(spark):
    x = [1.0, 2.5, 2.5, 9.0, 100.0, 3.0, 4.0]
    df = spark.createDataFrame([(v, 5.0) for v in x], "pm2_5 double, pm10 double")
    got = {r.channel: r for r in quality.describe_numeric(df, digits=6).collect()}
    s = pd.Series(x)
    assert got["pm2_5"].skew == pytest.approx(s.skew(), abs=1e-6) and got["pm2_5"].p25 == s.quantile(0.25)
    assert got["pm10"].skew == 0 and got["pm10"].std == 0


def test_histogram_keeps_every_value(spark):
    df = spark.createDataFrame([(float(v),) for v in (0, 1, 2, 3, 60, 60)], "pm2_5 double")
    rows = {r.bin: r.n for r in quality.histogram(df, ["pm2_5"]).collect()}
    assert len(rows) == 60 and rows[59] == 2 and sum(rows.values()) == 6


def test_date_slice_holds_both_days(series):
    d = series({"a": list(range(72))})
    assert features.date_slice(d, "2020-01-02", "2020-01-02").count() == 24
    assert d.agg(F.min("ts")).first()[0] == dt.datetime(2020, 1, 1)


def test_long_windows_are_exact_and_flat_ones_stay_flat(spark, series):
    """Runs put together at every place: gaps, a flat series far from zero, a series whose level jumps."""
    r = random.Random(9)
    jump = [1e6 + r.random() if i > 150 else (None if i % 6 == 0 else r.random()) for i in range(320)]
    data = series({"flat": [0.1] * 200, "big": [98765.4321] * 90, "jump": jump, "empty": [None] * 60})
    for windows in ((9,), (24, 30), (168,)):
        out = features.add_moving_averages(data.select("station", "ts", "pm2_5"), windows=windows, at=Layout(chunk_days=0.4, block_rows=40))
        for name, g in by_station(out).items():
            for n in windows:
                past, least = g["pm2_5"].shift(1), max(2, n // 4)
                mean = [w.mean() if w.count() >= least else np.nan for w in (past[max(0, i - n + 1):i + 1] for i in range(len(past)))]
                std = [w.std() if w.count() >= least else np.nan for w in (past[max(0, i - n + 1):i + 1] for i in range(len(past)))]
                np.testing.assert_allclose(g[f"pm2_5_ma{n}"].astype(float), mean, rtol=1e-12)
                np.testing.assert_allclose(g[f"pm2_5_mstd{n}"].astype(float), std, rtol=1e-8, atol=1e-9)
                if name in ("flat", "big"):
                    assert (g[f"pm2_5_mstd{n}"].dropna() < 1e-9).all()
