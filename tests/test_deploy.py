"""Versions of a model folder: complete or not there, newest first, and forecasts from them."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from hazegrid.constants import FEATURES
from hazegrid.learning import dataset, deploy, models, scoring
from hazegrid.plans.bindings import WEIGHTS

D0 = dt.datetime(2020, 1, 1)
CHANNELS = ("pm2_5", "pm10", "so2", "no2", "co", "o3", "temp", "pres", "dewp", "rain", "wspm")


@pytest.fixture(scope="module")
def design(spark):
    r = random.Random(4)
    rows = [(s, D0 + dt.timedelta(days=i), *[r.gauss(3, 2) for _ in FEATURES], r.randrange(5)) for s in ("a", "b") for i in range(60)]
    return spark.createDataFrame(rows, "station string, date timestamp_ntz, " + ", ".join(f"{f} double" for f in FEATURES) + ", y int").cache()


@pytest.fixture(scope="module")
def fences(spark):
    return spark.createDataFrame([("a", "pm2_5", 1.0, 2.0, 1.0, 5.0)], "station string, channel string, q1 double, q3 double, iqr double, fence double")


def test_versions_are_whole_or_absent(spark, design, fences, tmp_path):
    path = str(tmp_path / "models")
    with pytest.raises(LookupError):
        deploy.load_version(spark, path)
    scaler = dataset.fit_scaler(design)
    assert deploy.save_version(path, WEIGHTS, scaler, fences, {"deployed_model": "one"}) == 1
    # an interrupted second version: everything is there but the metadata
    half = tmp_path / "models" / "000002-broken"
    scaler.write.parquet(str(half / "scaler"))
    spark.createDataFrame([(0, "bias", 9.0)], deploy.WEIGHT_ROWS).write.parquet(str(half / "model"))
    assert deploy.load_version(spark, path).meta["deployed_model"] == "one"
    with pytest.raises(TypeError):      # a table that cannot be written leaves the first version in force
        deploy.save_version(path, WEIGHTS, scaler, fences, {"deployed_model": {1, 2}})
    assert deploy.load_version(spark, path).meta["version"] == 1
    assert deploy.save_version(path, WEIGHTS, scaler, fences, {"deployed_model": "two"}, extra=design.limit(3)) == 2
    newest, first = deploy.load_version(spark, path), deploy.load_version(spark, path, 1)
    assert (newest.meta["deployed_model"], first.meta["deployed_model"]) == ("two", "one")
    assert newest.table("extra").count() == 3 and newest.fences.collect() == fences.collect()
    assert newest.model == WEIGHTS
    with pytest.raises(LookupError):
        deploy.load_version(spark, path, 7)


@pytest.mark.parametrize("kind", ["softmax", "stages"])
def test_stored_model_scores_as_before(spark, design, fences, tmp_path, kind):
    scaler = dataset.fit_scaler(design)
    scaled = dataset.apply_scaler(design, scaler)
    if kind == "softmax":
        model, want = WEIGHTS, scoring.score_softmax(scaled, WEIGHTS)
    else:
        model = models.fit_mlp(scaled, 3, max_iter=5)
        want = models.predict(model, scaled)
    deploy.save_version(str(tmp_path / "m"), model, scaler, fences)
    got = deploy.load_version(spark, str(tmp_path / "m")).score(design)
    pick = lambda d: [(r.station, r.date, r.prediction, round(r.p0, 9), round(r.p5, 9)) for r in d.orderBy("station", "date").collect()]
    assert pick(got) == pick(want)
    assert all(r.confidence == max(r[f"p{c}"] for c in range(6)) for r in got.collect())


def daily(spark, days, stations=("a", "b")):
    r = random.Random(8)
    rows = [(s, D0 + dt.timedelta(days=i), *[abs(r.gauss(60, 40)) for _ in CHANNELS]) for s in stations for i in range(days)]
    return spark.createDataFrame(rows, "station string, ts timestamp_ntz, " + ", ".join(f"{c} double" for c in CHANNELS))


def test_forecast_uses_stored_fences(spark, design, tmp_path):
    from hazegrid.operators.documents import to_documents
    hourly = daily(spark, 60).unionByName(daily(spark, 20, ("few",)))
    none = spark.createDataFrame([], "station_name string, station_type string, latitude double, longitude double")
    docs = to_documents(hourly.withColumn("wd", F.lit(None).cast("string")), none)
    low = spark.createDataFrame([(s, "pm2_5", 1.0, 2.0, 1.0, 8.0) for s in ("a", "b")], "station string, channel string, q1 double, q3 double, iqr double, fence double")
    path = str(tmp_path / "m")
    deploy.save_version(path, WEIGHTS, dataset.fit_scaler(design), low, {"deployed_model": "fixed"})
    rows = {r.station: r for r in deploy.forecast(docs, deploy.load_version(spark, path)).collect()}
    assert set(rows) == {"a", "b", "few"} and rows["few"].feature_days == 20 - 9
    for s in "ab":
        r = rows[s]
        assert r.today_category == "Good" and r.forecast_date == D0 + dt.timedelta(days=60)     # capped at 8
        best = sorted(((-r[f"p{c}"], c) for c in range(6)))[:3]
        assert [r.probability1, r.probability2, r.probability3] == [-p for p, _ in best] and r.top1 == r.forecast_category
        assert (r.deployed_model, r.version) == ("fixed", 1)
    assert rows["few"].today_category != "Good" or rows["few"].forecast_date == D0 + dt.timedelta(days=20)
    back = {r.station: r.days for r in deploy.backtest(hourly, deploy.load_version(spark, path)).collect()}
    assert back == {"a": 50, "b": 50, "few": 10}
