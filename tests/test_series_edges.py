"""Rows without a place in a series, the shared folder, and functions on workers that lack the package."""

import datetime as dt
import os
import subprocess
import sys
from types import SimpleNamespace

import pytest
from pyspark import cloudpickle

from hazegrid import session
from hazegrid.learning import knn
from hazegrid.operators import features, gaps, reads, star
from hazegrid.operators.ordered import HOURLY

T0 = dt.datetime(2020, 1, 1)


@pytest.fixture(scope="module")
def loose(spark):
    rows = [("a", T0 + dt.timedelta(hours=h), None if h == 2 else float(h), "N") for h in range(5)]
    rows += [(None, T0, 7.0, None), (None, T0, None, None), ("a", None, 8.0, None), ("a", None, None, None), (None, None, None, None)]
    return rows, spark.createDataFrame(rows, "station string, ts timestamp_ntz, pm2_5 double, wd string")


def test_no_row_is_lost(spark, loose):
    rows, df = loose
    for out in (gaps.impute(df), gaps.interpolate_time(df, ["pm2_5"]), gaps.interpolate_linear(df, "pm2_5"), gaps.ffill_bfill(df, ["pm2_5"]),
                features.add_lag_features(df, lags=(1,)), features.add_moving_averages(df, windows=(3,)), features.next_label(df, at=HOURLY)):
        assert out.count() == len(rows)
    filled = gaps.impute(df).collect()
    assert sorted(r.pm2_5 for r in filled if r.station and r.ts) == [0.0, 1.0, 2.0, 3.0, 4.0]
    assert sorted(str(r.pm2_5) for r in filled if not (r.station and r.ts)) == ["7.0", "8.0", "None", "None", "None"]
    lagged = features.add_lag_features(df, lags=(1,)).collect()
    assert all(r["pm2_5_lag1"] is None for r in lagged if not (r.station and r.ts))


def test_ranges_have_no_limit_of_their_own(spark):
    cols = "station string, ts timestamp_ntz, pm2_5 double, pm10 double, so2 double, no2 double, co double, o3 double"
    many = spark.createDataFrame([("a", T0 + dt.timedelta(hours=h), 1.0, None, None, None, None, None) for h in range(1500)], cols)
    asked = spark.createDataFrame([(1, "a", T0, T0 + dt.timedelta(days=90)), (2, "a", T0 - dt.timedelta(9), T0 - dt.timedelta(1)),
                                   (3, "x", T0, T0)], "req_id long, station string, start timestamp_ntz, end timestamp_ntz")
    assert reads.range_read(many, asked).count() == 1500
    known = spark.createDataFrame([("a",)], "station_name string")
    assert {r.req_id: (r.status, r.n_readings) for r in reads.range_status(many, known, asked).collect()} == {
        1: ("ok", 1500), 2: ("empty", 0), 3: ("not_found", 0)}


def test_newest_rows_need_one_scan_and_range_reads_filter_the_station_first(spark, tmp_path):
    facts = spark.createDataFrame([(s, T0 + dt.timedelta(hours=h % 3), float(h)) for s in (1, 2) for h in range(6)], "station_id int, ts timestamp_ntz, pm2_5 double")
    path = str(tmp_path / "poll")
    facts.selectExpr("*", "pm2_5 AS pm10", "pm2_5 AS no2", "pm2_5 AS co").write.parquet(path)
    st = spark.createDataFrame([(1, "one"), (2, "two")], "station_id int, station_name string")
    out = star.latest_per_station({"pollutant_readings": spark.read.parquet(path), "stations": st})
    assert out._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert sorted((r.station_name, r.pm2_5) for r in out.collect()) == [("one", 2.0), ("one", 5.0), ("two", 2.0), ("two", 5.0)]


def test_a_cluster_needs_a_shared_folder():
    def fake(master, folder=None):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: folder),
                               sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: folder, setCheckpointDir=lambda f: None))

    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            session.shared_dir(fake(master))
        assert session.shared_dir(fake(master, "hdfs:///shared")) == "hdfs:///shared"


def test_functions_travel_by_value(tmp_path):
    (tmp_path / "f.pkl").write_bytes(cloudpickle.dumps(knn._squared))
    code = f"import pickle, numpy as np; f = pickle.load(open(r'{tmp_path}/f.pkl', 'rb')); print(f(np.zeros((1, 2)), np.ones((1, 2)))[0, 0])"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True)
    assert done.returncode == 0 and float(done.stdout) == 2.0, done.stderr
