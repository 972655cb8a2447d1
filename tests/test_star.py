"""Top hours from candidates: rows without weather do not shorten the list, and facts are joined to candidates only."""

import datetime as dt
import random

import pytest

from hazegrid.operators import star as star_ops

T0 = dt.datetime(2020, 1, 1)


def tables(spark, weather_from):
    """Two stations, 300 hours each; only the hours at or below a value have weather."""
    r = random.Random(5)
    poll = [(i, s, T0 + dt.timedelta(hours=i), None if i % 50 == 0 else float(r.randrange(100))) for s in (1, 2) for i in range(300)]
    weather = [(i, s, ts, 1.0, 1 if i % 2 else None) for i, s, ts, x in poll if x is None or x <= weather_from]
    return {
        "stations": spark.createDataFrame([(1, "b"), (2, "a")], "station_id int, station_name string"),
        "wind_directions": spark.createDataFrame([(1, "N")], "wind_dir_id int, wd_code string"),
        "pollutant_readings": spark.createDataFrame(poll, "reading_id long, station_id int, ts timestamp_ntz, pm2_5 double"),
        "weather_readings": spark.createDataFrame(weather, "reading_id long, station_id int, ts timestamp_ntz, wspm double, wind_dir_id int"),
    }


@pytest.mark.parametrize("weather_from, candidates", [(100, 20_000), (60, 20_000), (1, 20_000), (-1, 20_000), (60, 50)])
def test_top_hours(spark, monkeypatch, weather_from, candidates):
    monkeypatch.setattr(star_ops, "CANDIDATES", candidates)
    t = tables(spark, weather_from)
    names = {1: "b", 2: "a"}
    have = {(r.station_id, r.ts) for r in t["weather_readings"].collect()}
    want = sorted(((r.pm2_5 is None, -(r.pm2_5 or 0), names[r.station_id], r.ts) for r in t["pollutant_readings"].collect() if (r.station_id, r.ts) in have))[:10]
    got = star_ops.top_hours(t, 10).collect()
    assert [(r.pm2_5 is None, -(r.pm2_5 or 0), r.station_name, r.ts) for r in got] == want
