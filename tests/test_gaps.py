"""Gap filling against pandas, with chunks so small that every gap crosses some."""

import math

import pandas as pd
import pytest

from hazegrid.operators import gaps
from hazegrid.operators.ordered import Layout

SMALL = Layout(chunk_days=0.2, block_rows=5)
N = None


def values():
    x = []
    for i, gap in enumerate((1, 6, 7, 12, 13, 20)):
        x += [10.0 + 3 * i, 7.0 - i] + [N] * gap
    return [N] * 8 + x + [5.0] + [N] * 10


def reference(df, limit=6):
    out = []
    for _, g in df.sort_values(["station", "ts"]).groupby("station"):
        g = g.set_index("ts")
        g["near"] = g["pm2_5"].interpolate(method="time", limit=limit, limit_direction="both")
        g["full"] = g["near"].ffill().bfill()
        g["wd"] = g["wd"].ffill().bfill().fillna("N")
        g["linear"] = g["pm2_5"].interpolate()
        out.append(g.reset_index())
    return pd.concat(out).set_index(["station", "ts"]).sort_index()


def frame(df, col):
    return df.toPandas().set_index(["station", "ts"]).sort_index()[col]


def same(a, b):
    assert len(a) == len(b)
    for x, y in zip(a, b):
        assert (pd.isna(x) and pd.isna(y)) or x == y or math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-9)


@pytest.fixture(scope="module")
def data(series):
    x = values()
    hours = {"holes": [h + (5 if h > 20 else 0) + (30 if h > 60 else 0) for h in range(len(x))]}
    wind = {"full": [N, "E"] + [N] * 40 + ["S"] + [N] * (len(x) - 43), "holes": ["W" if i % 9 == 4 else N for i in range(len(x))],
            "none": [N] * 5, "one": [N, N, "E"]}
    return series({"full": x, "holes": x, "none": [N] * 5, "one": [N, 4.0, N]}, hours, wind)


@pytest.mark.parametrize("at", [SMALL, Layout()])
def test_fills_match_pandas(data, at):
    want = reference(data.toPandas().astype({"pm2_5": float}))
    one = data.select("station", "ts", "pm2_5")
    same(frame(gaps.interpolate_time(one, ["pm2_5"], 6, at), "pm2_5"), want["near"])
    same(frame(gaps.interpolate_linear(one, "pm2_5", at), "pm2_5"), want["linear"])
    done = gaps.impute(data, 6, at)
    same(frame(done, "pm2_5"), want["full"])
    assert list(frame(done, "wd")) == list(want["wd"])


def test_two_steps_equal_one(data):
    two = gaps.ffill_bfill(gaps.interpolate_time(data, ["pm2_5"], 6, SMALL), ["pm2_5", "wd"], SMALL, {"wd": "N"})
    assert sorted(map(str, two.collect())) == sorted(map(str, gaps.impute(data, 6, SMALL).collect()))


def test_all_missing_station_stays_missing(data):
    rows = gaps.impute(data, 6, SMALL).where("station = 'none'").collect()
    assert all(r.pm2_5 is None and r.wd == "N" for r in rows) and len(rows) == 5


def test_resample_has_every_day(series):
    d = series({"a": [1.0, 2.0, 3.0]}, {"a": [0, 1, 49]})
    rows = sorted(gaps.resample_daily(d, "pm2_5").collect(), key=lambda r: r.date)
    assert [r.pm2_5 for r in rows] == [1.5, None, 3.0]
