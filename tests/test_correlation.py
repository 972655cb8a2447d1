"""Correlations where a channel does not vary; the check SQL gives NaN there."""

import math

import pytest

from hazegrid.operators import aggregates

SCHEMA = "pm2_5 double, co double, wspm double, dewp double"
ROWS = [(1.0, 2.0, 8.0, None), (2.0, 1.0, 8.0, None), (4.0, None, 8.0, None), (3.0, 5.0, 8.0, None)]
SQL = "SELECT corr({0}, {1}) FROM (VALUES (1.0::DOUBLE, 2.0::DOUBLE, 8.0::DOUBLE, NULL::DOUBLE), (2, 1, 8, NULL), (4, NULL, 8, NULL), (3, 5, 8, NULL)) t(pm2_5, co, wspm, dewp)"


def same(x, y):
    return x == y or None not in (x, y) and (abs(x - y) < 1e-12 or math.isnan(x) and math.isnan(y))


def test_drivers_with_a_constant_channel(spark):
    """NaN counts as the largest value; a channel without a pair is left out."""
    r = aggregates.corr_drivers(spark.createDataFrame(ROWS, SCHEMA)).collect()
    assert len(r) == 1 and (r[0].strongest_positive, r[0].strongest_negative) == ("wspm", "co")
    assert math.isnan(r[0].max_r) and same(r[0].min_r, 3.0 / math.sqrt(2 * 26 / 3))


def test_matrix_with_a_constant_channel(spark):
    duckdb = pytest.importorskip("duckdb")
    found = {(r.a, r.b): r.r for r in aggregates.corr_matrix(spark.createDataFrame(ROWS, SCHEMA)).collect()}
    assert len(found) == 16
    for (a, b), r in found.items():
        assert same(r, duckdb.connect().execute(SQL.format(a, b)).fetchone()[0]), (a, b)
