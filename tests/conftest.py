import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from hazegrid.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def series(spark):
    """Builds a frame from {station: [values]}; one row an hour unless the hours are given."""
    import datetime as dt

    def make(data, hours=None, wind=None, start=dt.datetime(2020, 1, 1)):
        rows = []
        for name, values in data.items():
            for i, v in enumerate(values):
                h = hours[name][i] if hours and name in hours else i
                rows.append((name, start + dt.timedelta(hours=h), None if v is None else float(v), wind[name][i] if wind else None))
        return spark.createDataFrame(rows, "station string, ts timestamp_ntz, pm2_5 double, wd string")

    return make
