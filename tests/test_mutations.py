import datetime as dt
import random

import pytest

from hazegrid.operators import documents, mutations, reads
from hazegrid.sources.tables import read_docs, to_json_rows, write_docs
from hazegrid.streaming.ingest import ingest_stream, read_accepted

T0 = dt.datetime(2020, 1, 1)
T1 = dt.datetime(2020, 1, 1, 1)
T2 = dt.datetime(2020, 1, 1, 2)
FIELDS = "pm2_5 double, pm10 double, so2 double, no2 double, co double, o3 double"
REQ = "req_id long, station string, ts timestamp_ntz, pm2_5 double, pm10 double"


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame([("a", T0, 1.0, 2.0, 3.0, 4.0, 5.0, 6.0), ("b", T0, 9.0, None, None, None, None, None)],
                                 f"station string, ts timestamp_ntz, {FIELDS}")


@pytest.fixture(scope="module")
def stations(spark):
    return spark.createDataFrame([("a", "urban", 1.0, 2.0), ("b", "urban", None, None)],
                                 "station_name string, station_type string, latitude double, longitude double")


def status(df):
    return {r.req_id: r.status for r in df.collect()}


def test_create(spark, table, stations):
    req = spark.createDataFrame([(1, "a", T0, 7.0, None), (3, "a", T1, 8.0, None), (2, "a", T1, 5.0, 1.0), (4, "x", T1, 1.0, 1.0)], REQ)
    assert status(mutations.create_status(table, stations, req)) == {1: "conflict", 2: "ok", 3: "conflict", 4: "not_found"}
    rows = mutations.create_rows(table, stations, req).collect()
    new = [r for r in rows if r.ts == T1]
    assert len(rows) == 3 and len(new) == 1 and new[0].pm2_5 == 5.0 and new[0].o3 is None


def test_update(spark, table):
    req = spark.createDataFrame([(1, "a", T0, 7.0, None), (2, "a", T0, None, 4.0), (3, "a", T0, 8.0, None), (4, "a", T1, 1.0, 1.0),
                                 (5, "b", T0, None, None)], REQ)
    assert status(mutations.update_status(table, req)) == {1: "ok", 2: "ok", 3: "ok", 4: "not_found", 5: "ok"}
    rows = {r.station: r for r in mutations.update_rows(table, req).collect()}
    assert (rows["a"].pm2_5, rows["a"].pm10, rows["a"].so2, rows["b"].pm2_5) == (8.0, 4.0, 3.0, 9.0) and len(rows) == 2


def test_delete(spark, table):
    req = spark.createDataFrame([(1, "a", T0, None, None), (2, "a", T0, None, None), (3, "c", T0, None, None)], REQ)
    assert status(mutations.delete_status(table, req)) == {1: "ok", 2: "not_found", 3: "not_found"}
    assert [r.station for r in mutations.delete_rows(table, req).collect()] == ["b"]


def test_reads(spark, table):
    ask = spark.createDataFrame([(1, "a", T0), (2, "a", T1), (3, "x", T0)], "req_id long, station string, ts timestamp_ntz")
    assert status(reads.get(table, ask)) == {1: "ok", 2: "not_found", 3: "not_found"}
    assert status(reads.latest(table, ask)) == {1: "ok", 2: "ok", 3: "not_found"}
    many = spark.createDataFrame([("a", T0 + dt.timedelta(days=i), float(i), None, None, None, None, None) for i in range(100)], table.schema)
    span = spark.createDataFrame([(1, "a", T0, T0 + dt.timedelta(days=80)), (2, "a", T1, T2), (3, "x", T0, T2)],
                                 "req_id long, station string, start timestamp_ntz, end timestamp_ntz")
    rows = reads.range_read(many, span.selectExpr("*", "50 AS limit")).collect()
    assert sorted(r.pm2_5 for r in rows) == [float(i) for i in range(50)] and {r.req_id for r in rows} == {1}


def docs(spark):
    rows = [("a", "urban", (1.0, 2.0), T0, (2020, 1, 1, 0, 1), (1.0, 2.0, 3.0, 4.0, 5.0, 6.0), (7.0, 8.0, 9.0, 0.0, "N", 1.5)),
            ("b", "urban", None, T0, None, None, None)]
    return spark.createDataFrame(rows, documents.DOCUMENT_SCHEMA)


def test_doc_update(spark):
    req = spark.createDataFrame([
        (1, "a", T0, "pollutants.pm2_5", "50"), (2, "a", T0, "pollutants.pm2_5", None), (1, "a", T0, "weather", '{"temp": 3, "wind_dir": "S"}'),
        (2, "a", T0, "weather.wspm", "4.5"), (1, "a", T0, "station", '"z"'), (1, "a", T0, "location.lat", "9"),
        (3, "b", T0, "pollutants.co", "11"), (4, "c", T0, "pollutants.co", "1")],
        "req_id long, station string, timestamp timestamp_ntz, path string, value string")
    rows = {r.station: r for r in mutations.doc_update(docs(spark), req).collect()}
    a, b = rows["a"], rows["b"]
    assert a.pollutants.pm2_5 is None and a.pollutants.pm10 == 2.0 and a.location.lat == 1.0
    assert (a.weather.temp, a.weather.wind_dir, a.weather.wspm, a.weather.pres) == (3.0, "S", 4.5, None)
    assert b.pollutants.co == 11.0 and b.pollutants.pm10 is None and b.weather is None and len(rows) == 2
    assert status(mutations.doc_update_status(docs(spark), req)) == {1: "ok", 2: "ok", 3: "ok", 4: "not_found"}


def test_doc_create_and_delete(spark):
    req = spark.createDataFrame([(1, "a", T0, None), (2, "z", T0, (1.0,)), (3, "z", T0, (2.0,))],
                                "req_id long, station string, timestamp timestamp_ntz, p struct<pm2_5 double>")
    req = req.selectExpr("req_id", "station", "timestamp", "IF(p IS NULL, NULL, named_struct('pm2_5', p.pm2_5, 'pm10', 0D, 'so2', 0D, 'no2', 0D, 'co', 0D, 'o3', 0D)) AS pollutants")
    assert status(mutations.doc_create_status(docs(spark), req)) == {1: "conflict", 2: "ok", 3: "conflict"}
    rows = {r.station: r for r in mutations.doc_create(docs(spark), req).collect()}
    assert len(rows) == 3 and rows["z"].pollutants.pm2_5 == 1.0 and rows["z"].weather is None
    gone = mutations.doc_delete(docs(spark), req)
    assert [r.station for r in gone.collect()] == ["b"]
    assert status(mutations.doc_delete_status(docs(spark), req)) == {1: "ok", 2: "not_found", 3: "not_found"}


def test_doc_create_evaluates_its_inputs_once(spark):
    """Neither the documents nor the requests are computed a second time for the look-ups; requests without key or number are
    refused, and those that share the first number of a key are all kept."""
    base = spark.range(3, numPartitions=2).selectExpr(
        "IF(id = 2, NULL, concat('s', id)) AS station", "'urban' AS station_type", "named_struct('lat', 1D, 'lon', 2D) AS location",
        "TIMESTAMP_NTZ'2020-01-01 00:00:00' AS timestamp", "CAST(NULL AS struct<year int>) AS time",
        "named_struct('pm2_5', double(id)) AS pollutants", "CAST(NULL AS struct<temp double>) AS weather")
    req = spark.range(8, numPartitions=2).selectExpr(
        "CASE id WHEN 7 THEN NULL WHEN 5 THEN 4 ELSE id END AS req_id", "CASE WHEN id = 0 THEN NULL WHEN id < 3 THEN 's1' ELSE 'new' END AS station",
        "IF(id = 3, NULL, TIMESTAMP_NTZ'2020-01-01 00:00:00') AS timestamp", "named_struct('pm2_5', double(id)) AS pollutants")
    made = mutations.doc_create(base, req)
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (") == 1
    assert sorted((r.station or "", r.pollutants.pm2_5) for r in made.collect()) == [("", 2.0), ("new", 4.0), ("new", 5.0), ("s0", 0.0), ("s1", 1.0)]


def test_documents_are_written_compressed(spark, tmp_path):
    many = spark.range(5000).selectExpr(
        "concat('s', id % 7) AS station", "'urban' AS station_type", "named_struct('lat', 1D, 'lon', 2D) AS location",
        "TIMESTAMP_NTZ'2020-01-01 00:00:00' + make_interval(0, 0, 0, 0, int(id)) AS timestamp",
        "named_struct('year', 2020, 'month', 1, 'day', 1, 'hour', int(id % 24), 'is_heating_season', 1) AS time",
        "named_struct('pm2_5', double(id), 'pm10', 1D, 'so2', 1D, 'no2', 1D, 'co', double(NULL), 'o3', 1D) AS pollutants",
        "named_struct('temp', 1D, 'pres', 1D, 'dewp', 1D, 'rain', 1D, 'wind_dir', 'N', 'wspm', double(id)) AS weather")
    path = str(tmp_path / "docs")
    write_docs(many, path)
    plain = sum(len(r.j) + 1 for r in to_json_rows(many, "j").collect())
    assert sum(f.stat().st_size for f in (tmp_path / "docs").glob("part-*")) < plain / 5
    back = read_docs(spark, path)
    assert back.count() == 5000 and back.exceptAll(many.to(back.schema)).count() == 0


def test_stream_accepts_each_key_once_and_survives_a_restart(spark, table, stations, tmp_path):
    src, sink, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    req = spark.createDataFrame([(1, "a", T0, 1.0, None), (2, "a", T1, 2.0, None), (3, "a", T1, 3.0, None), (4, "x", T1, 1.0, None)], REQ)
    req.coalesce(1).write.parquet(src)

    def run():
        stream = spark.readStream.schema(req.schema).parquet(src)
        ingest_stream(stream, table, stations, sink, state).awaitTermination()

    run()
    later = spark.createDataFrame([(5, "a", T1, 9.0, None), (6, "b", T2, 4.0, None)], REQ)
    later.coalesce(1).write.mode("append").parquet(src)
    run()
    run()
    rows = {(r.station, r.ts): r.pm2_5 for r in read_accepted(spark, sink).collect()}
    assert rows == {("a", T1): 2.0, ("b", T2): 4.0}
    refused = {r.req_id: r.status for r in spark.read.parquet(f"{sink}/refused").collect()}
    assert refused == {1: "conflict", 3: "conflict", 4: "not_found", 5: "conflict"}


def test_stream_batches_read_their_own_days(spark, table, stations, tmp_path):
    """Many batches on many days: a late request meets its own day's keys, and only that day's folder is read. A request
    without a time is kept too."""
    src, sink, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    days = [T0.replace(year=2031, month=1, day=d) for d in range(1, 7)]

    def run(rows):
        spark.createDataFrame(rows, REQ).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(REQ).parquet(src)
        ingest_stream(stream, table, stations, sink, state, "yyyy-MM-dd").awaitTermination()

    for i, d in enumerate(days):
        run([(10 * i, "a", d, float(i), None), (10 * i + 1, "b", d, float(i), None)])
    run([(100, "a", days[0], 7.0, None), (101, "b", days[2].replace(hour=23), 8.0, None), (102, "a", None, 9.0, None)])
    rows = sorted((str(r.ts), r.station, r.pm2_5) for r in read_accepted(spark, sink).collect())
    assert rows == sorted([(str(d), s, float(i)) for i, d in enumerate(days) for s in "ab"]
                          + [(str(days[2].replace(hour=23)), "b", 8.0), ("None", "a", 9.0)])
    assert [(r.req_id, r.status) for r in spark.read.parquet(f"{sink}/refused").collect()] == [(100, "conflict")]
    one = read_accepted(spark, sink, ["2031-01-03", "2031-09-09"])
    assert {r.batch for r in one.collect()} == {2, 6} and all("period=2031-01-03" in f for f in one.inputFiles())
    assert read_accepted(spark, sink, ["2031-09-09"]).count() == 0


def test_stream_batch_that_runs_again_writes_nothing_twice(spark, table, stations, tmp_path):
    """The last batch's commit is lost: it runs again and overwrites its own folders."""
    src, sink, state = (str(tmp_path / n) for n in ("in", "out", "state"))

    def run():
        ingest_stream(spark.readStream.schema(REQ).parquet(src), table, stations, sink, state).awaitTermination()

    for rows in ([(1, "a", T1, 1.0, None)], [(2, "a", T1, 2.0, None), (3, "b", T2, 3.0, None)]):
        spark.createDataFrame(rows, REQ).coalesce(1).write.mode("append").parquet(src)
        run()
    before = sorted(map(str, read_accepted(spark, sink).collect()))
    for f in (tmp_path / "state" / "commits").glob("*1*"):
        f.unlink()
    run()
    assert sorted(map(str, read_accepted(spark, sink).collect())) == before and len(before) == 2


def test_first_readings_against_a_plain_loop(spark):
    """Short and long requests, shared numbers, no number, cells before 1970, no limit and limit 0."""
    r = random.Random(5)
    base = dt.datetime(1969, 6, 1)
    cols = "station string, ts timestamp_ntz, pm2_5 double, pm10 double, so2 double, no2 double, co double, o3 double"
    rows = [(s, base + dt.timedelta(hours=h), float(h), None, None, None, None, None) for s in "ab" for h in sorted(r.sample(range(24 * 500), 600))]
    asked = [(i, r.choice("abx"), base + dt.timedelta(hours=r.randint(-999, 12_500)), r.choice([0, 5, 40, 60, 61, 300]), r.choice([None, 0, 1, 5, 30])) for i in range(120)]
    asked = [(i, s, t, t + dt.timedelta(days=d), n) for i, s, t, d, n in asked]
    asked += [(900, "a", base, base + dt.timedelta(days=9), 7), (900, "b", base + dt.timedelta(days=200), base + dt.timedelta(days=209), 7),
              (None, "a", base, base + dt.timedelta(days=9), 3), (None, "b", base + dt.timedelta(1), base + dt.timedelta(days=9), 3),
              (901, "a", base, base - dt.timedelta(days=1), 3), (902, None, base, base + dt.timedelta(days=1), 3)]
    want = []
    for number in {q[0] for q in asked}:
        hits = sorted((x[1], x[0], q[4]) for q in asked if q[0] == number for x in rows if x[0] == q[1] and q[2] <= x[1] <= q[3])
        want += [(number, s, t) for k, (t, s, n) in enumerate(hits) if n is None or k < n]
    span = spark.createDataFrame(asked, "req_id long, station string, start timestamp_ntz, end timestamp_ntz, limit int")
    data = spark.createDataFrame([*rows, (None, base, 1.0, *[None] * 5), ("a", None, 1.0, *[None] * 5)], cols)
    got = [(x.req_id, x.station, x.ts) for x in reads.range_read(data, span).collect()]
    assert sorted(got, key=str) == sorted(want, key=str) and len(want) > 500


def test_limits_are_applied_before_hits_are_shuffled(spark):
    """Requests of like length that share no number: the only shuffle by number is that of the requests, once for both branches."""
    cols = "station string, ts timestamp_ntz, pm2_5 double, pm10 double, so2 double, no2 double, co double, o3 double"
    data = spark.createDataFrame([("a", T0 + dt.timedelta(days=d), 1.0, *[None] * 5) for d in range(100)], cols)
    span = spark.range(1000).selectExpr("id AS req_id", "'a' AS station", f"TIMESTAMP_NTZ'{T0}' AS start", f"TIMESTAMP_NTZ'{T0 + dt.timedelta(days=40)}' AS end", "5 AS limit")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = reads.range_read(data, span)
        assert len(out.collect()) == 5000
        final = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sum("Range (0, 1000" in line for line in final.splitlines()) == 1
