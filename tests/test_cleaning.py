import datetime as dt

import pytest
from pyspark.sql import functions as F

from hazegrid.functions.category import category, category_ordinal
from hazegrid.operators import cleaning, outliers
from hazegrid.sources.readings import read_readings


def test_numbers_from_text(spark):
    texts = ["1.5", "NA", "abc", "", "nan", "-3", " 7 ", "1d", "2f", "1e3", "inf"]
    df = spark.createDataFrame([(t,) for t in texts], "pm2_5 string")
    assert [r[0] for r in cleaning.coerce_numeric(df, ["pm2_5"]).collect()] == [1.5, None, None, None, None, -3.0, 7.0, None, None, 1000.0, float("inf")]


def test_clean_keeps_first_and_drops_negatives(spark):
    rows = [(2, "a", 2020, 1, 1, 0, "5", "-4"), (1, "a", 2020, 1, 1, 0, "-1", "-4"), (3, "a", 2020, 1, 1, 1, "x", "2")]
    df = spark.createDataFrame(rows, "no int, station string, year int, month int, day int, hour int, pm2_5 string, temp string")
    out = {r.ts: r for r in cleaning.clean(df).collect()}
    assert out[dt.datetime(2020, 1, 1)].no == 1 and out[dt.datetime(2020, 1, 1)].pm2_5 is None
    assert out[dt.datetime(2020, 1, 1)].temp == -4.0 and out[dt.datetime(2020, 1, 1, 1)].pm2_5 is None


def test_bad_date_parts(spark):
    df = spark.createDataFrame([(2020, 2, 30, 0)], "year int, month int, day int, hour int")
    assert cleaning.add_datetime(df, strict=False).first().ts is None
    with pytest.raises(Exception):
        cleaning.add_datetime(df).collect()


def test_category_edges(spark):
    values = [-0.5, 0.0, 12.0, 12.01, 35.4, 35.45, 55.4, 150.4, 250.4, 250.5, None, float("nan")]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    rows = df.select(category_ordinal(F.col("v")).alias("o"), category(F.col("v")).alias("c")).collect()
    assert [r.o for r in rows] == [None, 0, 0, 1, 1, 2, 2, 3, 4, 5, None, None]
    assert rows[9].c == "Hazardous" and rows[0].c is None


def test_flat_columns_are_not_capped(spark):
    df = spark.createDataFrame([("a", float(i % 10), 1.0 if i else 50.0) for i in range(100)] + [("a", 900.0, 1.0)],
                               "station string, pm2_5 double, wspm double")
    fences = outliers.fit_fences(df)
    done = outliers.cap_outliers(df, fences)
    assert done.agg(F.max("pm2_5")).first()[0] == fences.where("channel = 'pm2_5'").first().fence
    assert done.agg(F.max("wspm")).first()[0] == 50.0
    assert {r.channel: r.capped for r in outliers.cap_report(df, fences).collect()} == {"pm2_5": 1, "wspm": 0}


def test_csv_columns_are_matched_by_name(spark, tmp_path):
    (tmp_path / "b" / "deep").mkdir(parents=True)
    (tmp_path / "b" / "PRSA_Data_A.csv").write_text(
        '"No","year","month","day","hour","PM2.5","CO","wd","station"\n1,2013,3,1,0,4,300,"NNW","A"\n2,2013,3,1,1,NA,NA,NA,"A"\n')
    (tmp_path / "b" / "deep" / "PRSA_Data_B.csv").write_text(
        "station,CO,PM2.5,hour,day,month,year,No,extra\nB,100,abc,0,1,3,2013,1,zz\n")
    (tmp_path / "b" / "other.csv").write_text("x\n1\n")
    df = read_readings(spark, [str(tmp_path / "absent"), str(tmp_path / "b")])
    rows = {(r.station, r.no): r for r in df.collect()}
    assert len(rows) == 3 and rows["B", 1].co == "100" and rows["B", 1].pm2_5 == "abc" and rows["B", 1].wd is None
    assert rows["A", 2].pm2_5 is None and rows["A", 1].wd == "NNW" and rows["A", 1].o3 is None
    assert len(df.columns) == 18
    with pytest.raises(FileNotFoundError):
        read_readings(spark, [str(tmp_path / "absent")])
