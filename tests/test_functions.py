import datetime as dt
import hashlib

from pyspark.sql import functions as F

from skyfold.functions import (
    city_of,
    district_of,
    element_label,
    last_match,
    object_timestamp,
    surrogate_key,
    weather_level,
    weather_level_sql,
)


def test_weather_level_edges(spark):
    df = spark.createDataFrame([(36.0,), (35.9,), (32.0,), (28.0,), (27.9,), (None,)], "t double")
    got = [r[0] for r in df.select(weather_level("t")).collect()]
    assert got == ["Extreme", "Hot", "Hot", "Warm", "Normal", "Normal"]


def test_weather_level_sql_matches_column(spark):
    df = spark.createDataFrame([(36.0,), (31.9,), (None,)], "t double")
    a = [r[0] for r in df.select(weather_level("t")).collect()]
    b = [r[0] for r in df.selectExpr(weather_level_sql("t")).collect()]
    assert a == b


def test_area_split_characters_not_bytes(spark):
    df = spark.createDataFrame([("臺北市信義區",), ("abc",), ("ab",), (None,)], "area string")
    rows = df.select(city_of("area").alias("c"), district_of("area").alias("d")).collect()
    assert [(r.c, r.d) for r in rows] == [("臺北市", "信義區"), ("abc", ""), ("ab", ""),
                                          (None, None)]


def test_surrogate_key_null_propagates(spark):
    df = spark.createDataFrame([("abc", "x"), ("abc", None)], "a string, b string")
    rows = df.select(surrogate_key("a", "b").alias("k"), surrogate_key("a").alias("k1")).collect()
    assert rows[0].k == hashlib.md5(b"abcx").hexdigest()
    assert rows[1].k is None
    assert rows[0].k1 == "900150983cd24fb0d6963f7d28e17f72"


def test_element_label(spark):
    df = spark.createDataFrame([("MinT",), ("MaxT",), ("PoP",)], "c string")
    assert [r[0] for r in df.select(element_label("c")).collect()] == [
        "LowestTemp", "HighestTemp", None]


def test_last_match(spark):
    df = spark.createDataFrame(
        [([("alert_criteria", "a"), ("x", "y"), ("alert_criteria", "b")],), ([("x", "y")],),
         ([],), (None,)],
        "p array<struct<valueName:string,value:string>>")
    got = [r[0] for r in df.select(last_match("p", "valueName", "value", "alert_criteria")).collect()]
    assert got == ["b", None, None, None]


def test_object_timestamp(spark):
    names = ["weather/temperature_2026-06-03T20:30:00+00:00.json",
             "weather/etl_temperature_2026-06-03T09:16:33.123456+00:00.parquet",
             "bronze/temperature/batch_id=20260603T203000Z/part-0000.txt",
             "weather/readme.txt"]
    df = spark.createDataFrame([(n,) for n in names], "p string")
    got = [r[0] for r in df.select(object_timestamp("p").cast("timestamp_ntz")).collect()]
    assert got == [dt.datetime(2026, 6, 3, 20, 30), dt.datetime(2026, 6, 3, 9, 16, 33, 123456),
                   dt.datetime(2026, 6, 3, 20, 30), None]


def test_no_python_udfs_in_column_functions(spark):
    df = spark.createDataFrame([("abcdef", 30.0)], "a string, t double")
    plan = df.select(city_of("a"), district_of("a"), weather_level("t"),
                     surrogate_key("a"), F.col("t"))._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
