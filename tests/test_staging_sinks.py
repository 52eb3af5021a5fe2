import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyfold.operators import staging as ST
from skyfold.sinks import tables as K
from skyfold.sources import schemas as S

AS_OF = dt.datetime(2026, 6, 3, 21, 0, tzinfo=dt.timezone.utc)


def silver(spark, rows):
    return spark.createDataFrame(rows, "City string, Type string, startTime string, "
                                       "endTime string, Temp string, Unit string, batch_id string")


def test_positional_rename(spark):
    df = spark.createDataFrame([("a", "b")], "x string, y string")
    assert ST.rename_standard(df, ("p", "q")).columns == ["p", "q"]


def test_cast_strict_fails_on_malformed(spark):
    df = silver(spark, [("A", "LowestTemp", "2026-06-03 06:00:00", "2026-06-03 18:00:00",
                         "abc", "C", "20260603T203000Z")])
    with pytest.raises(Exception, match="malformed int in temp"):
        ST.forecast_to_staging(df, AS_OF).collect()


def test_cast_strict_types_and_wallclock(spark):
    df = silver(spark, [("A", "LowestTemp", "2026-06-03T06:00:00+08:00", "2026-06-03 18:00:00",
                         "21", "C", "20260603T203000Z")])
    r = ST.forecast_to_staging(df, AS_OF).collect()[0]
    assert r.temp == 21 and r.start_time == dt.datetime(2026, 6, 3, 6, 0)
    # the session zone is UTC; Python shows the instant in the local zone
    assert r.batch_time.astimezone(dt.timezone.utc) == dt.datetime(2026, 6, 3, 20, 30, tzinfo=dt.timezone.utc)


def test_batch_id_keeps_microseconds(spark):
    from skyfold.functions.columns import batch_id_of, to_batch_id
    stamps = [dt.datetime(2026, 6, 3, 20, 30), dt.datetime(2026, 6, 3, 20, 30, 0, 42)]
    df = spark.createDataFrame([(t,) for t in stamps], "t timestamp_ntz").select(to_batch_id("t").alias("b"))
    ids = [r.b for r in df.collect()]
    assert ids == ["20260603T203000Z", "20260603T203000.000042Z"] == [batch_id_of(t) for t in stamps]
    back = [r.t for r in df.select(ST.batch_time_of("b").cast("timestamp_ntz").alias("t")).collect()]
    assert back == stamps
    with pytest.raises(Exception, match="malformed batch id"):
        spark.createDataFrame([("2026",)], "b string").select(ST.batch_time_of("b")).collect()


def test_cast_quarantine_splits(spark):
    df = spark.createDataFrame([("1",), ("x",), (None,)], "v string")
    good, bad = ST.cast_quarantine(df, {"v": "int"})
    assert sorted([r.v for r in good.collect()], key=str) == [1, None]
    assert [r.reject_reason for r in bad.collect()] == ["malformed: v"]


def test_key_violations_and_quarantine(spark):
    rows = [("a", "1", 1), ("a", "1", 2), ("b", None, 3), ("c", "2", 4)]
    df = spark.createDataFrame(rows, "area string, level string, n int")
    viol = {(r.area, r.level, r.n_rows) for r in ST.key_violations(df, ["area", "level"]).collect()}
    assert viol == {("a", "1", 2), ("b", None, 1)}
    with pytest.raises(ST.KeyViolation):
        ST.enforce_key(df, ["area", "level"])
    good, bad = ST.split_key_violations(df, ["area", "level"])
    assert [r.n for r in good.collect()] == [4]
    assert sorted((r.n, r.reject_reason) for r in bad.collect()) == [
        (1, "duplicate key"), (2, "duplicate key"), (3, "null key")]


def staging_rows(spark, batch_id, n):
    return spark.createDataFrame(
        [(f"c{i}", "LowestTemp", dt.datetime(2026, 6, 3, i % 24), dt.datetime(2026, 6, 3, i % 24),
          20, "C", dt.datetime(2026, 6, 3, 20, 30), dt.datetime(2026, 6, 3, 21), batch_id)
         for i in range(n)],
        T.StructType(S.STAGING_FORECAST.fields + [T.StructField("batch_id", T.StringType())]))


def test_replace_batch_twice_equals_once(spark, tmp_root):
    path = f"{tmp_root}/staging_forecast"
    a, b = staging_rows(spark, "20260603T203000Z", 5), staging_rows(spark, "20260604T203000Z", 3)
    K.write_partitioned(a.unionByName(b), path)
    K.write_partitioned(a, path)
    K.replace_batch(a, path, "20260603T203000Z")
    back = K.read_table(spark, path, S.STAGING_FORECAST, partitioned=True)
    counts = {r.batch_id: r["count"] for r in back.groupBy("batch_id").count().collect()}
    assert counts == {"20260603T203000Z": 5, "20260604T203000Z": 3}


def test_empty_batch_reload_empties_it(spark, tmp_root):
    path = f"{tmp_root}/staging_forecast"
    a = staging_rows(spark, "20260603T203000Z", 5)
    K.write_partitioned(a, path)
    K.replace_batch(a.where(F.lit(False)), path, "20260603T203000Z")
    assert K.read_table(spark, path, S.STAGING_FORECAST, partitioned=True).count() == 0


def test_publish_append_duplicates_on_rerun(spark, tmp_root):
    path = f"{tmp_root}/warehouse"
    a = staging_rows(spark, "20260603T203000Z", 4)
    assert K.publish_append(a, path) == 4
    assert K.publish_append(a, path) == 4
    assert K.read_table(spark, path, S.STAGING_FORECAST, partitioned=True).count() == 8


def test_chunked_write_caps_rows_per_file(spark, tmp_root):
    import os
    path = f"{tmp_root}/chunked"
    K.write_partitioned(staging_rows(spark, "20260603T203000Z", 10), path,
                        cluster=False, max_records_per_file=3)
    files = [f for f in os.listdir(f"{path}/batch_id=20260603T203000Z") if f.endswith(".parquet")]
    assert len(files) >= 4
    assert K.read_table(spark, path, S.STAGING_FORECAST, partitioned=True).count() == 10
