from pyspark.sql import functions as F

from skyfold.operators.joins import join_dimension, not_in
from skyfold.plans import models as M


def _not_in_sql(spark, cand, target):
    cand.createOrReplaceTempView("cand_v")
    target.createOrReplaceTempView("target_v")
    return sorted((r.k for r in spark.sql(
        "SELECT k FROM cand_v WHERE k NOT IN (SELECT t FROM target_v)").collect()), key=str)


def test_not_in_matches_sql_semantics(spark):
    cand = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    targets = {
        "empty": spark.createDataFrame([], "t string"),
        "clean": spark.createDataFrame([("a",)], "t string"),
        "mixed": spark.createDataFrame([("a",), (None,)], "t string"),
        "all_null": spark.createDataFrame([(None,)], "t string"),
    }
    for name, target in targets.items():
        ours = sorted((r.k for r in not_in(cand, "k", target, "t").collect()), key=str)
        assert ours == _not_in_sql(spark, cand, target), name


def test_join_dimension_broadcasts_by_bytes_not_by_rows(spark, tmp_root):
    """A few rows of great width must not be broadcast; narrow ones may."""
    from skyfold.operators.joins import materialize
    fact = materialize(spark.range(100_000).withColumn("k", F.col("id") % 3), f"{tmp_root}/fact")
    narrow = materialize(spark.range(3).withColumnRenamed("id", "k"), f"{tmp_root}/narrow")
    wide = materialize(spark.range(400).select(F.col("id").alias("k"), F.array_join(F.transform(
        F.sequence(F.lit(1), F.lit(4000)), lambda i: F.sha2(F.concat(F.col("id").cast("string"), i.cast("string")), 256)),
        "").alias("text")), f"{tmp_root}/wide")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20k")  # below the fact's size
    try:
        plan = join_dimension(fact, narrow, "k")._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan
        plan = join_dimension(fact, wide, "k")._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def stg(spark):
    fc = spark.createDataFrame([
        ("AAA", "LowestTemp", "2026-06-03", 20), ("AAA", "HighestTemp", "2026-06-03", 36),
        ("AAA", "HighestTemp", "2026-06-03", 35), ("BBB", "LowestTemp", "2026-06-03", 18),
        (None, "LowestTemp", "2026-06-03", 10)],
        "city string, type string, weather_date string, temp int"
    ).withColumn("weather_date", F.to_date("weather_date"))
    al = spark.createDataFrame([
        ("Heat", "orange", "CCCnorth", "2026-06-03"), ("Heat", "red", "AAA", "2026-06-03"),
        ("Heat", None, None, "2026-06-03")],
        "event string, level string, area string, weather_date string"
    ).withColumn("weather_date", F.to_date("weather_date"))
    return fc, al


def test_fact_forecast_null_average_is_normal(spark):
    fc, al = stg(spark)
    dim_c = M.dim_city(fc, al)
    rows = {r.city_key: r for r in M.fact_forecast(M.eph_forecast(fc, dim_c)).collect()}
    import hashlib
    a = rows[hashlib.md5(b"AAA").hexdigest()]
    b = rows[hashlib.md5(b"BBB").hexdigest()]
    assert a.avg_HighestTemp == 35.5 and a.flag_HighestTemp == "Hot" and a.avg_LowestTemp == 20
    assert b.avg_HighestTemp is None and b.flag_HighestTemp == "Normal"
    assert len(rows) == 2  # the NULL city does not join


def test_dim_city_union_keeps_null_once(spark):
    fc, al = stg(spark)
    cities = sorted((r.city for r in M.city_list(fc, al).collect()), key=str)
    assert cities == ["AAA", "BBB", "CCC", None]


def test_fact_alert_three_char_area_and_dims(spark):
    fc, al = stg(spark)
    keys = M.city_area_keys(M.dim_city(fc, al), M.dim_area(al))
    rows = M.fact_alert(M.eph_alert(al), keys).collect()
    assert sorted(r.level for r in rows) == ["orange", "red"]


def test_incremental_dimension_adds_nothing_on_rerun(spark, tmp_root):
    from skyfold.sinks import tables as K
    fc, al = stg(spark)
    path = f"{tmp_root}/dim_area"
    K.overwrite_table(M.dim_area(al).where(F.col("city") == "AAA"), path)
    for _ in range(2):
        K.append_rows(M.dim_area_new(al, spark.read.parquet(path)), path)
    # the NULL area_key row only enters an empty target; the target was not empty
    assert sorted((r.city, r.area) for r in spark.read.parquet(path).collect()) == [
        ("AAA", ""), ("CCC", "north")]


def test_fact_alert_drops_area_without_dimension_row(spark):
    fc, al = stg(spark)
    dim_a = M.dim_area(al).where(F.col("city") != "CCC")  # dimension lacks CCC/north
    keys = M.city_area_keys(M.dim_city(fc, al), dim_a)
    rows = M.fact_alert(M.eph_alert(al), keys).collect()
    assert [r.level for r in rows] == ["red"]
