"""Plan properties the engine relies on at scale, and a skewed input."""

import datetime as dt

import pandas as pd
from pyspark.sql import functions as F

from skyfold.operators import runstate as RS
from skyfold.plans import models as M


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def skewed_staging(spark, n=6000):
    """One city holds half of all rows (a hot key)."""
    rows = []
    for i in range(n):
        city = "HOT" if i % 2 == 0 else f"C{i % 17:02d}"
        kind = "LowestTemp" if i % 3 else "HighestTemp"
        rows.append((city, kind, dt.date(2026, 6, 1 + i % 5), 20 + i % 19))
    return spark.createDataFrame(rows, "city string, type string, weather_date date, temp int")


def test_forecast_aggregates_partially_before_the_shuffle(spark):
    fc = skewed_staging(spark)
    plan = _plan(M.forecast_daily(fc))
    # partial_avg appears below the exchange: a hot city ships one row per task
    assert "partial_avg" in plan and plan.index("partial_avg") > plan.index("Exchange")


def test_skewed_forecast_fact_equals_brute_force(spark):
    fc = skewed_staging(spark)
    al = spark.createDataFrame([], "event string, level string, area string, weather_date date")
    got = {(r.city_key, r.weather_date): (r.avg_LowestTemp, r.avg_HighestTemp, r.flag_HighestTemp)
           for r in M.fact_forecast(M.eph_forecast(fc, M.dim_city(fc, al))).collect()}
    pdf = fc.toPandas()
    import hashlib
    want = {}
    for (city, day), g in pdf.groupby(["city", "weather_date"]):
        lo = g.loc[g.type == "LowestTemp", "temp"]
        hi = g.loc[g.type == "HighestTemp", "temp"]
        lo = float(lo.mean()) if len(lo) else None
        hi = float(hi.mean()) if len(hi) else None
        flag = ("Extreme" if hi is not None and hi >= 36 else "Hot" if hi is not None and hi >= 32
                else "Warm" if hi is not None and hi >= 28 else "Normal")
        want[(hashlib.md5(city.encode()).hexdigest(), day)] = (lo, hi, flag)
    assert got == want


def test_fold_is_hash_aggregated(spark):
    state = spark.createDataFrame(
        [("p1", None, None, None, None, None, None, 0)],
        "pipeline_name string, status string, row_count long, last_processed_at timestamp, "
        "last_run_at timestamp, created_at timestamp, updated_at timestamp, created_seq long")
    log = spark.range(1, 2000).select(
        F.lit("p1").alias("pipeline_name"), F.col("id").alias("seq"),
        F.when(F.col("id") % 3 == 0, "RUNNING").otherwise("SUCCESS").alias("status"),
        F.when(F.col("id") % 3 != 0, F.col("id")).alias("row_count"),
        F.lit(None).cast("timestamp").alias("last_processed_at"),
        F.timestamp_seconds(F.col("id")).alias("ts"))
    folded = RS.fold_updates(state, log)
    plan = _plan(folded)
    assert "SortAggregate" not in plan and "HashAggregate" in plan
    r = folded.collect()[0]
    assert r.row_count == 1999 and r.status == "SUCCESS"


def test_session_keeps_aqe_skew_handling(spark):
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"


def test_write_rebalance_only_for_many_batches(spark, tmp_root):
    from skyfold.sinks import tables as K
    df = spark.range(100).select(F.lit("20260603T203000Z").alias("batch_id"), "id")
    K.replace_batches(df, f"{tmp_root}/one", ["20260603T203000Z"])
    assert spark.read.parquet(f"{tmp_root}/one").count() == 100
    pd.testing.assert_series_equal(
        spark.read.parquet(f"{tmp_root}/one").toPandas()["id"].sort_values(ignore_index=True),
        pd.Series(range(100), name="id"), check_dtype=False)


class _conf:
    """Temporarily set session confs (thresholds scaled down to test size)."""

    def __init__(self, spark, **kv):
        self.spark, self.kv, self.old = spark, kv, {}

    def __enter__(self):
        for k, v in self.kv.items():
            self.old[k] = self.spark.conf.get(k, None)
            self.spark.conf.set(k, v)

    def __exit__(self, *exc):
        for k, v in self.old.items():
            if v is None:
                self.spark.conf.unset(k)
            else:
                self.spark.conf.set(k, v)


def test_hot_key_in_a_shuffle_join_is_split(spark):
    from skyfold.operators.joins import join_dimension
    fact = spark.range(200_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 5000).alias("k"),
        F.col("id").alias("v"))                      # key 0 holds a third of the rows
    dim = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    with _conf(spark, **{
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
            "spark.sql.shuffle.partitions": "16"}):
        joined = join_dimension(fact, dim, "k")          # too big to broadcast
        assert len(joined.collect()) == 200_000      # executes this very plan
        final = joined._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in final
    assert "SortMergeJoin" in final and "skew=true" in final


def test_hot_batch_write_is_spread_over_tasks(spark, tmp_root):
    import os

    from skyfold.sinks import tables as K
    df = spark.range(300_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("20260603T203000Z"))
         .otherwise(F.concat(F.lit("2026060"), (F.col("id") % 3).cast("string"),
                             F.lit("T203000Z"))).alias("batch_id"),
        F.col("id"), F.sha2(F.col("id").cast("string"), 256).alias("pad"))
    with _conf(spark, **{"spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k",
                         "spark.sql.shuffle.partitions": "8"}):
        K.write_partitioned(df, f"{tmp_root}/t")
    hot = [f for f in os.listdir(f"{tmp_root}/t/batch_id=20260603T203000Z")
           if f.endswith(".parquet")]
    assert len(hot) > 1
    assert spark.read.parquet(f"{tmp_root}/t").count() == 300_000
