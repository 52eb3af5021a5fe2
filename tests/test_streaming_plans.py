import datetime as dt

from skyfold.constants import DATASET_FORECAST
from skyfold.plans import jobs as J
from skyfold.plans import models as M
from skyfold.sources import bindings as B
from skyfold.streaming.ingest import ingest_available

from conftest import SF_SMALL

AS_OF = dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc)


def test_stream_ingest_second_run_adds_nothing(spark, tmp_root):
    layout = J.Layout(tmp_root)
    J.land(B.forecast_documents(spark, SF_SMALL), layout, DATASET_FORECAST)
    ckpt = f"{tmp_root}/_ckpt"
    ingest_available(spark, layout, DATASET_FORECAST, AS_OF, ckpt)
    n1 = J.read_staging(spark, layout, "staging_forecast").count()
    ingest_available(spark, layout, DATASET_FORECAST, AS_OF, ckpt)
    n2 = J.read_staging(spark, layout, "staging_forecast").count()
    assert n1 == n2 == B.staging_forecast(spark, SF_SMALL).count()


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_fact_plan_pushes_filter_prunes_columns_no_python(spark, tmp_root):
    fc = M.stg_forecast(B.staging_forecast(spark, SF_SMALL))
    al = M.stg_alert(B.staging_alert(spark, SF_SMALL))
    from skyfold.operators.joins import materialize
    dim_c = materialize(M.dim_city(fc, al), f"{tmp_root}/dim_city")
    plan = _plan(M.fact_forecast(M.eph_forecast(fc, dim_c)))
    assert "PushedFilters: [In(event_type" in plan
    assert "props" not in plan.split("ReadSchema")[1].split("\n")[0]
    assert "BroadcastHashJoin" in plan
    assert "PythonUDF" not in plan and "EvalPython" not in plan


def test_staging_scan_prunes_partitions(spark, tmp_root):
    from pyspark.sql import functions as F

    from skyfold.functions.columns import to_batch_id
    from skyfold.sinks import tables as K
    from skyfold.sources import schemas as S
    path = f"{tmp_root}/staging_forecast"
    K.write_partitioned(B.staging_forecast(spark, SF_SMALL)
                        .withColumn("batch_id", to_batch_id("batch_time")), path)
    t = K.read_table(spark, path, S.STAGING_FORECAST, partitioned=True)
    plan = _plan(t.where(F.col("batch_id") == "20240105T200000Z"))
    assert "PartitionFilters: [isnotnull(batch_id" in plan


def test_full_pipeline_run_is_rerunnable(spark, tmp_root):
    layout = J.Layout(tmp_root)
    J.register_pipeline(spark, layout, "wdp", AS_OF)
    fc_docs = B.forecast_documents(spark, SF_SMALL)
    al_docs = B.alert_documents(spark, SF_SMALL)
    for _ in range(2):
        st = J.run_pipeline(spark, layout, fc_docs, al_docs, "wdp", AS_OF, AS_OF,
                            on_key_violation="quarantine")
    r = st.collect()[0]
    staged = [J.read_staging(spark, layout, t).count() for t in ("staging_forecast", "staging_alert")]
    assert r.status == "SUCCESS" and r.row_count == sum(staged) > 0
    # no alert is lost: kept and rejected rows are all of them
    rejected = J.read_quarantine(spark, layout, "staging_alert").count()
    assert rejected > 0 and staged[1] + rejected == B.staging_alert(spark, SF_SMALL).count()
    docs = {d.model: d.tags for d in spark.read.parquet(layout.mart("_docs")).collect()}
    assert docs["dim_area"].split(",")[0] == "mart" and "staging_alert" in docs
    assert spark.table("stg_weather_alert").count() == staged[1]
    facts = spark.read.parquet(layout.mart("fact_weather_forecast"))
    assert facts.count() == facts.select("city_key", "weather_date").distinct().count()
    # E5: with as_of 2024-02-01 only the forecast batch of 2024-01-30 20:00 is
    # younger than two days; every other bronze/silver batch folder is gone
    import os
    bronze = layout.bronze(DATASET_FORECAST)
    left = sorted(d for d in os.listdir(bronze) if d.startswith("batch_id="))
    assert left == ["batch_id=20240130T200000Z"]
    from skyfold.constants import DATASET_ALERT
    assert not [d for d in os.listdir(layout.silver(DATASET_ALERT)) if d.startswith("batch_id=")]


def test_mart_columns_carry_docs(spark, tmp_root):
    from skyfold.plans.catalog import MODEL_DOCS
    fc = M.stg_forecast(B.staging_forecast(spark, SF_SMALL))
    al = M.stg_alert(B.staging_alert(spark, SF_SMALL))
    layout = J.Layout(tmp_root)
    paths = J.build_marts(spark, layout, fc, al)
    back = spark.read.parquet(paths["fact_weather_forecast"])
    comments = {f.name: f.metadata.get("comment") for f in back.schema.fields}
    assert comments == MODEL_DOCS["fact_weather_forecast"]["columns"]


def test_empty_payload_loads_and_empties_its_batch(spark, tmp_root):
    import json

    from skyfold.constants import DATASET_ALERT
    layout = J.Layout(tmp_root)
    full = {"records": {"info": [{"onset": "2026-06-03 10:00:00", "expires": "2026-06-03 17:00:00",
                                  "event": "Heat", "area": [{"areaDesc": "AAAx"}],
                                  "parameter": [{"valueName": "alert_criteria", "value": "1"}]}]}}
    empty = {"records": {"info": []}}
    b = "20260603T203000Z"
    for payload, expected in ((full, 1), (empty, 0)):
        docs = spark.createDataFrame([(b, json.dumps(payload))], "batch_id string, body string")
        J.land(docs, layout, DATASET_ALERT)
        J.batch_job(spark, layout, DATASET_ALERT, AS_OF, batch_ids=[b], publish=None)
        assert J.read_staging(spark, layout, "staging_alert").count() == expected


def test_stream_rebuilds_whole_batch_when_files_arrive_later(spark, tmp_root):
    """A second file of an already ingested batch arrives: the batch is
    rebuilt from both files, not replaced by the new file alone."""
    import json
    layout = J.Layout(tmp_root)
    b = "20260603T203000Z"
    folder = f"{layout.bronze(DATASET_FORECAST)}/batch_id={b}"

    def doc(city):
        return json.dumps({"records": {"location": [{"locationName": city, "weatherElement": [
            {"elementName": "MinT", "time": [{"startTime": "2026-06-03 06:00:00",
                                              "endTime": "2026-06-03 18:00:00",
                                              "parameter": {"parameterName": "20",
                                                            "parameterUnit": "C"}}]}]}]}})
    spark.createDataFrame([(doc("AAA"),)], "value string").write.mode("append").text(folder)
    ckpt = f"{tmp_root}/_ckpt"
    ingest_available(spark, layout, DATASET_FORECAST, AS_OF, ckpt)
    spark.createDataFrame([(doc("BBB"),)], "value string").write.mode("append").text(folder)
    ingest_available(spark, layout, DATASET_FORECAST, AS_OF, ckpt)
    cities = sorted(r.city for r in J.read_staging(spark, layout, "staging_forecast").collect())
    assert cities == ["AAA", "BBB"]


def test_incremental_mart_build_adds_nothing_on_rerun(spark, tmp_root):
    fc = M.stg_forecast(B.staging_forecast(spark, SF_SMALL))
    al = M.stg_alert(B.staging_alert(spark, SF_SMALL))
    layout = J.Layout(tmp_root)
    paths = J.build_marts(spark, layout, fc, al, incremental=True)
    n_city = spark.read.parquet(paths["dim_city"]).count()
    n_area = spark.read.parquet(paths["dim_area"]).count()
    J.build_marts(spark, layout, fc, al, incremental=True)
    assert spark.read.parquet(paths["dim_city"]).count() == n_city
    assert spark.read.parquet(paths["dim_area"]).count() == n_area


def test_failing_data_test_fails_the_mart_build(spark, tmp_root):
    import pytest
    from pyspark.sql import functions as F

    from skyfold.operators.quality import DataTestFailure
    fc = M.stg_forecast(B.staging_forecast(spark, SF_SMALL)).withColumn(
        "city", F.when(F.col("temp") >= 39, F.lit(None)).otherwise(F.col("city")))
    al = M.stg_alert(B.staging_alert(spark, SF_SMALL))
    with pytest.raises(DataTestFailure, match="stg_weather_forecast.city not_null"):
        J.build_marts(spark, J.Layout(tmp_root), fc, al)


def test_stream_with_one_file_per_trigger_equals_batch_load(spark, tmp_root):
    layout = J.Layout(tmp_root)
    J.land(B.forecast_documents(spark, SF_SMALL), layout, DATASET_FORECAST)
    ingest_available(spark, layout, DATASET_FORECAST, AS_OF, f"{tmp_root}/_ckpt",
                     max_files_per_trigger=1)
    got = J.read_staging(spark, layout, "staging_forecast").drop("update_time", "batch_id")
    want = B.staging_forecast(spark, SF_SMALL)
    assert got.count() == want.count()
    assert got.exceptAll(want.select(*got.columns)).count() == 0


def test_scheduled_runs_keep_state_across_runs(spark, tmp_root):
    import datetime as _dt

    from pyspark.sql import functions as F
    layout = J.Layout(tmp_root)
    docs = B.forecast_documents(spark, SF_SMALL)
    J.land(docs, layout, DATASET_FORECAST)
    J.register_pipeline(spark, layout, "wdp", AS_OF)
    J.register_pipeline(spark, layout, "wdp", AS_OF)  # idempotent
    b1 = _dt.datetime(2024, 1, 5, 20, tzinfo=_dt.timezone.utc)
    b2 = _dt.datetime(2024, 1, 6, 20, tzinfo=_dt.timezone.utc)
    run_as_of = _dt.datetime(2024, 1, 7, tzinfo=_dt.timezone.utc)
    J.scheduled_run(spark, layout, "wdp", b1, run_as_of)
    J.scheduled_run(spark, layout, "wdp", b2, run_as_of)
    st = J.read_state(spark, layout).collect()
    assert len(st) == 1 and st[0].status == "SUCCESS"
    want = B.staging_forecast(spark, SF_SMALL).where(
        F.col("batch_time") == F.lit(b2)).count()
    assert st[0].row_count == want
    assert st[0].last_processed_at.replace(tzinfo=None) == b2.replace(tzinfo=None)
    staged = J.read_staging(spark, layout, "staging_forecast")
    assert sorted(r.batch_id for r in staged.select("batch_id").distinct().collect()) == [
        "20240105T200000Z", "20240106T200000Z"]
