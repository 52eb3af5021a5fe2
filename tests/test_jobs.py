"""Jobs lose nothing: quarantine, empty reloads, state log, retention, broken payloads."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from skyfold.constants import DATASET_ALERT, DATASET_FORECAST
from skyfold.operators import flatten as FL
from skyfold.operators import quality as Q
from skyfold.plans import jobs as J
from skyfold.sources import readers as RD
from skyfold.sources import schemas as S
from skyfold.streaming.ingest import ingest_available

AS_OF = dt.datetime(2026, 6, 4, tzinfo=dt.timezone.utc)
BATCH = "20260603T203000Z"


def alert(area, level="1"):
    parameter = [{"valueName": "alert_criteria", "value": level}] if level else []
    return {"onset": "2026-06-03 10:00:00", "expires": "2026-06-03 17:00:00", "event": "Heat",
            "parameter": parameter, "area": [{"areaDesc": area}]}


def slot(temp="20"):
    return {"startTime": "2026-06-03 06:00:00", "endTime": "2026-06-03 18:00:00",
            "parameter": {"parameterName": temp, "parameterUnit": "C"}}


def location(city, code="MinT", **element):
    return {"locationName": city, "weatherElement": [{"elementName": code, "time": [slot()], **element}]}


def land(spark, layout, dataset, entries, batch=BATCH):
    key = "info" if dataset == DATASET_ALERT else "location"
    body = json.dumps({"records": {key: entries}})
    J.land(spark.createDataFrame([(batch, body)], "batch_id string, body string"), layout, dataset)


def flattened(spark, dataset, entries):
    key, schema, fn = (("info", S.BRONZE_ALERT, FL.flatten_alert) if dataset == DATASET_ALERT
                       else ("location", S.BRONZE_FORECAST, FL.flatten_forecast))
    texts = spark.createDataFrame([(json.dumps({"records": {key: entries}}),)], "body string")
    return fn(RD.parse_documents(texts, schema)).collect()


def without(entry, name):
    return {k: v for k, v in entry.items() if k != name}


@pytest.mark.parametrize("dataset, entry, path", [
    (DATASET_ALERT, without(alert("AAAx"), "area"), "area"),
    (DATASET_ALERT, without(alert("AAAx"), "parameter"), "parameter"),
    (DATASET_FORECAST, without(location("AAA"), "weatherElement"), "weatherElement"),
    (DATASET_FORECAST, location("AAA", time=None), "time"),
    (DATASET_FORECAST, location("AAA", time=[without(slot(), "parameter")]), "parameter"),
])
def test_missing_inner_entry_fails(spark, dataset, entry, path):
    good = alert("BBBx") if dataset == DATASET_ALERT else location("BBB")
    assert len(flattened(spark, dataset, [good])) == 1
    with pytest.raises(Exception, match=f"raw document without {path}"):
        flattened(spark, dataset, [good, entry])


def test_empty_inner_arrays_and_dropped_elements_are_fine(spark):
    assert flattened(spark, DATASET_FORECAST, [location("A", time=[]), location("A", "PoP", time=None)]) == []
    assert flattened(spark, DATASET_ALERT, [{**alert("x"), "area": []}, {**alert("x"), "area": [None]}]) == []


def test_quarantine_is_written_counted_and_replaced(spark, tmp_root):
    layout = J.Layout(tmp_root)
    land(spark, layout, DATASET_ALERT, [alert("AAAx"), alert("BBBx"), alert("BBBx"), alert("CCCx", level=None)])
    result = J.batch_job(spark, layout, DATASET_ALERT, AS_OF, on_key_violation="quarantine")
    assert (result.batch_ids, result.staged, result.rejected, result.published) == ([BATCH], 1, 3, 1)
    bad = J.read_quarantine(spark, layout, "staging_alert").collect()
    assert sorted((r.area, r.reject_reason, r.batch_id) for r in bad) == [
        ("BBBx", "duplicate key", BATCH), ("BBBx", "duplicate key", BATCH), ("CCCx", "null key", BATCH)]
    # reloaded with broken rows only: staging and warehouse are emptied, then the other way round
    land(spark, layout, DATASET_ALERT, [alert("CCCx", level=None)])
    result = J.batch_job(spark, layout, DATASET_ALERT, AS_OF, on_key_violation="quarantine")
    assert (result.staged, result.rejected) == (0, 1)
    assert J.read_staging(spark, layout, "staging_alert").count() == 0
    assert J.read_warehouse(spark, layout, "staging_alert").count() == 0
    land(spark, layout, DATASET_ALERT, [alert("DDDx")])
    J.batch_job(spark, layout, DATASET_ALERT, AS_OF, on_key_violation="quarantine")
    assert J.read_quarantine(spark, layout, "staging_alert").count() == 0
    assert not os.path.exists(f"{tmp_root}/_work")


@pytest.mark.parametrize("way", ["batch", "stream"])
def test_empty_reload_empties_the_batch(spark, tmp_root, way):
    layout = J.Layout(tmp_root)
    for entries, rows in (([location("AAA")], 1), ([], 0)):
        land(spark, layout, DATASET_FORECAST, entries)
        if way == "batch":
            J.batch_job(spark, layout, DATASET_FORECAST, AS_OF)
        else:
            ingest_available(spark, layout, DATASET_FORECAST, AS_OF, f"{tmp_root}/_c")
        assert J.read_staging(spark, layout, "staging_forecast").count() == rows
        assert RD.read_silver(spark, layout.silver(DATASET_FORECAST), S.SILVER_FORECAST).count() == rows


def test_interleaved_pipelines_keep_each_others_updates(spark, tmp_root):
    layout = J.Layout(tmp_root)
    for p in ("p1", "p2"):
        J.register_pipeline(spark, layout, p, AS_OF)
    J.record_state(spark, layout, "p1", "RUNNING", AS_OF)
    J.record_state(spark, layout, "p2", "RUNNING", AS_OF)
    J.record_state(spark, layout, "p2", "SUCCESS", AS_OF, row_count=5)
    J.record_state(spark, layout, "p1", "SUCCESS", AS_OF, row_count=7)
    J.record_state(spark, layout, "ghost", "SUCCESS", AS_OF, row_count=9)
    state = {r.pipeline_name: (r.status, r.row_count) for r in J.read_state(spark, layout).collect()}
    assert state == {"p1": ("SUCCESS", 7), "p2": ("SUCCESS", 5)}


def test_microsecond_stamp_counts_its_rows(spark, tmp_root):
    layout = J.Layout(tmp_root)
    J.register_pipeline(spark, layout, "wdp", AS_OF)
    for micro, cities in ((42, ["AAA"]), (43, ["BBB", "CCC"])):  # two runs in one second
        land(spark, layout, DATASET_FORECAST, [location(c) for c in cities], f"20260603T203000.{micro:06d}Z")
        stamp = dt.datetime(2026, 6, 3, 20, 30, 0, micro, tzinfo=dt.timezone.utc)
        r = J.scheduled_run(spark, layout, "wdp", stamp, AS_OF).first()
        assert (r.status, r.row_count) == ("SUCCESS", len(cities))
    assert J.read_staging(spark, layout, "staging_forecast").count() == 3


def test_failing_cleanup_records_failed(spark, tmp_root, monkeypatch):
    layout = J.Layout(tmp_root)
    J.register_pipeline(spark, layout, "wdp", AS_OF)
    land(spark, layout, DATASET_FORECAST, [location("AAA")])

    def broken(*a, **k):
        raise OSError("no storage")

    monkeypatch.setattr(J, "expire", broken)
    with pytest.raises(OSError):
        J.scheduled_run(spark, layout, "wdp", dt.datetime(2026, 6, 3, 20, 30, tzinfo=dt.timezone.utc), AS_OF)
    r = J.read_state(spark, layout).first()
    assert (r.status, r.row_count) == ("FAILED", 1)


def test_retention_deletes_named_objects_and_reports_them(spark, tmp_root):
    layout = J.Layout(tmp_root)
    folder = layout.bronze(DATASET_FORECAST)
    land(spark, layout, DATASET_FORECAST, [], "20260501T203000Z")
    for name in ("temperature_2026-05-01T20:30:00+00:00.json", "temperature_2026-06-03T20:30:00+00:00.json"):
        with open(f"{folder}/{name}", "w") as fh:
            fh.write("{}")
    report = J.expire(spark, layout, AS_OF)
    assert sorted(p.rsplit("/", 1)[1] for p in report["dropped"]) == [
        "batch_id=20260501T203000Z", "temperature_2026-05-01T20:30:00+00:00.json"]
    assert [n for n in os.listdir(folder) if n[0] not in "._"] == ["temperature_2026-06-03T20:30:00+00:00.json"]
    assert J.expire(spark, layout, AS_OF)["dropped"] == []


def test_orphans_duplicates_and_nulls_are_counted(spark):
    fact = spark.createDataFrame([("a", "x"), ("b", None), (None, "y"), ("b", "x")], "k string, m string")
    dim = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    other = spark.createDataFrame([("y",)], "m string")
    rows = Q.orphans(fact, "f", [("k", dim, "k"), ("m", other, "m")]).collect()
    assert sorted((r.column_name, r.n_rows, r.n_failing, r.status) for r in rows) == [
        ("k", 4, 2, "fail"), ("m", 4, 2, "fail")]
    assert Q.unique(fact, "f", "k").first().n_failing == 1
    assert {r.column_name: r.n_failing for r in Q.not_null(fact, "f", ["k", "m"]).collect()} == {"k": 1, "m": 1}


def test_orphans_read_the_fact_once(spark):
    fact = spark.range(10).select(F.col("id").alias("a"), F.col("id").alias("b"))
    plan = Q.orphans(fact, "f", [("a", spark.range(3), "id"), ("b", spark.range(4), "id")]
                     )._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (0, 10") == 1


def test_write_without_aqe_keeps_a_batch_spread(spark, tmp_root):
    from skyfold.sinks import tables as K
    df = spark.range(0, 1000, 1, 4).selectExpr("id", f"'{BATCH}' AS batch_id")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        K.write_partitioned(df, f"{tmp_root}/t")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    files = [f for f in os.listdir(f"{tmp_root}/t/batch_id={BATCH}") if f.endswith(".parquet")]
    assert len(files) == 4


def test_shared_folder_must_be_named_on_a_cluster():
    from skyfold.session import shared_dir

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return Conf()

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Session())


def test_workspaces_are_released(spark):
    from skyfold import session
    before = list(session._workspaces)
    session._workspaces.clear()
    path = session.workspace(spark, "gone")
    spark.range(3).write.parquet(path)
    assert os.path.isdir(path.removeprefix("file://"))
    assert session.release_workspaces(spark) == 1 and not os.path.exists(path.removeprefix("file://"))
    session._workspaces.extend(before)
