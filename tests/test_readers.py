import json
import os

from skyfold.operators.flatten import flatten_forecast
from skyfold.sources import readers as RD
from skyfold.sources import schemas as S


def _payload(city, temp):
    return {"records": {"location": [{"locationName": city, "weatherElement": [
        {"elementName": "MaxT", "time": [{"startTime": "2026-06-03 06:00:00",
                                          "endTime": "2026-06-03 18:00:00",
                                          "parameter": {"parameterName": temp,
                                                        "parameterUnit": "C"}}]},
        {"elementName": "PoP", "time": []}]}]}}


def test_pretty_printed_payload_files(spark, tmp_root):
    """Single-document, indented JSON files (as an API delivers them)."""
    for b, city, temp in (("20260603T203000Z", "AAA", "31"), ("20260604T203000Z", "BBB", "33")):
        folder = f"{tmp_root}/bronze/batch_id={b}"
        os.makedirs(folder)
        with open(f"{folder}/payload.json", "w") as fh:
            json.dump(_payload(city, temp), fh, indent=4, ensure_ascii=False)
    docs = RD.read_bronze(spark, f"{tmp_root}/bronze", S.BRONZE_FORECAST, multi_line=True)
    rows = sorted((r.batch_id, r.City, r.Type, r.Temp) for r in flatten_forecast(docs).collect())
    assert rows == [("20260603T203000Z", "AAA", "HighestTemp", "31"),
                    ("20260604T203000Z", "BBB", "HighestTemp", "33")]


def test_list_objects_with_prefix(spark, tmp_root):
    root = f"{tmp_root}/objects"
    df = spark.createDataFrame([("20260601T203000Z", "x"), ("20260605T203000Z", "y")],
                               "batch_id string, value string")
    df.write.partitionBy("batch_id").text(root)
    all_files = RD.list_objects(spark, root).where("length > 0").count()
    some = RD.list_objects(spark, root, prefix="batch_id=20260605").where("length > 0")
    assert all_files == 2 and some.count() == 1
    assert "batch_id=20260605T203000Z" in some.first().path
    # the same with a scheme, and no match at all
    assert RD.list_objects(spark, f"file://{root}", prefix="batch_id=20260605").where("length > 0").count() == 1
    assert RD.list_objects(spark, root, prefix="nothing").count() == 0


def test_pretty_printed_payload_runs_end_to_end(spark, tmp_root):
    """A delivery as one indented document: batch job, stream and command line."""
    from skyfold.__main__ import main
    from skyfold.constants import DATASET_FORECAST
    from skyfold.plans import jobs as J
    from skyfold.streaming.ingest import ingest_available
    import datetime as dt
    as_of = dt.datetime(2026, 6, 4, tzinfo=dt.timezone.utc)
    for way in ("batch", "stream", "cli"):
        layout = J.Layout(f"{tmp_root}/{way}")
        folder = f"{layout.bronze(DATASET_FORECAST)}/batch_id=20260603T203000Z"
        os.makedirs(folder)
        with open(f"{folder}/payload.json", "w") as fh:
            json.dump(_payload("AAA", "31"), fh, indent=4)
        if way == "batch":
            result = J.batch_job(spark, layout, DATASET_FORECAST, as_of, multi_line=True)
            assert (result.staged, result.rejected, result.published) == (1, 0, 1)
        elif way == "stream":
            ingest_available(spark, layout, DATASET_FORECAST, as_of, f"{tmp_root}/_c", multi_line=True)
        else:
            main(["run", "--root", layout.root, "--multi-line", "--batch-time", "2026-06-03T20:30:00Z",
                  "--as-of", as_of.isoformat()])
        assert [r.city for r in J.read_staging(spark, layout, "staging_forecast").collect()] == ["AAA"], way


def test_scan_batch_prunes_partitions(spark, tmp_root):
    from skyfold.functions.columns import to_batch_id
    from skyfold.operators import runstate as RS
    from skyfold.sinks import tables as K
    from skyfold.sources import bindings as B
    from conftest import SF_SMALL
    path = f"{tmp_root}/staging_forecast"
    K.write_partitioned(B.staging_forecast(spark, SF_SMALL).withColumn("batch_id", to_batch_id("batch_time")), path)
    table = K.read_table(spark, path, S.STAGING_FORECAST, partitioned=True)
    one = RD.scan_batch(table, "20240105T200000Z", ["city"])
    counted = RS.batch_row_counts({"staging_forecast": table}, ["20240105T200000Z"])
    for df in (one, counted):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(batch_id" in plan or "PartitionFilters: [batch_id" in plan
    assert counted.first().row_count == one.count() > 0
