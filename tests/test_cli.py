from skyfold.__main__ import main
from skyfold.constants import DATASET_FORECAST
from skyfold.plans import jobs as J
from skyfold.sources import bindings as B

from conftest import SF_SMALL


def test_cli_register_and_run_one_batch(spark, tmp_root):
    layout = J.Layout(tmp_root)
    J.land(B.forecast_documents(spark, SF_SMALL), layout, DATASET_FORECAST)
    main(["register", "--root", tmp_root, "--pipeline", "cli"])
    main(["run", "--root", tmp_root, "--pipeline", "cli",
          "--batch-time", "2024-01-05T20:00:00Z", "--as-of", "2024-01-07T00:00:00+00:00"])
    st = J.read_state(spark, layout).collect()
    assert [(r.pipeline_name, r.status) for r in st] == [("cli", "SUCCESS")]
    assert st[0].row_count > 0
    facts = spark.read.parquet(layout.mart("fact_weather_forecast"))
    assert facts.count() > 0


def test_failed_run_records_failed_and_keeps_counts(spark, tmp_root):
    import datetime as dt
    import json

    import pytest

    from skyfold.constants import DATASET_ALERT
    from skyfold.operators.staging import KeyViolation
    layout = J.Layout(tmp_root)
    J.land(B.forecast_documents(spark, SF_SMALL), layout, DATASET_FORECAST)
    J.register_pipeline(spark, layout, "wdp", dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc))
    as_of = dt.datetime(2024, 1, 7, tzinfo=dt.timezone.utc)
    b1 = dt.datetime(2024, 1, 5, 20, tzinfo=dt.timezone.utc)
    J.scheduled_run(spark, layout, "wdp", b1, as_of)
    ok = J.read_state(spark, layout).collect()[0]
    # the next batch's alerts carry the same key twice: strict staging aborts the run
    dup = {"onset": "2024-01-06 10:00:00", "expires": "2024-01-06 17:00:00", "event": "Heat",
           "parameter": [{"valueName": "alert_criteria", "value": "1"}],
           "area": [{"areaDesc": "C01north"}]}
    body = json.dumps({"records": {"info": [dup, dup]}})
    J.land(spark.createDataFrame([("20240106T200000Z", body)], "batch_id string, body string"),
           layout, DATASET_ALERT)
    with pytest.raises(KeyViolation):
        J.scheduled_run(spark, layout, "wdp", dt.datetime(2024, 1, 6, 20, tzinfo=dt.timezone.utc),
                        as_of)
    failed = J.read_state(spark, layout).collect()[0]
    assert failed.status == "FAILED"
    assert failed.row_count == ok.row_count and failed.row_count > 0
    assert failed.last_processed_at == ok.last_processed_at
