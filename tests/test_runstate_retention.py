import datetime as dt

from pyspark.sql import functions as F

from skyfold.operators import retention as R
from skyfold.operators import runstate as RS
from skyfold.sources.readers import list_objects

T = lambda h: dt.datetime(2026, 6, 3, h, tzinfo=dt.timezone.utc)
STATE = ("pipeline_name string, status string, row_count long, last_processed_at timestamp, "
         "last_run_at timestamp, created_at timestamp, updated_at timestamp, created_seq long")
UPD = ("pipeline_name string, seq long, status string, row_count long, "
       "last_processed_at timestamp, ts timestamp")


def state(spark):
    return spark.createDataFrame([("wdp", None, None, None, None, T(0), T(0), 0)], STATE)


def apply_seq(spark, st, log_rows):
    for r in sorted(log_rows, key=lambda r: r[1]):
        u = spark.createDataFrame([r], UPD).drop("seq")
        st = RS.apply_update(st.drop("created_seq"), u).withColumn("created_seq", F.lit(0))
        st = spark.createDataFrame(st.collect(), STATE)
    return st


LOG = [("wdp", 1, "RUNNING", None, None, T(1)),
       ("wdp", 2, "SUCCESS", 218, T(1), T(2)),
       ("wdp", 3, "RUNNING", None, None, T(3)),
       ("wdp", 4, "FAILED", None, None, T(4)),
       ("ghost", 5, "SUCCESS", 7, T(5), T(5))]


def test_update_semantics(spark):
    st = apply_seq(spark, state(spark), LOG)
    r = st.collect()[0]
    assert r.status == "FAILED" and r.row_count == 218  # kept through FAILED
    assert r.last_run_at == T(3).replace(tzinfo=None) or r.last_run_at.hour == 3
    assert r.updated_at.hour == 4
    assert st.count() == 1  # unknown pipeline ignored


def test_fold_equals_sequential_updates(spark):
    log = spark.createDataFrame(LOG, UPD)
    folded = RS.fold_updates(state(spark), log).collect()[0]
    seq = apply_seq(spark, state(spark), LOG).collect()[0]
    for c in RS.STATE_COLUMNS:
        assert folded[c] == seq[c], c


def test_lookup_missing_is_empty(spark):
    names = spark.createDataFrame([("nope",)], "pipeline_name string")
    assert RS.lookup(state(spark), names).count() == 0


def test_row_count_allow_list(spark):
    import pytest
    with pytest.raises(ValueError):
        RS.check_table_name("etl_pipeline_state")


def test_retention_strict_cutoff_and_foreign_names(spark):
    as_of = dt.datetime(2026, 6, 5, 20, 30, tzinfo=dt.timezone.utc)
    names = ["weather/temperature_2026-06-03T20:30:00+00:00.json",      # exactly 2 days: kept
             "weather/temperature_2026-06-03T20:29:59.999999+00:00.json",  # older: expired
             "weather/notes.txt"]                                       # foreign: kept
    df = spark.createDataFrame([(n,) for n in names], "path string")
    assert [r.path for r in R.expired(df, as_of).collect()] == [names[1]]
    assert sorted(r.path for r in R.kept(df, as_of).collect()) == sorted([names[0], names[2]])


def test_delete_units_are_folders_and_named_objects(spark, tmp_root):
    import os
    path = f"{tmp_root}/bronze"
    df = spark.createDataFrame([("20260601T203000Z", "x"), ("20260601T203000.000001Z", "w"),
                                ("20260605T203000Z", "y")], "batch_id string, body string")
    df.write.partitionBy("batch_id").text(path)
    for name in ("temperature_2026-05-01T20:30:00+00:00.json", "temperature_2026-06-05T20:30:00+00:00.json"):
        with open(f"{path}/{name}", "w") as fh:
            fh.write("{}")
    units = R.delete_units(list_objects(spark, path), dt.datetime(2026, 6, 5, 21, tzinfo=dt.timezone.utc))
    old = sorted(r.unit for r in units.collect() if r.expired)
    assert [u.rsplit("/", 1)[1] for u in old] == [
        "batch_id=20260601T203000.000001Z", "batch_id=20260601T203000Z", "temperature_2026-05-01T20:30:00+00:00.json"]
    gone = list(R.delete_paths(spark, [*old, f"{path}/not-there"]))
    assert sorted(gone) == old  # only what really went is reported
    assert sorted(n for n in os.listdir(path) if n[0] not in "._") == [
        "batch_id=20260605T203000Z", "temperature_2026-06-05T20:30:00+00:00.json"]


def test_expire_reports_and_keeps_foreign_objects(spark, tmp_root):
    import os

    from skyfold.constants import DATASET_FORECAST
    from skyfold.plans import jobs as J
    layout = J.Layout(tmp_root)
    docs = spark.createDataFrame([("20260601T203000Z", "{}"), ("20260605T203000Z", "{}")],
                                 "batch_id string, body string")
    J.land(docs, layout, DATASET_FORECAST)
    with open(f"{layout.bronze(DATASET_FORECAST)}/notes.txt", "w") as fh:
        fh.write("not a batch")
    report = J.expire(spark, layout, dt.datetime(2026, 6, 5, 21, tzinfo=dt.timezone.utc))
    assert [p.rsplit("/", 1)[1] for p in report["dropped"]] == ["batch_id=20260601T203000Z"]
    assert report["unparsed"] == 1 and report["unparsed_sample"][0].endswith("notes.txt")
    assert os.path.exists(f"{layout.bronze(DATASET_FORECAST)}/notes.txt")
