"""Commit records: several tables change at once or not at all, under failures and rivals."""

import datetime as dt
import os
import random
import threading
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyfold.constants import DATASET_ALERT, DATASET_FORECAST
from skyfold.operators import runstate as RS
from skyfold.plans import jobs as J
from skyfold.plans import models as M
from skyfold.sinks import snapshots as SN
from skyfold.sinks.commitlog import SequenceLog
from skyfold.sinks.snapshots import Change, Conflict, Snapshots, vacuum
from test_jobs import AS_OF, BATCH, alert, land, location

OTHER = "20260604T203000Z"
ROWS = T.StructType([T.StructField("v", T.LongType())])


def local(path):
    return path.removeprefix("file://").removeprefix("file:")


# ---------------------------------------------------------------- the log

def counting(spark, root, every=4):
    return SequenceLog(spark, f"{root}/log", lambda state, n, r: [*state, (n, r)], list, every)


def test_log_orders_rivals_and_keeps_a_bounded_tail(spark, tmp_root):
    def write(k):
        log = counting(spark, tmp_root)
        for i in range(15):
            log.append(lambda state: f"{k}-{i}")

    threads = [threading.Thread(target=write, args=(k,)) for k in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    last, state = counting(spark, tmp_root).read()
    assert last == 60 and [n for n, _ in state] == list(range(1, 61))
    assert sorted(r for _, r in state) == sorted(f"{k}-{i}" for k in range(4) for i in range(15))
    for k in range(4):  # each writer's own order is kept
        assert [r for _, r in state if r.startswith(f"{k}-")] == [f"{k}-{i}" for i in range(15)]
    names = [n for n in os.listdir(local(f"{tmp_root}/log")) if not n.startswith(".")]
    assert len(names) <= 2 + 2 * 4 and len([n for n in names if n.endswith(".checkpoint")]) <= 2


def test_log_record_is_whole_or_absent(spark, tmp_root, monkeypatch):
    log = counting(spark, tmp_root)
    log.append(lambda state: "a")
    monkeypatch.setattr(os, "link", lambda *a: (_ for _ in ()).throw(OSError("disk")))
    with pytest.raises(OSError):
        log.append(lambda state: "b")
    monkeypatch.undo()
    assert counting(spark, tmp_root).read() == (1, [(1, "a")])
    assert log.append(lambda state: "c") == 2


def test_log_on_a_store_with_renames(spark, tmp_root, monkeypatch):
    """The way taken where there are no hard links: a rename that doesn't overwrite."""
    log = counting(spark, tmp_root)
    log.append(lambda state: "a")
    fs, p = SN.file_system(spark, f"{tmp_root}/log/source")
    fs.create(p).close()
    _, target = SN.file_system(spark, f"{tmp_root}/log/{1:020d}.json")
    assert log._renamed(p, target) is False and log.read() == (1, [(1, "a")])
    _, target = SN.file_system(spark, f"{tmp_root}/log/.free")
    assert log._renamed(p, target) is True


def test_state_log_equals_the_fold_of_all_updates(spark, tmp_root):
    """200 updates through a log with checkpoints against the Spark fold over all of them."""
    rng = random.Random(5)
    layout = J.Layout(tmp_root)
    names = ["p1", "p2", "p3", "ghost"]
    created, log = [], []
    for seq in range(1, 201):
        ts = AS_OF + dt.timedelta(seconds=rng.randint(-1000, 1000))  # clocks that disagree
        if seq in (1, 40, 120):
            name = names[len(created)]
            J.register_pipeline(spark, layout, name, ts)
            created.append((name, ts, seq))
            continue
        name, status = rng.choice(names), rng.choice(["RUNNING", "SUCCESS", "FAILED"])
        rows = rng.choice([None, rng.randint(0, 99)])
        done = rng.choice([None, ts])
        J.record_state(spark, layout, name, status, ts, rows, done)
        log.append((name, seq, status, rows, done, ts))
    frame = spark.createDataFrame(
        [(n, None, None, None, None, ts, ts, seq) for n, ts, seq in created], J.STATE_DDL + ", created_seq long")
    updates = spark.createDataFrame(log, "pipeline_name string, seq long, status string, row_count long, "
                                         "last_processed_at timestamp, ts timestamp")
    expected = RS.fold_updates(frame, updates).select(*RS.STATE_COLUMNS)
    got = J.read_state(spark, layout).select(*RS.STATE_COLUMNS)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))
    assert len(os.listdir(local(f"{tmp_root}/state"))) < 80  # two files of each record, a bounded number


# ---------------------------------------------------------------- K3, K5: one commit over several tables

def staged_everywhere(spark, layout, table="staging_alert"):
    return tuple(sorted(r.area for r in df.collect()) for df in (
        J.read_staging(spark, layout, table), J.read_quarantine(spark, layout, table),
        J.read_warehouse(spark, layout, table)))


@pytest.mark.parametrize("broken", ["load", "measure", "copy", "commit"])
def test_failure_between_the_writes_leaves_the_former_batch(spark, tmp_root, monkeypatch, broken):
    layout = J.Layout(tmp_root)
    land(spark, layout, DATASET_ALERT, [alert("AAAx"), alert("BBBx"), alert("BBBx")])
    J.batch_job(spark, layout, DATASET_ALERT, AS_OF, on_key_violation="quarantine")
    before = staged_everywhere(spark, layout)
    assert before == (["AAAx"], ["BBBx", "BBBx"], ["AAAx"])
    land(spark, layout, DATASET_ALERT, [alert("CCCx"), alert("DDDx", level=None)])

    def fail(*a, **k):
        raise OSError("executor lost for good")

    calls = []

    def copy_fails(self, df, folder, *a, **k):
        calls.append(folder)
        return fail() if len(calls) == 2 else real(self, df, folder, *a, **k)

    real = Snapshots.write
    if broken == "copy":
        monkeypatch.setattr(Snapshots, "write", copy_fails)
    else:
        monkeypatch.setattr(Snapshots, {"load": "write", "measure": "measured", "commit": "commit"}[broken], fail)
    with pytest.raises(OSError):
        J.batch_job(spark, layout, DATASET_ALERT, AS_OF, on_key_violation="quarantine")
    monkeypatch.undo()
    assert staged_everywhere(spark, layout) == before
    J.batch_job(spark, layout, DATASET_ALERT, AS_OF, on_key_violation="quarantine")
    assert staged_everywhere(spark, layout) == (["CCCx"], ["DDDx"], ["CCCx"])


def test_key_violation_fails_the_job_and_commits_nothing(spark, tmp_root):
    layout = J.Layout(tmp_root)
    land(spark, layout, DATASET_ALERT, [alert("AAAx")])
    J.batch_job(spark, layout, DATASET_ALERT, AS_OF)
    land(spark, layout, DATASET_ALERT, [alert("BBBx"), alert("BBBx")])
    with pytest.raises(J.ST.KeyViolation, match="BBBx"):
        J.batch_job(spark, layout, DATASET_ALERT, AS_OF)
    assert staged_everywhere(spark, layout) == (["AAAx"], [], ["AAAx"])


def test_reload_of_one_batch_keeps_the_others_of_its_folder(spark, tmp_root):
    layout = J.Layout(tmp_root)
    body = '{"records": {"info": []}}'
    land(spark, layout, DATASET_ALERT, [alert("AAAx")])
    land(spark, layout, DATASET_ALERT, [alert("BBBx"), alert("CCCx")], OTHER)
    J.batch_job(spark, layout, DATASET_ALERT, AS_OF)  # both batches in one folder
    land(spark, layout, DATASET_ALERT, [alert("DDDx")])
    J.batch_job(spark, layout, DATASET_ALERT, AS_OF, [BATCH])
    assert staged_everywhere(spark, layout)[0] == ["BBBx", "CCCx", "DDDx"]
    J.land(spark.createDataFrame([(OTHER, body)], "batch_id string, body string"), layout, DATASET_ALERT)
    J.batch_job(spark, layout, DATASET_ALERT, AS_OF, [OTHER])
    assert staged_everywhere(spark, layout) == (["DDDx"], [], ["DDDx"])
    tables = Snapshots(spark, layout.root)
    stats = {r.batch_id: r.row_count for r in tables.batch_stats("staging/staging_alert").collect()}
    assert stats == {BATCH: 1, OTHER: 0}


def test_append_publish_doubles_on_rerun(spark, tmp_root):
    layout = J.Layout(tmp_root)
    land(spark, layout, DATASET_ALERT, [alert("AAAx")])
    for n in (1, 2):
        result = J.batch_job(spark, layout, DATASET_ALERT, AS_OF, publish="append")
        assert result.published == 1
        assert staged_everywhere(spark, layout) == (["AAAx"], [], ["AAAx"] * n)


def job_count(spark, run):
    tracker = spark.sparkContext.statusTracker()
    group = f"jobs-{time.time_ns()}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        run()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(tracker.getJobIdsForGroup(group))


def test_jobs_of_a_run_do_not_grow_with_its_batches(spark, tmp_root):
    """Half of the batches have no rows, and all rows keep their key: nothing to quarantine."""
    counts = []
    for n in (4, 24):
        layout = J.Layout(f"{tmp_root}/{n}")
        ids = [f"202606{d:02d}T203000Z" for d in range(1, n + 1)]
        for k, b in enumerate(ids):
            land(spark, layout, DATASET_ALERT, [alert("AAAx")] if k % 2 else [], b)
        J.batch_job(spark, layout, DATASET_ALERT, AS_OF, ids, "quarantine")  # warm
        counts.append(job_count(spark, lambda: J.batch_job(
            spark, layout, DATASET_ALERT, AS_OF, ids, "quarantine")))
        assert J.read_staging(spark, layout, "staging_alert").count() == n // 2
    assert counts[0] == counts[1]


# ---------------------------------------------------------------- A2, S3: statistics

def test_statistics_equal_a_scan_and_open_no_file(spark, tmp_root):
    layout = J.Layout(tmp_root)
    for b, cities in ((BATCH, ["AAA", "BBB"]), (OTHER, ["CCC"])):
        land(spark, layout, DATASET_FORECAST, [location(c) for c in cities], b)
    J.batch_job(spark, layout, DATASET_FORECAST, AS_OF)
    land(spark, layout, DATASET_FORECAST, [location(c) for c in ("DDD", "EEE", "FFF")], OTHER)
    J.batch_job(spark, layout, DATASET_FORECAST, AS_OF, [OTHER])
    rows = J.read_staging(spark, layout, "staging_forecast")
    scan = rows.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("row_count"), F.min("start_time").cast("string").alias("low"),
        F.max("start_time").cast("string").alias("high"))
    tables = Snapshots(spark, layout.root)
    stats = tables.batch_stats("staging/staging_forecast")
    assert sorted(map(tuple, stats.drop("n_files").collect())) == sorted(map(tuple, scan.collect()))
    files = [f for r in tables.state["tables"]["staging/staging_forecast"]["batches"].values()
             for p in r for f in p["files"]]
    assert sorted(files) == sorted(r.f for r in rows.select(F.col("_metadata.file_name").alias("f")).distinct().collect())
    assert job_count(spark, lambda: J.success_row_count(spark, layout, [BATCH, OTHER])) == 0
    assert J.success_row_count(spark, layout, [BATCH, OTHER]) == 5
    assert J.success_row_count(spark, layout, [OTHER, "20990101T000000Z"]) == 3


# ---------------------------------------------------------------- K8: swap of whole tables

def test_reader_during_a_rebuild_sees_the_old_rows(spark, tmp_root):
    tables = Snapshots(spark, tmp_root)
    tables.replace_whole(spark.range(3).select(F.col("id").alias("v")), "marts/m")
    old = spark.read.schema(ROWS).parquet(*tables.paths("marts/m"))
    rival = Snapshots(spark, tmp_root)
    folder = rival.new_folder("marts/m")
    rival.write(spark.range(10, 15).select(F.col("id").alias("v")), folder)
    assert spark.read.parquet(*Snapshots(spark, tmp_root).paths("marts/m")).count() == 3  # not committed yet
    rival.commit([Change("marts/m", "whole", folder)])
    assert sorted(r.v for r in old.collect()) == [0, 1, 2]  # resolved before: undisturbed
    assert spark.read.parquet(*Snapshots(spark, tmp_root).paths("marts/m")).count() == 5


@pytest.mark.parametrize("step", ["fact_forecast", "fact_alert", "not_null"])
def test_failed_mart_build_leaves_all_marts(spark, tmp_root, monkeypatch, step):
    layout = J.Layout(tmp_root)
    land(spark, layout, DATASET_FORECAST, [location("AAA")])
    land(spark, layout, DATASET_ALERT, [alert("AAAx")])
    for d in J.FLOWS:
        J.batch_job(spark, layout, d, AS_OF)
    J.build_marts(spark, layout)

    def rows():
        return {m: sorted(map(tuple, spark.read.parquet(layout.mart(m)).collect()), key=repr)
                for m in ("dim_city", "dim_area", "fact_weather_forecast", "fact_weather_alert")}

    before = rows()
    land(spark, layout, DATASET_FORECAST, [location("BBB")], OTHER)
    J.batch_job(spark, layout, DATASET_FORECAST, AS_OF, [OTHER])

    def fail(*a, **k):
        raise OSError("lost")

    monkeypatch.setattr(J.Q if step == "not_null" else M, step, fail)
    with pytest.raises(OSError):
        J.build_marts(spark, layout)
    monkeypatch.undo()
    assert rows() == before
    J.build_marts(spark, layout)
    assert len(rows()["dim_city"]) == len(before["dim_city"]) + 1


# ---------------------------------------------------------------- K9: rivals

def test_two_incremental_builds_add_no_key_twice(spark, tmp_root):
    Snapshots(spark, tmp_root).replace_whole(spark.range(3).select(F.col("id").alias("v")), "marts/d")
    both = threading.Barrier(2, timeout=60)
    first, retries = [True, True], [0, 0]

    def builder(k):
        def make(target):
            new = spark.range(6).select(F.col("id").alias("v")).join(target, "v", "left_anti")
            if first[k]:
                first[k] = False
                both.wait()  # both have read the same state
            return new

        retries[k] = Snapshots(spark, tmp_root).add_rows("marts/d", make, ROWS)

    threads = [threading.Thread(target=builder, args=(k,)) for k in range(2)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    rows = spark.read.parquet(*Snapshots(spark, tmp_root).paths("marts/d")).collect()
    assert sorted(r.v for r in rows) == [0, 1, 2, 3, 4, 5]
    assert sorted(retries) == [0, 1]


def test_commit_after_a_rival_is_refused_for_its_table_only(spark, tmp_root):
    a, b = Snapshots(spark, tmp_root), Snapshots(spark, tmp_root)
    a.commit([Change("marts/x", "whole", "marts/x/version=v1")])
    b.commit([Change("marts/y", "whole", "marts/y/version=v1")], {"marts/y": b.number})  # x doesn't matter
    with pytest.raises(Conflict):
        Snapshots(spark, tmp_root).commit([Change("marts/x", "add", "marts/x/version=v2")], {"marts/x": 0})


def test_incremental_marts_end_to_end(spark, tmp_root):
    layout = J.Layout(tmp_root)
    for cities, batch in ((["AAA"], BATCH), (["AAA", "BBB"], OTHER)):
        land(spark, layout, DATASET_FORECAST, [location(c) for c in cities], batch)
        land(spark, layout, DATASET_ALERT, [alert(f"{c}x") for c in cities], batch)
        for d in J.FLOWS:
            J.batch_job(spark, layout, d, AS_OF, [batch])
        J.build_marts(spark, layout, incremental=True)
    assert sorted(r.city for r in spark.read.parquet(layout.mart("dim_city")).collect()) == ["AAA", "BBB"]
    assert spark.read.parquet(layout.mart("dim_area")).count() == 2
    assert spark.read.parquet(layout.mart("fact_weather_alert")).count() == 3


# ---------------------------------------------------------------- cleanup

def test_vacuum_deletes_what_no_commit_names(spark, tmp_root):
    tables = Snapshots(spark, tmp_root)
    for n in (3, 4):
        tables.replace_whole(spark.range(n).select(F.col("id").alias("v")), "marts/m")
    lost = tables.new_folder("marts/m")
    tables.write(spark.range(1).select(F.col("id").alias("v")), lost)  # written, never committed
    assert len(os.listdir(local(f"{tmp_root}/marts/m"))) == 3
    assert vacuum(tables, time.time() - 3600) == []  # within the grace time
    assert len(vacuum(tables, time.time() + 60)) == 2
    assert len(os.listdir(local(f"{tmp_root}/marts/m"))) == 1
    assert spark.read.parquet(*tables.paths("marts/m")).count() == 4
    assert tables.state["gone"] == {}


def test_vacuum_keeps_folders_that_still_hold_a_batch(spark, tmp_root):
    layout = J.Layout(tmp_root)
    land(spark, layout, DATASET_ALERT, [alert("AAAx")])
    land(spark, layout, DATASET_ALERT, [alert("BBBx")], OTHER)
    J.batch_job(spark, layout, DATASET_ALERT, AS_OF)
    land(spark, layout, DATASET_ALERT, [alert("CCCx"), alert("DDDx", level=None)])
    J.batch_job(spark, layout, DATASET_ALERT, AS_OF, [BATCH], "quarantine")
    vacuum(Snapshots(spark, layout.root), time.time() + 60)
    assert staged_everywhere(spark, layout) == (["BBBx", "CCCx"], ["DDDx"], ["BBBx", "CCCx"])
    for b in (BATCH, OTHER):
        land(spark, layout, DATASET_ALERT, [alert("EEEx")], b)
    J.batch_job(spark, layout, DATASET_ALERT, AS_OF, None, "quarantine")
    assert len(vacuum(Snapshots(spark, layout.root), time.time() + 60)) == 6  # two loads, copies, kept parts
    assert staged_everywhere(spark, layout) == (["EEEx", "EEEx"], [], ["EEEx", "EEEx"])


# ---------------------------------------------------------------- R1: files exactly once

def land_files(spark, layout, bodies, batch=BATCH):
    """One file per body, landed together."""
    import json
    rows = [(batch, json.dumps({"records": {"location": b}})) for b in bodies]
    df = spark.createDataFrame(rows, "batch_id string, body string").repartition(len(rows))
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # a file per task
    try:
        J.land(df, layout, DATASET_FORECAST)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.fixture
def flattened_files(monkeypatch):
    """Files handed to the flatten step, in order."""
    from skyfold.streaming import ingest
    seen, real = [], ingest.RD.read_bronze

    def spy(spark, path, *a, **k):
        seen.extend(path)
        return real(spark, path, *a, **k)

    monkeypatch.setattr(ingest.RD, "read_bronze", spy)
    return seen


def cities(spark, layout):
    return sorted(r.city for r in J.read_staging(spark, layout, "staging_forecast").collect())


def test_batch_of_three_triggers_is_flattened_once_per_file(spark, tmp_root, flattened_files):
    from skyfold.streaming.ingest import ingest_available, landed_files, ledger
    layout = J.Layout(tmp_root)
    while len(landed_files(spark, layout, DATASET_FORECAST, BATCH)) != 3:
        land_files(spark, layout, [[location("AAA")], [location("BBB")], [location("CCC")]])
    commits = []
    real = Snapshots.commit
    with pytest.MonkeyPatch.context() as m:
        m.setattr(Snapshots, "commit", lambda self, *a, **k: commits.append(a) or real(self, *a, **k))
        ingest_available(spark, layout, DATASET_FORECAST, AS_OF, f"{tmp_root}/_c", max_files_per_trigger=1)
    assert len(flattened_files) == len(set(flattened_files)) == 3
    assert len(commits) == 1 and cities(spark, layout) == ["AAA", "BBB", "CCC"]
    assert ledger(spark, layout, DATASET_FORECAST).read()[1]["pending"] == {}
    assert os.listdir(local(f"{tmp_root}/intake/_rows")) == []


def test_repeated_micro_batches_add_nothing(spark, tmp_root, flattened_files):
    from skyfold.streaming.ingest import landed_files, ledger, load_arrivals
    layout = J.Layout(tmp_root)
    while len(landed_files(spark, layout, DATASET_FORECAST, BATCH)) != 2:
        land_files(spark, layout, [[location("AAA")], [location("BBB")]])
    folder = f"{layout.bronze(DATASET_FORECAST)}/batch_id={BATCH}"
    first, last = sorted(f"{folder}/{n}" for n in landed_files(spark, layout, DATASET_FORECAST, BATCH))

    def take(*paths):
        return load_arrivals(spark, layout, DATASET_FORECAST, {BATCH: list(paths)}, AS_OF)

    assert take(first) == [] and take(first) == []  # run again before the checkpoint
    assert len(flattened_files) == 1 and cities(spark, layout) == []
    assert take(last) == [BATCH] and cities(spark, layout) == ["AAA", "BBB"]
    number = Snapshots(spark, tmp_root).number
    assert take(last) == [] and take(first, last) == []  # run again after the load
    assert Snapshots(spark, tmp_root).number == number and len(flattened_files) == 2
    assert ledger(spark, layout, DATASET_FORECAST).read()[1]["pending"] == {}


def test_file_that_comes_to_a_loaded_batch_is_flattened_alone(spark, tmp_root, flattened_files):
    from skyfold.streaming.ingest import ingest_available
    layout = J.Layout(tmp_root)
    folder = f"{layout.bronze(DATASET_FORECAST)}/batch_id={BATCH}"
    for k, city in enumerate(["AAA", "BBB", "CCC"]):
        body = __import__("json").dumps({"records": {"location": [location(city)]}})
        spark.createDataFrame([(body,)], "value string").coalesce(1).write.mode("append").text(folder)
        ingest_available(spark, layout, DATASET_FORECAST, AS_OF, f"{tmp_root}/_c")
        assert cities(spark, layout) == ["AAA", "BBB", "CCC"][:k + 1]
    assert len(flattened_files) == len(set(flattened_files)) == 3
    land_files(spark, layout, [[location("DDD")]])  # landed anew: the old files are gone
    ingest_available(spark, layout, DATASET_FORECAST, AS_OF, f"{tmp_root}/_c")
    assert cities(spark, layout) == ["DDD"] and len(flattened_files) == 4


def test_batch_landed_anew_while_pending_starts_again(spark, tmp_root):
    from skyfold.streaming.ingest import landed_files, load_arrivals
    layout = J.Layout(tmp_root)
    while len(landed_files(spark, layout, DATASET_FORECAST, BATCH)) != 2:
        land_files(spark, layout, [[location("AAA")], [location("BBB")]])
    folder = f"{layout.bronze(DATASET_FORECAST)}/batch_id={BATCH}"

    def names():
        return sorted(f"{folder}/{n}" for n in landed_files(spark, layout, DATASET_FORECAST, BATCH))

    old = names()
    load_arrivals(spark, layout, DATASET_FORECAST, {BATCH: old[:1]}, AS_OF)
    land_files(spark, layout, [[location("CCC")]])
    assert load_arrivals(spark, layout, DATASET_FORECAST, {BATCH: old[1:]}, AS_OF) == []  # gone by now
    assert load_arrivals(spark, layout, DATASET_FORECAST, {BATCH: names()}, AS_OF) == [BATCH]
    assert cities(spark, layout) == ["CCC"]


# ---------------------------------------------------------------- A1, Q1: kept aggregates

def test_marts_from_kept_aggregates_equal_a_rebuild_over_all_rows(spark, tmp_root):
    rng = random.Random(11)
    layout = J.Layout(tmp_root)
    ids = [BATCH, OTHER, "20260605T203000Z"]

    def entry(city):
        slots = [{"startTime": f"2026-06-0{rng.randint(3, 4)} 0{k}:00:00", "endTime": "2026-06-05 18:00:00",
                  "parameter": {"parameterName": str(rng.randint(10, 40)), "parameterUnit": "C"}} for k in range(3)]
        return {"locationName": city, "weatherElement": [{"elementName": c, "time": slots} for c in ("MinT", "MaxT")]}

    for _ in range(5):  # random reloads, empty ones too
        b = rng.choice(ids)
        land(spark, layout, DATASET_FORECAST, [entry(c) for c in rng.sample(["AAA", "BBB", "CCC"], rng.randint(0, 3))], b)
        land(spark, layout, DATASET_ALERT, [alert(f"{c}x") for c in rng.sample(["AAA", "DDD"], rng.randint(0, 2))], b)
        for d in J.FLOWS:
            J.batch_job(spark, layout, d, AS_OF, [b])
    J.build_marts(spark, layout)
    fc = M.stg_forecast(J.read_staging(spark, layout, "staging_forecast"))
    al = M.stg_alert(J.read_staging(spark, layout, "staging_alert"))
    dim_c = M.dim_city(fc, al)
    expected = {"dim_city": dim_c, "dim_area": M.dim_area(al),
                "fact_weather_forecast": M.fact_forecast(M.eph_forecast(fc, dim_c)),
                "fact_weather_alert": M.fact_alert(M.eph_alert(al), M.city_area_keys(dim_c, M.dim_area(al)))}
    for model, df in expected.items():
        got = spark.read.parquet(layout.mart(model)).select(*df.columns)
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, df.collect()), key=repr), model
    tests = J.Q.not_null_merged(J.read_kept(spark, layout, "staging_forecast"), "m", ["city"])
    assert tests.collect() == J.Q.not_null(fc, "m", ["city"]).collect()


def test_a_run_reads_the_staging_of_its_own_batches_only(spark, tmp_root):
    layout = J.Layout(tmp_root)
    for b in (BATCH, OTHER):
        land(spark, layout, DATASET_FORECAST, [location("AAA")], b)
        J.batch_job(spark, layout, DATASET_FORECAST, AS_OF, [b])
    tables = Snapshots(spark, tmp_root)
    first = tables.state["tables"]["staging/staging_forecast"]["batches"][BATCH][0]["folder"]
    for name in os.listdir(local(f"{tmp_root}/{first}")):  # older rows can't be read
        if name.endswith(".parquet"):
            with open(local(f"{tmp_root}/{first}/{name}"), "wb") as f:
                f.write(b"gone")
    land(spark, layout, DATASET_FORECAST, [location("BBB")], OTHER)
    J.batch_job(spark, layout, DATASET_FORECAST, AS_OF, [OTHER])
    J.build_marts(spark, layout)
    assert sorted(r.city for r in spark.read.parquet(layout.mart("dim_city")).collect()) == ["AAA", "BBB"]


def test_null_counts_merge_over_parts(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), (None, 2), ("b", None)], "k string, v int")
    parts = df.groupBy("k", "v").agg(F.count(F.lit(1)).alias("n_rows"))
    for columns in (["k"], ["k", "v"]):
        assert sorted(map(tuple, J.Q.not_null_merged(parts, "m", columns).collect())) == sorted(
            map(tuple, J.Q.not_null(df, "m", columns).collect()))
    assert [r.n_rows for r in J.Q.not_null_merged(parts.limit(0), "m", ["k"]).collect()] == [0]
