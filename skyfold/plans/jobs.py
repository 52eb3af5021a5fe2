"""End-to-end jobs: land, forecast batch, alert batch, mart build,
bookkeeping, retention.

Every job takes a :class:`Layout` (folders below the shared workspace) and
an ``as_of`` time, so reruns are reproducible.  Each step is a Spark job
over whole batches; only batch ids and a handful of counters reach the
driver.  Staging, quarantine, warehouse and marts change by commit records
(:mod:`skyfold.sinks.snapshots`): a job that fails leaves them as they were.
"""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyfold.constants import (
    DATASET_ALERT,
    DATASET_FORECAST,
    RETENTION_DAYS,
    STATUS_FAILED,
    STATUS_RUNNING,
    STATUS_SUCCESS,
)
from skyfold.functions.columns import batch_id_of, weather_date
from skyfold.operators import flatten as FL
from skyfold.operators import quality as Q
from skyfold.operators import retention as R
from skyfold.operators import runstate as RS
from skyfold.operators import staging as ST
from skyfold.plans import models as M
from skyfold.plans.catalog import docs_frame, with_docs
from skyfold.sinks import tables as K
from skyfold.sinks.commitlog import SequenceLog
from skyfold.sinks.snapshots import Change, Snapshots, vacuum
from skyfold.sources import readers as RD
from skyfold.sources import schemas as S


@dataclass(frozen=True)
class Layout:
    """Folders of one deployment (all below one shared root)."""

    root: str

    def bronze(self, dataset: str) -> str:
        return f"{self.root}/bronze/{dataset}"

    def silver(self, dataset: str) -> str:
        return f"{self.root}/silver/etl_{dataset}"

    def mart(self, model: str) -> str:
        """What the mart consists of now, as a path to read (several folders as one
        pattern); a reader that has resolved it is not disturbed by a rebuild."""
        folders = Snapshots(_session(), self.root).paths(MART + model)
        if not folders:
            raise FileNotFoundError(f"{self.root}/{MART}{model} was never built")
        if len(folders) == 1:
            return folders[0]
        return f"{self.root}/{MART}{model}/{{{','.join(f.rsplit('/', 1)[1] for f in folders)}}}"

    @property
    def state_log(self) -> str:
        return f"{self.root}/state"


#: Tables of the commit records.
STAGING, QUARANTINE, WAREHOUSE, MART, KEPT = "staging/", "quarantine/", "warehouse/", "marts/", "kept/"


def _session() -> SparkSession:
    return SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()


def _day_parts(staged: DataFrame, *by: str) -> DataFrame:
    return M.forecast_day_parts(staged.withColumn("weather_date", weather_date("start_time")), *by)


FLOWS = {
    DATASET_FORECAST: dict(schema=S.BRONZE_FORECAST, silver=S.SILVER_FORECAST,
                           flatten=FL.flatten_forecast, stage=ST.forecast_to_staging,
                           table="staging_forecast", key=S.STAGING_FORECAST_KEY,
                           staging=S.STAGING_FORECAST, parts=_day_parts, kept=S.FORECAST_DAYS),
    DATASET_ALERT: dict(schema=S.BRONZE_ALERT, silver=S.SILVER_ALERT,
                        flatten=FL.flatten_alert, stage=ST.alert_to_staging,
                        table="staging_alert", key=S.STAGING_ALERT_KEY,
                        staging=S.STAGING_ALERT, parts=M.alert_area_parts, kept=S.ALERT_AREAS),
}


def run_concurrently(*steps: Callable[[], object]) -> list[object]:
    """Run independent steps as concurrent Spark jobs of one session (each
    from its own thread); the first failure is re-raised."""
    if len(steps) == 1:
        return [steps[0]()]
    with ThreadPoolExecutor(max_workers=len(steps)) as pool:
        futures = [pool.submit(step) for step in steps]
        return [f.result() for f in futures]


def land(docs: DataFrame, layout: Layout, dataset: str) -> list[str]:
    """K1: land raw documents ``(batch_id, body)``; a re-landed batch replaces
    the earlier landing.  Returns the batches landed."""
    return K.land_documents(docs, layout.bronze(dataset))


def _only(df: DataFrame, batch_ids: list[str]) -> DataFrame:
    return df.where(F.col("batch_id").isin(batch_ids))


def _flow_of(table: str) -> dict:
    return next(f for f in FLOWS.values() if f["table"] == table)


def _checked_schema(flow: dict) -> T.StructType:
    return T.StructType([*flow["staging"].fields, T.StructField("reject_reason", T.StringType())])


def read_staging(spark: SparkSession, layout: Layout, table: str) -> DataFrame:
    return Snapshots(spark, layout.root).read(STAGING + table, _flow_of(table)["staging"])


def read_quarantine(spark: SparkSession, layout: Layout, table: str) -> DataFrame:
    """Rows that a batch kept out of staging, with the reason."""
    return Snapshots(spark, layout.root).read(QUARANTINE + table, _checked_schema(_flow_of(table)))


def read_warehouse(spark: SparkSession, layout: Layout, table: str) -> DataFrame:
    """The published copy of a staging table."""
    return Snapshots(spark, layout.root).read(WAREHOUSE + table, _flow_of(table)["staging"])


def read_kept(spark: SparkSession, layout: Layout, table: str) -> DataFrame:
    """What the models need of each staged batch, aggregated when it was loaded."""
    return Snapshots(spark, layout.root).read(KEPT + table, _flow_of(table)["kept"])


def _with_batch(schema: T.StructType) -> T.StructType:
    return T.StructType(schema.fields + [T.StructField("batch_id", T.StringType())])


@dataclass(frozen=True)
class BatchResult:
    """What a batch job did: its batches, and the rows staged, rejected and published."""

    table: str
    batch_ids: list[str]
    staged: int
    rejected: int
    published: int


def batch_job(spark: SparkSession, layout: Layout, dataset: str, as_of: dt.datetime,
              batch_ids: list[str] | None = None, on_key_violation: str = "fail",
              publish: str | None = "replace_batch", multi_line: bool = False) -> BatchResult:
    """Bronze -> silver -> staging (-> warehouse) for the given batches
    (all landed batches by default); no other batch is read or written.

    * silver is written per batch (K2) and read back (S2);
    * the staging key is checked in the write that stages the rows (Q3/Q4): rows that
      break it lie in a partition of their own, which makes ``fail`` abort the job and
      is the quarantine of ``quarantine``;
    * one commit record then replaces the batches in staging, quarantine and warehouse
      (K3): a batch reloaded with no rows, or with rejected rows only, is emptied by it,
      and a job that fails before leaves all three as they were;
    * the same commit replaces the batches' kept aggregates, from which the marts are
      built (a replaced batch takes its share back);
    * ``publish='append'`` appends to the warehouse copy (duplicates on
      rerun, as a bare load does), ``'replace_batch'`` replaces its batches.

    The number of Spark jobs does not depend on the number of batches.  ``multi_line``
    reads payloads delivered as one pretty-printed document a file.
    """
    flow = FLOWS[dataset]
    landed = K.landed_batches(spark, layout.bronze(dataset))
    ids = landed if batch_ids is None else list(batch_ids)
    if set(ids) & set(landed):
        docs = _only(RD.read_bronze(spark, layout.bronze(dataset), flow["schema"], multi_line), ids)
    else:  # nothing landed for them: an empty payload (zero rows, batches emptied)
        docs = spark.createDataFrame([], T.StructType(
            [T.StructField("batch_id", T.StringType()), T.StructField("doc", flow["schema"])]))
    silver_rows = flow["flatten"](docs).select(*flow["silver"].fieldNames(), "batch_id")
    return load_silver(spark, layout, dataset, silver_rows, ids, as_of, on_key_violation, publish)


def load_silver(spark: SparkSession, layout: Layout, dataset: str, silver_rows: DataFrame, ids: list[str],
                as_of: dt.datetime, on_key_violation: str = "fail",
                publish: str | None = "replace_batch") -> BatchResult:
    """The rest of a batch job from the flattened rows of whole batches on."""
    flow = FLOWS[dataset]
    K.replace_batches(silver_rows, layout.silver(dataset), ids)
    silver = _only(RD.read_silver(spark, layout.silver(dataset), flow["silver"]), ids)
    return load_batches(spark, layout, flow, flow["stage"](silver, as_of), ids, as_of, on_key_violation, publish)


def load_batches(spark: SparkSession, layout: Layout, flow: dict, staged: DataFrame, ids: list[str],
                 as_of: dt.datetime, on_key_violation: str = "fail",
                 publish: str | None = "replace_batch") -> BatchResult:
    """Staged rows of the batches ``ids`` -> staging, quarantine and warehouse, by one
    commit."""
    tables, table, many = Snapshots(spark, layout.root), flow["table"], len(ids) > 1
    checked = ST.tag_key_violations(staged, flow["key"])
    schema = _checked_schema(flow)
    load = tables.new_folder(f"loads/{table}")
    tables.write(checked.withColumn("rejected", F.col("reject_reason").isNotNull()), load, ("rejected",), cluster=many)
    stats = tables.measured(load, schema, F.col("start_time"))
    good, bad = ({b: v for (rejected, b), v in stats.items() if rejected is kind} for kind in (False, True))
    if bad and on_key_violation != "quarantine":
        rows = spark.read.schema(schema).parquet(f"{layout.root}/{load}/rejected=true")
        ST.enforce_key(rows, flow["key"])
    rows = spark.read.schema(_with_batch(flow["staging"])).parquet(f"{layout.root}/{load}/rejected=false") if good else None
    copy, kept = tables.new_folder(WAREHOUSE + table), tables.new_folder(KEPT + table)

    def publish_copy() -> dict[str, dict]:
        if not (publish and good):
            return {}
        tables.write(rows.withColumn("update_time", F.lit(as_of).cast("timestamp")), copy)
        return {b: v | {"files": tables.files(copy)} for b, v in good.items()}  # the same rows

    def keep_parts() -> None:
        if good:  # a row or more of each batch; flat, the batch is a column
            tables.write(flow["parts"](rows, "batch_id"), kept)

    published, _ = run_concurrently(publish_copy, keep_parts)

    def replaced(name: str, folder: str, found: dict[str, dict]) -> Change:
        return Change(name + table, "replace", folder if found else None, found, [b for b in ids if b not in found])

    counted = {b: {"rows": 0, "low": None, "high": None, "files": []} for b in good}  # not measured
    changes = [replaced(STAGING, f"{load}/rejected=false", good), replaced(QUARANTINE, f"{load}/rejected=true", bad),
               replaced(KEPT, kept, counted)]
    if publish == "append":
        changes.append(Change(WAREHOUSE + table, "append", copy if published else None, published))
    elif publish:
        changes.append(replaced(WAREHOUSE, copy, published))
    tables.commit(changes)
    return BatchResult(table, ids, *(sum(v["rows"] for v in found.values()) for found in (good, bad, published)))


MART_TESTS = {
    # model -> not_null columns (declared data tests)
    "dim_area": ["area_key"],
    "fact_weather_alert": ["city_key", "area_key"],
    "fact_weather_forecast": ["city_key"],
    "stg_weather_alert": ["area"],
    "stg_weather_forecast": ["city"],
}


def build_marts(spark: SparkSession, layout: Layout, stg_fc: DataFrame | None = None,
                stg_al: DataFrame | None = None, incremental: bool = False,
                run_tests: bool = True) -> dict[str, str]:
    """Staging views -> dimensions -> facts, in dependency order.

    Dimensions are written first (full rebuild, or only new keys when
    ``incremental``) and the facts join the written dimensions, whose row
    sizes in bytes decide broadcast vs. shuffle.  The dimensions, the forecast fact
    and the tests of the staging models come from the aggregates kept with each batch
    (A1), so only the alert fact reads the staged history.  Data tests run after each
    model and fail the job.  All models of a build appear at once, by one commit
    record after the last test (K8; the new keys of an incremental build are
    committed before, K9): readers see the former marts until then, and for good
    if the build fails.  The staging models become session views of their
    names (K6), and the docs of all models and sources are written beside the
    marts (Q9).
    """
    if stg_fc is None:
        stg_fc = M.stg_forecast(read_staging(spark, layout, "staging_forecast"))
        days = read_kept(spark, layout, "staging_forecast")
    else:
        days = M.forecast_day_parts(stg_fc)
    if stg_al is None:
        stg_al = M.stg_alert(read_staging(spark, layout, "staging_alert"))
        areas = read_kept(spark, layout, "staging_alert")
    else:
        areas = M.alert_area_parts(stg_al)
    stg_fc.createOrReplaceTempView("stg_weather_forecast")
    stg_al.createOrReplaceTempView("stg_weather_alert")
    tables = Snapshots(spark, layout.root)
    built: dict[str, str] = {}

    def build(model: str, df: DataFrame) -> DataFrame:
        folder = tables.new_folder(MART + model)
        tables.write(df, folder)
        built[model] = folder
        return spark.read.schema(df.schema).parquet(f"{layout.root}/{folder}")

    def dimension(model: str, rows: Callable[[], DataFrame], new: Callable[[DataFrame], DataFrame]) -> DataFrame:
        if not (incremental and tables.has(MART + model)):
            return build(model, with_docs(rows(), model))
        own = Snapshots(spark, layout.root)
        own.add_rows(MART + model, new, rows().schema)
        return spark.read.schema(rows().schema).parquet(*own.paths(MART + model))

    def test_staging() -> None:
        if run_tests:
            Q.assert_passed(
                Q.not_null_merged(days, "stg_weather_forecast", MART_TESTS["stg_weather_forecast"])
                .unionByName(Q.not_null_merged(areas, "stg_weather_alert", MART_TESTS["stg_weather_alert"])))

    _, _, dim_c, dim_a = run_concurrently(
        test_staging,
        lambda: build("_docs", docs_frame(spark).coalesce(1)),
        lambda: dimension("dim_city", lambda: M.dim_city(days, areas),
                          lambda target: M.dim_city_new(days, areas, target)),
        lambda: dimension("dim_area", lambda: M.dim_area(areas), lambda target: M.dim_area_new(areas, target)))

    def test_dim_area() -> None:
        if run_tests:
            Q.assert_passed(Q.not_null(dim_a, "dim_area", MART_TESTS["dim_area"])
                            .unionByName(Q.unique(dim_a, "dim_area", "area_key")))

    def fact(model: str, df: DataFrame) -> None:
        rows = build(model, with_docs(df, model))
        if run_tests:
            Q.assert_passed(Q.not_null(rows, model, MART_TESTS[model]))

    def fact_alert() -> None:
        keys = tables.new_folder(f"{MART}_city_area_keys")
        tables.write(M.city_area_keys(dim_c, dim_a), keys)
        try:
            fact("fact_weather_alert", M.fact_alert(M.eph_alert(stg_al),
                                                    spark.read.parquet(f"{layout.root}/{keys}")))
        finally:
            K.drop_folder(spark, f"{layout.root}/{keys}")

    run_concurrently(test_dim_area, lambda: fact("fact_weather_forecast", M.fact_forecast(
        M.daily_forecast_keys(M.forecast_daily_merged(days), dim_c))), fact_alert)
    tables.commit([Change(MART + model, "whole", folder) for model, folder in sorted(built.items())])
    return {m: layout.mart(m) for m in ("dim_city", "dim_area", "fact_weather_forecast", "fact_weather_alert")}


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


STATE_DDL = ("pipeline_name string, status string, row_count long, last_processed_at timestamp, "
             "last_run_at timestamp, created_at timestamp, updated_at timestamp")


def _fold_state(state: dict, number: int, record: dict) -> dict:
    """One record of the run-state log; the rules of :func:`skyfold.operators.runstate.apply_update`."""
    name, ts = record["pipeline_name"], record["ts"]
    if record.get("register"):
        state.setdefault(name, dict.fromkeys(RS.STATE_COLUMNS[1:]) | {"created_at": ts, "updated_at": ts})
    elif name in state:
        row = state[name]
        row.update({k: record[k] for k in ("row_count", "last_processed_at") if record[k] is not None},
                   status=record["status"], updated_at=ts)
        if record["status"] == STATUS_RUNNING:
            row["last_run_at"] = ts
    return state


def _state_log(spark: SparkSession, layout: Layout) -> SequenceLog:
    return SequenceLog(spark, layout.state_log, _fold_state, dict)


def _text(t: dt.datetime | None) -> str | None:
    return None if t is None else t.astimezone(dt.timezone.utc).isoformat()


def record_state(spark: SparkSession, layout: Layout, pipeline_name: str, status: str,
                 as_of: dt.datetime, row_count: int | None = None,
                 last_processed_at: dt.datetime | None = None) -> None:
    """Append one state update to the update log.

    Updates are ordered by the number each takes in the log by compare-and-create, not by
    the clock of the machine that writes it; the log keeps a checkpoint of the folded
    state and a bounded tail.  Updates of a pipeline that is not registered yet don't
    count.
    """
    record = {"pipeline_name": pipeline_name, "status": status, "row_count": row_count,
              "last_processed_at": _text(last_processed_at), "ts": _text(as_of)}
    _state_log(spark, layout).append(lambda state: record)


def read_state(spark: SparkSession, layout: Layout) -> DataFrame:
    """The current state: one row per registered pipeline."""
    _, state = _state_log(spark, layout).read()
    times = ("last_processed_at", "last_run_at", "created_at", "updated_at")
    rows = [(name, *(dt.datetime.fromisoformat(row[c]) if c in times and row[c] else row[c]
                     for c in RS.STATE_COLUMNS[1:])) for name, row in sorted(state.items())]
    return spark.createDataFrame(rows, STATE_DDL)


def register_pipeline(spark: SparkSession, layout: Layout, pipeline_name: str,
                      as_of: dt.datetime) -> DataFrame:
    """Create the state row of a pipeline (updates of unknown pipelines are
    ignored, so a pipeline is registered once before its first run; the first
    registration counts)."""
    log = _state_log(spark, layout)
    if pipeline_name not in log.read()[1]:
        record = {"pipeline_name": pipeline_name, "register": True, "ts": _text(as_of)}
        log.append(lambda state: record)
    return read_state(spark, layout)


def success_row_count(spark: SparkSession, layout: Layout, batch_ids: list[str]) -> int:
    """A2 + A3: rows of both staging tables in these batches (0 if none), from the commit
    records; no data file is opened."""
    tables = Snapshots(spark, layout.root)
    return sum(tables.row_count(STAGING + RS.check_table_name(f["table"]), batch_ids) for f in FLOWS.values())


def expire(spark: SparkSession, layout: Layout, as_of: dt.datetime,
           days: int = RETENTION_DAYS, sample: int = 20) -> dict[str, object]:
    """E5: delete bronze and silver objects older than the window, by their own path
    (a batch folder as a whole).

    Each folder is listed once, by a Spark job; what is to go streams to the
    driver one partition at a time and is deleted a bounded number of paths at
    a time.  Only paths that are really gone are reported.  Objects whose name
    carries no timestamp are never deleted; they are counted, with a bounded
    sample.  Versions of tables that no commit has named for as long go too.
    """
    def clean(folder: str) -> tuple[list[str], list[str], int]:
        if not _exists(spark, folder):
            return [], [], 0
        examples: list[str] = []
        unparsed = 0
        units = R.delete_units(RD.list_objects(spark, folder), as_of, days=days)

        def old() -> Iterator[str]:
            nonlocal unparsed
            for r in units.toLocalIterator():
                if r.expired:
                    yield r.unit
                    continue
                unparsed += r.n_objects
                if len(examples) < sample:
                    examples.append(r.unit)

        return list(R.delete_paths(spark, old())), examples, unparsed

    done = run_concurrently(*[lambda f=f: clean(f) for d in FLOWS for f in (layout.bronze(d), layout.silver(d))])
    vacuum(Snapshots(spark, layout.root), time.time() - days * 86_400)
    return {"dropped": [p for gone, _, _ in done for p in gone], "unparsed": sum(n for _, _, n in done),
            "unparsed_sample": [p for _, examples, _ in done for p in examples][:sample]}


def _run(spark: SparkSession, layout: Layout, pipeline_name: str, batch_time: dt.datetime,
         as_of: dt.datetime, branch: Callable[[str], BatchResult]) -> DataFrame:
    """RUNNING -> ``branch`` of both datasets -> marts -> SUCCESS with the staged rows of
    this run's batches -> retention.  Any failure, the cleanup's too, records
    FAILED (earlier counts kept) and is raised."""
    record_state(spark, layout, pipeline_name, "RUNNING", as_of)
    try:
        results = run_concurrently(*[lambda d=d: branch(d) for d in FLOWS])
        build_marts(spark, layout)
        ids = sorted({b for r in results for b in r.batch_ids})
        record_state(spark, layout, pipeline_name, STATUS_SUCCESS, as_of,
                     row_count=success_row_count(spark, layout, ids), last_processed_at=batch_time)
        expire(spark, layout, as_of)
    except Exception:
        record_state(spark, layout, pipeline_name, STATUS_FAILED, as_of)
        raise
    return read_state(spark, layout)


def scheduled_run(spark: SparkSession, layout: Layout, pipeline_name: str,
                  batch_time: dt.datetime, as_of: dt.datetime | None = None,
                  on_key_violation: str = "fail", multi_line: bool = False) -> DataFrame:
    """One scheduled run over the batch stamped ``batch_time`` (landed before)."""
    as_of = as_of or dt.datetime.now(dt.timezone.utc)
    ids = [batch_id_of(batch_time)]
    return _run(spark, layout, pipeline_name, batch_time, as_of, lambda dataset: batch_job(
        spark, layout, dataset, as_of, ids, on_key_violation, multi_line=multi_line))


def run_pipeline(spark: SparkSession, layout: Layout, forecast_docs: DataFrame,
                 alert_docs: DataFrame, pipeline_name: str, batch_time: dt.datetime,
                 as_of: dt.datetime, on_key_violation: str = "fail") -> DataFrame:
    """Land both payload sets, then run over the batches they hold.

    Only these batches are flattened, staged, published and counted, whatever
    the deployment held before.
    """
    payloads = {DATASET_FORECAST: forecast_docs, DATASET_ALERT: alert_docs}

    def branch(dataset: str) -> BatchResult:
        # the payload is evaluated once, by the landing, which tells the batches it holds
        ids = land(payloads[dataset], layout, dataset)
        return batch_job(spark, layout, dataset, as_of, ids, on_key_violation)

    return _run(spark, layout, pipeline_name, batch_time, as_of, branch)
