"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per key.

Each query reads the driver tables in full (through the bindings) and runs
the operator or model under its key.  Sinks write below the shared folder
named by ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyfold.constants import DATASET_ALERT, DATASET_FORECAST
from skyfold.functions.columns import non_null_elements, surrogate_key, to_batch_id, weather_level
from skyfold.operators import flatten as FL
from skyfold.operators import quality as Q
from skyfold.operators import retention as R
from skyfold.operators import runstate as RS
from skyfold.operators import staging as ST
from skyfold.operators.joins import join_dimension, materialize
from skyfold.plans import catalog as C
from skyfold.plans import jobs as J
from skyfold.plans import models as M
from skyfold.session import ensure_utc, workspace
from skyfold.sinks import tables as K
from skyfold.sinks.snapshots import Snapshots
from skyfold.sources import bindings as B
from skyfold.sources import readers as RD
from skyfold.sources import schemas as S
from skyfold.sources.tables import read_table
from skyfold.streaming.ingest import ingest_available

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(key: str):
    def deco(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_utc(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[key] = run
        return run
    return deco


def _stg_fc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.stg_forecast(B.staging_forecast(spark, sf_dir))


def _stg_al(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.stg_alert(B.staging_alert(spark, sf_dir))


def _stg(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return _stg_fc(spark, sf_dir), _stg_al(spark, sf_dir)


# ---------------------------------------------------------------- models

@query("stg_forecast")
def q_stg_forecast(spark, sf_dir):
    return _stg_fc(spark, sf_dir)


@query("stg_alert")
def q_stg_alert(spark, sf_dir):
    return _stg_al(spark, sf_dir)


@query("eph_alert")
def q_eph_alert(spark, sf_dir):
    return M.eph_alert(_stg_al(spark, sf_dir))


@query("dim_city")
def q_dim_city(spark, sf_dir):
    fc, al = _stg(spark, sf_dir)
    return M.dim_city(fc, al)


@query("dim_area")
def q_dim_area(spark, sf_dir):
    return M.dim_area(_stg_al(spark, sf_dir))


def _eph_forecast(spark, sf_dir) -> DataFrame:
    fc, al = _stg(spark, sf_dir)
    return M.eph_forecast(fc, M.dim_city(fc, al))


@query("eph_forecast")
def q_eph_forecast(spark, sf_dir):
    return _eph_forecast(spark, sf_dir)


@query("fact_forecast")
def q_fact_forecast(spark, sf_dir):
    """Flagship: the forecast fact (aggregate per city and day, then join the city keys)."""
    return M.fact_forecast(_eph_forecast(spark, sf_dir))


@query("fact_alert")
def q_fact_alert(spark, sf_dir):
    fc, al = _stg(spark, sf_dir)
    keys = materialize(M.city_area_keys(M.dim_city(fc, al), M.dim_area(al)),
                       workspace(spark, "city_area_keys"))
    return M.fact_alert(M.eph_alert(al), keys)


# ---------------------------------------------------------------- helpers

# Fixed load time of the registered runs (reproducible audit columns).
AS_OF = _dt.datetime(2024, 2, 1, tzinfo=_dt.timezone.utc)


def ntz(df: DataFrame) -> DataFrame:
    """Present instants as UTC wall-clock (``TIMESTAMP_NTZ``) in results."""
    return df.select(*[F.col(f.name).cast("timestamp_ntz").alias(f.name)
                       if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
                       for f in df.schema.fields])


def _forecast_docs(spark, sf_dir) -> DataFrame:
    texts = B.forecast_documents(spark, sf_dir)
    return RD.parse_documents(texts.select("batch_id", "part", "body"), S.BRONZE_FORECAST)


def _alert_docs(spark, sf_dir) -> DataFrame:
    texts = B.alert_documents(spark, sf_dir)
    return RD.parse_documents(texts.select("batch_id", "part", "body"), S.BRONZE_ALERT)


def _staging_fc_table(spark, sf_dir) -> DataFrame:
    return B.staging_forecast(spark, sf_dir).withColumn("batch_id", to_batch_id("batch_time"))


def _staging_al_table(spark, sf_dir) -> DataFrame:
    return B.staging_alert(spark, sf_dir).withColumn("batch_id", to_batch_id("batch_time"))


def _dims(spark, sf_dir):
    """Both dimensions materialised (as the mart build writes them), as two
    concurrent jobs."""
    fc, al = _stg(spark, sf_dir)
    dim_c, dim_a = J.run_concurrently(
        lambda: materialize(M.dim_city(fc, al), workspace(spark, "dim_city")),
        lambda: materialize(M.dim_area(al), workspace(spark, "dim_area")))
    return fc, al, dim_c, dim_a


STAGING_OUT = ("city", "type", "start_time", "end_time", "temp", "unit", "batch_time")


# ---------------------------------------------------------------- flatten

@query("flatten_forecast")
def q_flatten_forecast(spark, sf_dir):
    rows = FL.flatten_forecast(_forecast_docs(spark, sf_dir))
    return rows.select("batch_id", *S.SILVER_FORECAST.fieldNames())


@query("flatten_alert")
def q_flatten_alert(spark, sf_dir):
    rows = FL.flatten_alert(_alert_docs(spark, sf_dir))
    return rows.select("batch_id", *S.SILVER_ALERT.fieldNames())


@query("map_code_filter")
def q_map_code_filter(spark, sf_dir):
    kept = FL.forecast_locations(_forecast_docs(spark, sf_dir))
    return kept.select("batch_id", "part", "City", "Type",
                       F.size("time").cast("long").alias("n_slots"))


@query("last_match_attr")
def q_last_match_attr(spark, sf_dir):
    return FL.alert_entries(_alert_docs(spark, sf_dir)).select(
        "batch_id", "event", "start_time", "level")


@query("drop_null_elements")
def q_drop_null_elements(spark, sf_dir):
    return FL.alert_entries(_alert_docs(spark, sf_dir)).select(
        "batch_id", "event", "start_time", F.size("areas").alias("n_areas"),
        F.size(non_null_elements("areas")).alias("n_areas_kept"))


@query("scan_bronze_json")
def q_scan_bronze_json(spark, sf_dir):
    """Land forecast payloads as JSON Lines, then scan them with the explicit schema."""
    layout = J.Layout(workspace(spark, "scan_bronze"))
    J.land(B.forecast_documents(spark, sf_dir), layout, DATASET_FORECAST)
    docs = RD.read_bronze(spark, layout.bronze(DATASET_FORECAST), S.BRONZE_FORECAST)
    loc = F.col("doc.records.location")
    n_el = F.aggregate(loc, F.lit(0), lambda acc, l: acc + F.size(l["weatherElement"]))
    n_slot = F.aggregate(loc, F.lit(0), lambda acc, l: acc + F.aggregate(
        l["weatherElement"], F.lit(0), lambda a2, e: a2 + F.size(e["time"])))
    return docs.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("n_documents"),
        F.sum(F.size(loc)).cast("long").alias("n_locations"),
        F.sum(n_el).cast("long").alias("n_elements"),
        F.sum(n_slot).cast("long").alias("n_slots"))


# ---------------------------------------------------------------- staging (P6-P9, K*)

@query("rename_standard")
def q_rename_standard(spark, sf_dir):
    silver = FL.flatten_forecast(_forecast_docs(spark, sf_dir)).select(
        *S.SILVER_FORECAST.fieldNames(), "batch_id")
    return ST.rename_standard(silver, S.STAGING_FORECAST_NAMES)


@query("cast_strict")
def q_cast_strict(spark, sf_dir):
    silver = FL.flatten_forecast(_forecast_docs(spark, sf_dir))
    staged = ST.forecast_to_staging(silver, AS_OF)
    return staged.select("city", "type", "start_time", "end_time", "temp", "unit", "batch_id")


@query("cast_quarantine")
def q_cast_quarantine(spark, sf_dir):
    """Every element's value cast to INT; text values are quarantined, not fatal."""
    slots = FL.forecast_all_slots(_forecast_docs(spark, sf_dir)).select(
        "batch_id", "City", "elementName", "startTime", F.col("Temp").alias("Temp_text"),
        F.col("Temp").alias("temp"))
    good, rejects = ST.cast_quarantine(slots, {"temp": "int"})
    return (good.withColumn("status", F.lit("ok"))
            .unionByName(rejects.drop("reject_reason")
                         .withColumn("temp", F.lit(None).cast("int"))
                         .withColumn("status", F.lit("rejected"))))


@query("audit_columns")
def q_audit_columns(spark, sf_dir):
    silver = FL.flatten_forecast(_forecast_docs(spark, sf_dir))
    return ntz(ST.forecast_to_staging(silver, AS_OF).drop("batch_id"))


@query("land_bronze")
def q_land_bronze(spark, sf_dir):
    """Land both payload sets; the forecast set twice (a rerun replaces, never doubles)."""
    layout = J.Layout(workspace(spark, "land_bronze"))
    fc_docs = B.forecast_documents(spark, sf_dir)
    J.land(fc_docs, layout, DATASET_FORECAST)
    J.land(fc_docs, layout, DATASET_FORECAST)
    J.land(B.alert_documents(spark, sf_dir), layout, DATASET_ALERT)
    out = []
    for ds, schema in ((DATASET_FORECAST, S.BRONZE_FORECAST), (DATASET_ALERT, S.BRONZE_ALERT)):
        docs = RD.read_bronze(spark, layout.bronze(ds), schema)
        out.append(docs.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n_documents"))
                   .select(F.lit(ds).alias("dataset"), "batch_id", "n_documents"))
    return out[0].unionByName(out[1])


@query("write_silver")
def q_write_silver(spark, sf_dir):
    """Silver alert rows written per batch, twice; read back per batch."""
    path = workspace(spark, "silver") + "/etl_temperature_alert"
    rows = FL.flatten_alert(_alert_docs(spark, sf_dir)).select(
        *S.SILVER_ALERT.fieldNames(), "batch_id")
    K.write_partitioned(rows, path)
    K.write_partitioned(rows, path)
    back = RD.read_silver(spark, path, S.SILVER_ALERT)
    return back.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n_rows"))


@query("scan_silver")
def q_scan_silver(spark, sf_dir):
    path = workspace(spark, "silver") + "/etl_temperature"
    rows = FL.flatten_forecast(_forecast_docs(spark, sf_dir)).select(
        *S.SILVER_FORECAST.fieldNames(), "batch_id")
    K.write_partitioned(rows, path)
    return RD.read_silver(spark, path, S.SILVER_FORECAST).select(
        "batch_id", *S.SILVER_FORECAST.fieldNames())


def _latest_batch_id(df: DataFrame) -> str:
    return df.agg(F.max("batch_id")).first()[0]


@query("replace_batch")
def q_replace_batch(spark, sf_dir):
    """Load every batch, then reload the latest batch (static replace): no duplicates."""
    path = workspace(spark, "staging") + "/staging_forecast"
    table = _staging_fc_table(spark, sf_dir)
    K.write_partitioned(table, path)
    latest = _latest_batch_id(K.read_table(spark, path, S.STAGING_FORECAST, partitioned=True))
    K.replace_batch(table.where(F.col("batch_id") == latest), path, latest)
    back = K.read_table(spark, path, S.STAGING_FORECAST, partitioned=True)
    return ntz(back.select(*STAGING_OUT))


@query("replace_batch_empty")
def q_replace_batch_empty(spark, sf_dir):
    """Reloading the latest batch with no rows empties it."""
    path = workspace(spark, "staging") + "/staging_alert"
    table = _staging_al_table(spark, sf_dir)
    K.write_partitioned(table, path)
    latest = _latest_batch_id(K.read_table(spark, path, S.STAGING_ALERT, partitioned=True))
    K.replace_batch(table.where(F.lit(False)), path, latest)
    back = K.read_table(spark, path, S.STAGING_ALERT, partitioned=True)
    return ntz(back.groupBy("batch_time").agg(F.count(F.lit(1)).alias("row_count")))


def _loaded(spark, sf_dir, table: DataFrame, dataset: str, layout: J.Layout, **options) -> list[str]:
    """Load every batch of a staged table into the deployment; their ids (one per batch)."""
    ids = sorted(r.batch_id for r in table.select("batch_id").distinct().collect())
    J.load_batches(spark, layout, J.FLOWS[dataset], table, ids, AS_OF, **options)
    return ids


@query("batch_failed_reload")
def q_batch_failed_reload(spark, sf_dir):
    """K3: the earliest batch is reloaded with its even temperatures, then a reload of the
    latest batch fails on its key: staging, warehouse and kept aggregates all hold what
    was committed last."""
    layout = J.Layout(workspace(spark, "failed_reload"))
    table = _staging_fc_table(spark, sf_dir)
    ids, flow = _loaded(spark, sf_dir, table, DATASET_FORECAST, layout), J.FLOWS[DATASET_FORECAST]
    even = table.where((F.col("batch_id") == ids[0]) & (F.col("temp") % 2 == 0))
    J.load_batches(spark, layout, flow, even, ids[:1], AS_OF)
    twice = table.where(F.col("batch_id") == ids[-1])
    try:
        J.load_batches(spark, layout, flow, twice.unionByName(twice), ids[-1:], AS_OF)
    except ST.KeyViolation:
        pass  # nothing was committed
    else:
        raise AssertionError("a broken key was committed")
    kept = J.read_kept(spark, layout, "staging_forecast").groupBy("batch_id").agg(F.sum("n_rows").alias("row_count"))
    parts = [kept.select(F.lit("kept").alias("layer"), "*")]
    for layer, df in (("staging", J.read_staging(spark, layout, "staging_forecast")),
                      ("warehouse", J.read_warehouse(spark, layout, "staging_forecast"))):
        parts.append(df.groupBy("batch_id").agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(layer).alias("layer"), "*"))
    return reduce(DataFrame.unionByName, parts)


@query("batch_stats")
def q_batch_stats(spark, sf_dir):
    """A2 / S3: rows and value range of every batch of both staging tables, kept and
    rejected, from the commit records (no data file is opened)."""
    layout = J.Layout(workspace(spark, "batch_stats"))
    _loaded(spark, sf_dir, _staging_fc_table(spark, sf_dir), DATASET_FORECAST, layout, publish=None)
    _loaded(spark, sf_dir, _staging_al_table(spark, sf_dir), DATASET_ALERT, layout, publish=None,
            on_key_violation="quarantine")
    tables = Snapshots(spark, layout.root)
    parts = [tables.batch_stats(t).select(F.lit(t).alias("table_name"), "batch_id", "row_count", "low", "high")
             for t in (J.STAGING + "staging_forecast", J.STAGING + "staging_alert", J.QUARANTINE + "staging_alert")]
    return reduce(DataFrame.unionByName, parts).where("row_count > 0")


@query("publish_append")
def q_publish_append(spark, sf_dir):
    """Append publish run twice: every batch is doubled (bare-load parity)."""
    path = workspace(spark, "warehouse") + "/staging_forecast"
    table = _staging_fc_table(spark, sf_dir).withColumn(
        "update_time", F.lit(AS_OF).cast("timestamp"))
    K.publish_append(table, path)
    K.publish_append(table, path)
    back = K.read_table(spark, path, S.STAGING_FORECAST, partitioned=True)
    return ntz(back.groupBy("batch_time").agg(F.count(F.lit(1)).alias("row_count")))


@query("publish_loaded_rows")
def q_publish_loaded_rows(spark, sf_dir):
    """K5 / A5: what each of two append publishes reports as loaded, and what the table
    holds after it."""
    path = workspace(spark, "warehouse") + "/staging_forecast"
    table = _staging_fc_table(spark, sf_dir).withColumn("update_time", F.lit(AS_OF).cast("timestamp"))
    rows = []
    for run in (1, 2):
        loaded = K.publish_append(table, path)
        held = K.read_table(spark, path, S.STAGING_FORECAST, partitioned=True).count()
        rows.append((run, loaded, held))
    return spark.createDataFrame(rows, "run long, loaded_rows long, table_rows long")


@query("scan_batch")
def q_scan_batch(spark, sf_dir):
    """The current (latest) batch of the staging table, partition-pruned."""
    path = workspace(spark, "staging") + "/staging_forecast"
    K.write_partitioned(_staging_fc_table(spark, sf_dir), path)
    table = K.read_table(spark, path, S.STAGING_FORECAST, partitioned=True)
    return ntz(RD.scan_batch(table, table.agg(F.max("batch_id")).scalar(), STAGING_OUT))


@query("sql_query")
def q_sql_query(spark, sf_dir):
    """Parameterised SQL over a registered staging view."""
    _stg_fc(spark, sf_dir).createOrReplaceTempView("stg_weather_forecast")
    return RD.sql_query(
        spark,
        "SELECT city, count(*) AS n_hot FROM stg_weather_forecast "
        "WHERE type = :kind AND temp >= :threshold GROUP BY city",
        kind="HighestTemp", threshold=32)


@query("list_objects")
def q_list_objects(spark, sf_dir):
    """List the landed bronze objects; report each batch folder found with the
    timestamp parsed from the object names (file names themselves are the
    writer's, so the listing is summarised per batch)."""
    layout = J.Layout(workspace(spark, "list_objects"))
    J.land(B.forecast_documents(spark, sf_dir), layout, DATASET_FORECAST)
    lst = R.with_object_ts(RD.list_objects(spark, layout.bronze(DATASET_FORECAST)), "path")
    return ntz(lst.where(F.col("length") > 0).select(
        F.regexp_extract("path", r"batch_id=([^/]+)", 1).alias("batch_id"),
        "object_ts").distinct())


# ---------------------------------------------------------------- scalar & set models

@query("split_area")
def q_split_area(spark, sf_dir):
    return M.eph_alert(_stg_al(spark, sf_dir)).select("area", "city", "district")


@query("bucket_level")
def q_bucket_level(spark, sf_dir):
    fc = _stg_fc(spark, sf_dir)
    return fc.groupBy("type", weather_level("temp").alias("level")).agg(
        F.count(F.lit(1)).alias("n_rows"))


@query("join_city_dim")
def q_join_city_dim(spark, sf_dir):
    fc, al = _stg(spark, sf_dir)
    dim_c = materialize(M.dim_city(fc, al), workspace(spark, "dim_city"))
    return join_dimension(fc, dim_c, "city").select("city_key", "city", "type",
                                                    "weather_date", "temp")


@query("union_distinct_city")
def q_union_distinct_city(spark, sf_dir):
    fc, al = _stg(spark, sf_dir)
    return M.city_list(fc, al)


@query("distinct_area")
def q_distinct_area(spark, sf_dir):
    return M.area_list(_stg_al(spark, sf_dir))


# ---------------------------------------------------------------- incremental dims

def _prior_cities(spark, sf_dir, null_region: int | None = None) -> DataFrame:
    """Cities the dimension held before: nations of the first two regions
    (with ``null_region``, that region's rows were loaded with a NULL city)."""
    n = read_table(spark, sf_dir, "nation")
    code = F.concat(F.lit("C"), F.lpad(n.n_nationkey.cast("string"), 2, "0"))
    if null_region is None:
        return n.where(n.n_regionkey <= 1).select(code.alias("city"))
    return n.where(n.n_regionkey <= null_region).select(
        F.when(n.n_regionkey <= 1, code).alias("city"))


def _prior_dim_city(spark, sf_dir, null_region=None) -> DataFrame:
    return _prior_cities(spark, sf_dir, null_region).select(
        F.md5("city").alias("city_key"), "city")


@query("dim_city_new")
def q_dim_city_new(spark, sf_dir):
    fc, al = _stg(spark, sf_dir)
    return M.dim_city_new(fc, al, _prior_dim_city(spark, sf_dir))


@query("dim_city_incremental")
def q_dim_city_incremental(spark, sf_dir):
    """Prior dimension, then two incremental runs: only new keys are appended."""
    fc, al = _stg(spark, sf_dir)
    path = workspace(spark, "marts") + "/dim_city"
    K.overwrite_table(_prior_dim_city(spark, sf_dir), path)
    for _ in range(2):
        K.append_rows(M.dim_city_new(fc, al, spark.read.parquet(path)), path)
    return spark.read.parquet(path)


@query("dim_city_rivals")
def q_dim_city_rivals(spark, sf_dir):
    """K9: two incremental builds read the same dimension; the second to commit finds it
    changed and computes its rows again, so no city comes in twice."""
    fc, al = _stg(spark, sf_dir)
    root, rival = workspace(spark, "rivals"), []
    schema = _prior_dim_city(spark, sf_dir).schema
    Snapshots(spark, root).replace_whole(_prior_dim_city(spark, sf_dir), "marts/dim_city")

    def missing(target: DataFrame) -> DataFrame:
        if not rival:  # another build commits between the read and the commit of this one
            rival.append(Snapshots(spark, root).add_rows(
                "marts/dim_city", lambda t: M.dim_city_new(fc, al, t), schema))
        return M.dim_city_new(fc, al, target)

    retries = Snapshots(spark, root).add_rows("marts/dim_city", missing, schema)
    return spark.read.parquet(*Snapshots(spark, root).paths("marts/dim_city")).withColumn(
        "retries", F.lit(retries).cast("long"))


@query("mart_rebuild")
def q_mart_rebuild(spark, sf_dir):
    """K8: a reader that has opened the dimension before a rebuild keeps its rows, one that
    opens it afterwards has the new ones."""
    fc, al = _stg(spark, sf_dir)
    tables = Snapshots(spark, workspace(spark, "rebuild"))
    tables.replace_whole(_prior_dim_city(spark, sf_dir), "marts/dim_city")
    before = spark.read.parquet(*tables.paths("marts/dim_city"))
    tables.replace_whole(M.dim_city(fc, al), "marts/dim_city")
    after = spark.read.parquet(*tables.paths("marts/dim_city"))
    return reduce(DataFrame.unionByName, [df.select(F.lit(name).alias("opened"), "city_key", "city")
                                          for name, df in (("before", before), ("after", after))])


@query("fact_forecast_merged")
def q_fact_forecast_merged(spark, sf_dir):
    """A1: the forecast fact merged from the aggregates kept with each batch, after the
    earliest batch was reloaded with its even temperatures and the latest one emptied."""
    layout = J.Layout(workspace(spark, "merged"))
    table, flow = _staging_fc_table(spark, sf_dir), J.FLOWS[DATASET_FORECAST]
    ids = _loaded(spark, sf_dir, table, DATASET_FORECAST, layout, publish=None)
    even = table.where((F.col("batch_id") == ids[0]) & (F.col("temp") % 2 == 0))
    J.load_batches(spark, layout, flow, even, [ids[0], ids[-1]], AS_OF, publish=None)
    days = J.read_kept(spark, layout, "staging_forecast")
    keys = days.select("city").distinct().select(surrogate_key("city").alias("city_key"), "city")
    return M.fact_forecast(M.daily_forecast_keys(M.forecast_daily_merged(days), keys))


@query("dq_not_null_merged")
def q_dq_not_null_merged(spark, sf_dir):
    """Q1: not_null results merged from each batch's own counts."""
    fc = M.stg_forecast(B.staging_forecast(spark, sf_dir)).withColumn("batch", F.col("weather_date"))
    al = M.stg_alert(B.staging_alert(spark, sf_dir)).withColumn("batch", F.col("weather_date"))
    days = materialize(M.forecast_day_parts(fc, "batch"), workspace(spark, "days"))
    levels = materialize(al.groupBy("batch", "area", "level").agg(F.count(F.lit(1)).alias("n_rows")),
                         workspace(spark, "levels"))
    return (Q.not_null_merged(days, "stg_weather_forecast", ["city", "weather_date"])
            .unionByName(Q.not_null_merged(levels, "stg_weather_alert", ["area", "level"])))


@query("not_in_null_target")
def q_not_in_null_target(spark, sf_dir):
    """A NULL key in the target blocks every insert (NOT IN semantics)."""
    fc, al = _stg(spark, sf_dir)
    return M.dim_city_new(fc, al, _prior_dim_city(spark, sf_dir, null_region=2))


def _prior_dim_area(spark, sf_dir, al) -> DataFrame:
    return M.dim_area(al).join(_prior_cities(spark, sf_dir), "city", "left_semi")


@query("dim_area_new")
def q_dim_area_new(spark, sf_dir):
    al = _stg_al(spark, sf_dir)
    return M.dim_area_new(al, _prior_dim_area(spark, sf_dir, al))


@query("dim_area_incremental")
def q_dim_area_incremental(spark, sf_dir):
    al = _stg_al(spark, sf_dir)
    path = workspace(spark, "marts") + "/dim_area"
    K.overwrite_table(_prior_dim_area(spark, sf_dir, al), path)
    for _ in range(2):
        K.append_rows(M.dim_area_new(al, spark.read.parquet(path)), path)
    return spark.read.parquet(path)


# ---------------------------------------------------------------- data quality (Q1-Q5)

@query("dq_not_null")
def q_dq_not_null(spark, sf_dir):
    fc, al, dim_c, dim_a = _dims(spark, sf_dir)
    ff = M.fact_forecast(M.eph_forecast(fc, dim_c))
    fa = M.fact_alert(M.eph_alert(al), M.city_area_keys(dim_c, dim_a))
    return (Q.not_null(fc, "stg_weather_forecast", ["city"])
            .unionByName(Q.not_null(al, "stg_weather_alert", ["area"]))
            .unionByName(Q.not_null(dim_a, "dim_area", ["area_key"]))
            .unionByName(Q.not_null(ff, "fact_weather_forecast", ["city_key"]))
            .unionByName(Q.not_null(fa, "fact_weather_alert", ["city_key", "area_key"])))


@query("dq_unique")
def q_dq_unique(spark, sf_dir):
    fc, al = _stg(spark, sf_dir)
    return (Q.unique(M.dim_area(al), "dim_area", "area_key")
            .unionByName(Q.unique(M.dim_city(fc, al), "dim_city", "city_key")))


@query("dq_pk_forecast")
def q_dq_pk_forecast(spark, sf_dir):
    return ntz(ST.key_violations(B.staging_forecast(spark, sf_dir), S.STAGING_FORECAST_KEY))


@query("dq_pk_alert")
def q_dq_pk_alert(spark, sf_dir):
    return ntz(ST.key_violations(B.staging_alert(spark, sf_dir), S.STAGING_ALERT_KEY))


@query("dq_pk_not_null")
def q_dq_pk_not_null(spark, sf_dir):
    return (Q.not_null(B.staging_forecast(spark, sf_dir), "staging_forecast",
                       list(S.STAGING_FORECAST_KEY))
            .unionByName(Q.not_null(B.staging_alert(spark, sf_dir), "staging_alert",
                                    list(S.STAGING_ALERT_KEY))))


@query("dq_orphans")
def q_dq_orphans(spark, sf_dir):
    fc, al, dim_c, dim_a = _dims(spark, sf_dir)
    ff = M.fact_forecast(M.eph_forecast(fc, dim_c))
    fa = M.fact_alert(M.eph_alert(al), M.city_area_keys(dim_c, dim_a))
    return (Q.orphans(ff, "fact_weather_forecast", [("city_key", dim_c, "city_key")])
            .unionByName(Q.orphans(fa, "fact_weather_alert", [("city_key", dim_c, "city_key"),
                                                              ("area_key", dim_a, "area_key")])))


@query("dq_failures")
def q_dq_failures(spark, sf_dir):
    """Every kind of data test on data that breaks it: facts against dimensions of an
    earlier state (orphans), alert levels (NULLs), area names as a key (duplicates)."""
    fc, al, dim_c, dim_a = _dims(spark, sf_dir)
    ff = M.fact_forecast(M.eph_forecast(fc, dim_c))
    fa = M.fact_alert(M.eph_alert(al), M.city_area_keys(dim_c, dim_a))
    old_c = _prior_dim_city(spark, sf_dir)
    old_a = dim_a.join(old_c.select("city"), "city", "left_semi")
    return (Q.orphans(ff, "fact_weather_forecast", [("city_key", old_c, "city_key")])
            .unionByName(Q.orphans(fa, "fact_weather_alert", [("city_key", old_c, "city_key"),
                                                              ("area_key", old_a, "area_key")]))
            .unionByName(Q.not_null(al, "stg_weather_alert", ["event", "level"]))
            .unionByName(Q.unique(al, "stg_weather_alert", "area")))


# ---------------------------------------------------------------- run state (Q6-Q8, A2, A3)

def _state(spark, sf_dir) -> DataFrame:
    return materialize(B.pipeline_registrations(spark, sf_dir), workspace(spark, "state"))


@query("pipeline_state_update")
def q_pipeline_state_update(spark, sf_dir):
    """Each known pipeline's first update after registration, applied once."""
    state = _state(spark, sf_dir)
    first = RS.first_updates(state, B.pipeline_updates(spark, sf_dir))
    return ntz(RS.apply_update(state, first))


@query("pipeline_state_fold")
def q_pipeline_state_fold(spark, sf_dir):
    state = _state(spark, sf_dir)
    return ntz(RS.fold_updates(state, B.pipeline_updates(spark, sf_dir)).select(*RS.STATE_COLUMNS))


@query("pipeline_state_lookup")
def q_pipeline_state_lookup(spark, sf_dir):
    """State of every pipeline that reported a failure (unknown names: no row)."""
    state = _state(spark, sf_dir)
    log = B.pipeline_updates(spark, sf_dir)
    folded = RS.fold_updates(state, log)
    return ntz(RS.lookup(folded, log.where(F.col("status") == "FAILED")))


@query("high_water_mark")
def q_high_water_mark(spark, sf_dir):
    state = _state(spark, sf_dir)
    return ntz(RS.high_water_mark(B.pipeline_updates(spark, sf_dir), state))


@query("batch_row_count")
def q_batch_row_count(spark, sf_dir):
    return ntz(RS.batch_row_counts({"staging_forecast": B.staging_forecast(spark, sf_dir),
                                    "staging_alert": B.staging_alert(spark, sf_dir)}))


@query("batch_row_count_total")
def q_batch_row_count_total(spark, sf_dir):
    return ntz(RS.batch_row_totals({"staging_forecast": B.staging_forecast(spark, sf_dir),
                                    "staging_alert": B.staging_alert(spark, sf_dir)}))


# ---------------------------------------------------------------- retention

def _named_objects(spark, sf_dir) -> DataFrame:
    return R.with_object_ts(B.object_names(spark, sf_dir), "object_name")


@query("parse_object_ts")
def q_parse_object_ts(spark, sf_dir):
    return ntz(_named_objects(spark, sf_dir))


def _latest_fetch(objs: DataFrame):
    return objs.agg(F.max("object_ts")).scalar()


@query("retention_candidates")
def q_retention_candidates(spark, sf_dir):
    """Objects older than the retention window, measured from the latest fetch."""
    objs = _named_objects(spark, sf_dir)
    return ntz(R.expired(objs, _latest_fetch(objs), "object_name"))


@query("retention_keep")
def q_retention_keep(spark, sf_dir):
    objs = _named_objects(spark, sf_dir)
    return ntz(R.kept(objs, _latest_fetch(objs), "object_name"))


# ---------------------------------------------------------------- docs, streaming, jobs



@query("table_docs")
def q_table_docs(spark, sf_dir):
    fc, al, dim_c, dim_a = _dims(spark, sf_dir)
    return C.catalog(C.docs_frame(spark), {
        "staging_forecast": B.staging_forecast(spark, sf_dir),
        "staging_alert": B.staging_alert(spark, sf_dir),
        "stg_weather_forecast": fc, "stg_weather_alert": al, "dim_city": dim_c,
        "dim_area": dim_a,
        "fact_weather_forecast": M.fact_forecast(M.eph_forecast(fc, dim_c)),
        "fact_weather_alert": M.fact_alert(M.eph_alert(al), M.city_area_keys(dim_c, dim_a)),
    })


@query("stream_ingest")
def q_stream_ingest(spark, sf_dir):
    """Land the forecast payloads, ingest them with an availableNow stream, run
    the stream again (nothing new: nothing changes), read staging back."""
    layout = J.Layout(workspace(spark, "stream"))
    J.land(B.forecast_documents(spark, sf_dir), layout, DATASET_FORECAST)
    ckpt = f"{layout.root}/_checkpoints/ingest_{DATASET_FORECAST}"
    for _ in range(2):
        ingest_available(spark, layout, DATASET_FORECAST, AS_OF, ckpt)
    back = J.read_staging(spark, layout, "staging_forecast")
    return ntz(back.select(*STAGING_OUT))


@query("stream_trickle")
def q_stream_trickle(spark, sf_dir):
    """The same in micro-batches of a few files: files are flattened once, a batch is loaded
    when its last file has arrived."""
    layout = J.Layout(workspace(spark, "trickle"))
    docs = B.forecast_documents(spark, sf_dir)
    J.land(docs, layout, DATASET_FORECAST)
    files = RD.list_objects(spark, layout.bronze(DATASET_FORECAST)).where("length > 0").count()
    ingest_available(spark, layout, DATASET_FORECAST, AS_OF, f"{layout.root}/_checkpoints/trickle",
                     max_files_per_trigger=max(1, -(-files // 3)))
    return ntz(J.read_staging(spark, layout, "staging_forecast").select(*STAGING_OUT))


def _alert_payload_table(spark, sf_dir, layout, **options) -> J.BatchResult:
    J.land(B.alert_documents(spark, sf_dir), layout, DATASET_ALERT)
    return J.batch_job(spark, layout, DATASET_ALERT, AS_OF, on_key_violation="quarantine", **options)


@query("quarantine_rejects")
def q_quarantine_rejects(spark, sf_dir):
    """E2 over alerts whose keys are broken: kept and rejected rows per batch, by reason."""
    layout = J.Layout(workspace(spark, "quarantine"))
    _alert_payload_table(spark, sf_dir, layout, publish=None)
    kept = J.read_staging(spark, layout, "staging_alert").withColumn("reason", F.lit("kept"))
    bad = J.read_quarantine(spark, layout, "staging_alert").withColumnRenamed("reject_reason", "reason")
    return kept.unionByName(bad).groupBy("batch_id", "reason").agg(F.count(F.lit(1)).alias("row_count"))


def _emptied(docs: DataFrame) -> DataFrame:
    """The payloads of the latest batch with nothing in them."""
    latest = docs.agg(F.max("batch_id")).first()[0]
    return docs.where(F.col("batch_id") == latest).select("batch_id").distinct().withColumn(
        "body", F.lit('{"records": {"location": []}}'))


def _layer_counts(spark, layout: J.Layout) -> DataFrame:
    """Forecast rows per batch in every layer."""
    silver = RD.read_silver(spark, layout.silver(DATASET_FORECAST), S.SILVER_FORECAST)
    staging = J.read_staging(spark, layout, "staging_forecast")
    warehouse = J.read_warehouse(spark, layout, "staging_forecast")
    parts = [df.groupBy("batch_id").agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(layer).alias("layer"), "batch_id", "row_count")
             for layer, df in (("silver", silver), ("staging", staging), ("warehouse", warehouse))]
    return reduce(DataFrame.unionByName, parts)


@query("batch_reload_empty")
def q_batch_reload_empty(spark, sf_dir):
    """The latest batch is landed again with no entries; a run over all landed
    batches empties it in every layer."""
    layout = J.Layout(workspace(spark, "reload"))
    docs = B.forecast_documents(spark, sf_dir)
    J.land(docs, layout, DATASET_FORECAST)
    J.batch_job(spark, layout, DATASET_FORECAST, AS_OF)
    J.land(_emptied(docs), layout, DATASET_FORECAST)
    J.batch_job(spark, layout, DATASET_FORECAST, AS_OF)
    return _layer_counts(spark, layout)


@query("stream_reload_empty")
def q_stream_reload_empty(spark, sf_dir):
    """The same through the stream: its second run sees only the emptied batch."""
    layout = J.Layout(workspace(spark, "stream_reload"))
    docs = B.forecast_documents(spark, sf_dir)
    ckpt = f"{layout.root}/_checkpoints/ingest_{DATASET_FORECAST}"
    J.land(docs, layout, DATASET_FORECAST)
    ingest_available(spark, layout, DATASET_FORECAST, AS_OF, ckpt)
    J.land(_emptied(docs), layout, DATASET_FORECAST)
    ingest_available(spark, layout, DATASET_FORECAST, AS_OF, ckpt)
    return _layer_counts(spark, layout)


@query("retention_after_delete")
def q_retention_after_delete(spark, sf_dir):
    """What is left after a real cleanup two days after the latest batch: landed batch
    folders, and objects of a batch stamp in their names beside them."""
    layout = J.Layout(workspace(spark, "retention"))
    docs = B.forecast_documents(spark, sf_dir)
    J.land(docs, layout, DATASET_FORECAST)
    stamps = docs.select("batch_time").distinct()
    as_of = stamps.agg(F.max("batch_time")).first()[0] + _dt.timedelta(days=1)
    # one object per batch, named by its stamp, in the other dataset's folder
    name = F.concat(F.lit("temperature_"), F.date_format("batch_time", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00.json"))
    names = (r.name for r in stamps.select(name.alias("name")).toLocalIterator())
    K.touch(spark, layout.bronze(DATASET_ALERT), names)
    J.expire(spark, layout, as_of.replace(tzinfo=_dt.timezone.utc))
    left = [R.with_object_ts(RD.list_objects(spark, layout.bronze(d)), "path").select(
        F.lit(d).alias("dataset"), "object_ts") for d in (DATASET_FORECAST, DATASET_ALERT)]
    return ntz(left[0].unionByName(left[1]).distinct())


PIPELINE = "forecast_and_alert_batches"


def _finished_run(spark, sf_dir) -> J.Layout:
    """E1-E5 end to end: land -> silver -> staging -> marts -> state -> retention.

    The alert batches break their staging key (duplicate keys, NULL levels),
    so violating rows go to the quarantine.
    """
    layout = J.Layout(workspace(spark, "pipeline"))
    J.register_pipeline(spark, layout, PIPELINE, AS_OF)
    J.run_pipeline(spark, layout, B.forecast_documents(spark, sf_dir), B.alert_documents(spark, sf_dir),
                   PIPELINE, batch_time=AS_OF, as_of=AS_OF, on_key_violation="quarantine")
    return layout


@query("pipeline_run")
def q_pipeline_run(spark, sf_dir):
    """The forecast fact of a whole run."""
    return spark.read.parquet(_finished_run(spark, sf_dir).mart("fact_weather_forecast"))


@query("pipeline_run_alert")
def q_pipeline_run_alert(spark, sf_dir):
    """The alert fact of a whole run: alerts with a clean key."""
    return spark.read.parquet(_finished_run(spark, sf_dir).mart("fact_weather_alert"))


@query("pipeline_run_dims")
def q_pipeline_run_dims(spark, sf_dir):
    """Both dimensions of a whole run."""
    layout = _finished_run(spark, sf_dir)
    dim_c, dim_a = (spark.read.parquet(layout.mart(m)) for m in ("dim_city", "dim_area"))
    return dim_c.select(F.col("city_key").alias("key"), "city", F.lit(None).cast("string").alias("area")).union(
        dim_a.select("area_key", "city", "area"))


@query("pipeline_run_tables")
def q_pipeline_run_tables(spark, sf_dir):
    """Rows of a whole run in staging, quarantine and warehouse, and of the staging views
    the mart build created; kept and rejected rows are all rows."""
    layout = _finished_run(spark, sf_dir)
    tables = {}
    for t in ("staging_forecast", "staging_alert"):
        tables[f"staging/{t}"] = J.read_staging(spark, layout, t)
        tables[f"quarantine/{t}"] = J.read_quarantine(spark, layout, t)
        tables[f"warehouse/{t}"] = J.read_warehouse(spark, layout, t)
    for v in ("stg_weather_forecast", "stg_weather_alert"):
        tables[f"view/{v}"] = spark.table(v)
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
             for n, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


@query("pipeline_run_state")
def q_pipeline_run_state(spark, sf_dir):
    """The state row after a whole run, with the staged rows of its batches."""
    return ntz(J.read_state(spark, _finished_run(spark, sf_dir)))


@query("pipeline_run_docs")
def q_pipeline_run_docs(spark, sf_dir):
    """The docs written beside the marts, with the rows of each written table."""
    layout = _finished_run(spark, sf_dir)
    models = {m: spark.read.parquet(layout.mart(m)) for m in (
        "dim_city", "dim_area", "fact_weather_forecast", "fact_weather_alert")}
    return C.catalog(spark.read.parquet(layout.mart("_docs")), models)
