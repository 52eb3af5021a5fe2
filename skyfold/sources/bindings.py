"""Pipeline inputs derived from the driver tables.

The source pipeline consumes two weather payloads per run.  Here both are
derived, deterministically and in full, from the driver's tables so that the
work of every query grows with them:

* forecast: one ``events`` row is one forecast time slot.  City =
  ``'C' || lpad(user_id % 25, 2, '0')``, ``view`` -> MinT, ``click`` -> MaxT
  (except city ``C03``, which therefore never has a HighestTemp), the other
  event types become element codes that the flatten step must drop (``Wx``
  carries text, as a weather description does).  The
  batch is the event's day at 20:00.
* alert: one ``orders JOIN customer`` row is one alert.  Area =
  ``'C' || lpad(c_nationkey, 2, '0') || c_mktsegment`` (3-character city +
  district), level = first character of the priority, none for priority 4;
  the batch is the order month.

Raw documents are built at a bounded size: a document holds the entries of
one batch and one block of ids (``ids_per_document``), so no single group
grows with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyfold.constants import ALERT_LEVEL_PARAMETER, HIGHEST_TEMP, LOWEST_TEMP
from skyfold.functions.columns import to_batch_id
from skyfold.session import ensure_utc
from skyfold.sources.tables import read_table

IDS_PER_DOCUMENT = 1024

# Wall-clock text forms used inside the raw payloads.
FORECAST_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
ALERT_TS_FORMAT = "yyyy-MM-dd HH:mm:ss"

N_CITIES = 25
CITY_WITHOUT_HIGHEST = 3


def _city_code(n: Column) -> Column:
    return F.concat(F.lit("C"), F.lpad(n.cast("string"), 2, "0"))


def _event_city(ev: DataFrame) -> Column:
    return _city_code(ev.user_id % N_CITIES)


def _forecast_element_code(ev: DataFrame) -> Column:
    """Element code of an event; only MinT/MaxT survive the flatten step."""
    return (F.when(ev.event_type == "view", "MinT")
            .when((ev.event_type == "click") & (ev.user_id % N_CITIES != CITY_WITHOUT_HIGHEST),
                  "MaxT")
            .when(ev.event_type == "purchase", "Wx")
            .when(ev.event_type == "error", "CI")
            .otherwise("PoP"))


def _forecast_temp(ev: DataFrame) -> Column:
    base = F.when(ev.event_type == "view", 15).otherwise(26)
    return F.floor(ev.value).cast("int") % 15 + base


def _day_batch(ts: Column) -> Column:
    return F.date_trunc("day", ts) + F.expr("INTERVAL 20 HOURS")


def _month_batch(ts: Column) -> Column:
    return F.date_trunc("month", ts)


def staging_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed forecast staging rows (city, type, start/end, temp, unit, batch_time)."""
    ensure_utc(spark)
    ev = read_table(spark, sf_dir, "events")
    keep = ev.event_type.isin("view", "click") & ~(
        (ev.event_type == "click") & (ev.user_id % N_CITIES == CITY_WITHOUT_HIGHEST))
    return ev.where(keep).select(
        _event_city(ev).alias("city"),
        F.when(ev.event_type == "view", LOWEST_TEMP).otherwise(HIGHEST_TEMP).alias("type"),
        ev.ts.alias("start_time"),
        (ev.ts + F.expr("INTERVAL 12 HOURS")).alias("end_time"),
        _forecast_temp(ev).alias("temp"),
        F.lit("C").alias("unit"),
        _day_batch(ev.ts).alias("batch_time"),
    )


def _orders_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    c = read_table(spark, sf_dir, "customer")
    return o.join(c, o.o_custkey == c.c_custkey, "inner")


def _alert_area(c_nationkey: Column, c_mktsegment: Column) -> Column:
    return F.concat(_city_code(c_nationkey), c_mktsegment)


def _alert_level(priority: Column) -> Column:
    return F.nullif(F.substring(priority, 1, 1), F.lit("4"))


def staging_alert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed alert staging rows (event, level, area, start/end, batch_time)."""
    ensure_utc(spark)
    oc = _orders_customers(spark, sf_dir)
    return oc.select(
        F.col("o_orderstatus").alias("event"),
        _alert_level(F.col("o_orderpriority")).alias("level"),
        _alert_area(F.col("c_nationkey"), F.col("c_mktsegment")).alias("area"),
        F.col("o_orderdate").alias("start_time"),
        (F.col("o_orderdate") + F.expr("INTERVAL 24 HOURS")).alias("end_time"),
        _month_batch(F.col("o_orderdate")).alias("batch_time"),
    )


def forecast_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw forecast time slot per event, with its batch and document block."""
    ensure_utc(spark)
    ev = read_table(spark, sf_dir, "events")
    batch_time = _day_batch(ev.ts)
    kept = _forecast_element_code(ev).isin("MinT", "MaxT")
    return ev.select(
        to_batch_id(batch_time).alias("batch_id"),
        batch_time.alias("batch_time"),
        F.floor(ev.event_id / IDS_PER_DOCUMENT).alias("part"),
        _event_city(ev).alias("locationName"),
        _forecast_element_code(ev).alias("elementName"),
        F.struct(
            F.date_format(ev.ts, FORECAST_TS_FORMAT).alias("startTime"),
            F.date_format(ev.ts + F.expr("INTERVAL 12 HOURS"), FORECAST_TS_FORMAT).alias("endTime"),
            F.struct(
                F.when(kept, _forecast_temp(ev).cast("string"))
                 .when(ev.event_type == "purchase", ev.props)
                 .otherwise(F.floor(ev.value).cast("string")).alias("parameterName"),
                F.when(kept, F.lit("C")).otherwise(F.lit("%")).alias("parameterUnit"),
            ).alias("parameter"),
        ).alias("slot"),
    )


def forecast_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw forecast payloads as JSON text: (batch_id, batch_time, part, body).

    Nesting is rebuilt bottom-up (time[] per element, weatherElement[] per
    location, location[] per document); every group is bounded by the
    document block size, and one shuffle on the document key serves all
    three levels.
    """
    # One exchange on the document key serves all three levels: each level's
    # grouping keys contain (batch_id, part), so no further shuffle is needed.
    e = forecast_entries(spark, sf_dir).repartition("batch_id", "part")
    per_element = e.groupBy("batch_id", "batch_time", "part", "locationName", "elementName").agg(
        F.collect_list("slot").alias("time"))
    per_location = per_element.groupBy("batch_id", "batch_time", "part", "locationName").agg(
        F.collect_list(F.struct("elementName", "time")).alias("weatherElement"))
    per_doc = per_location.groupBy("batch_id", "batch_time", "part").agg(
        F.collect_list(F.struct("locationName", "weatherElement")).alias("location"))
    return per_doc.select(
        "batch_id", "batch_time", "part",
        F.to_json(F.struct(F.struct("location").alias("records"))).alias("body"))


def alert_infos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw alert ``info`` entry per order, with its batch and document block.

    ``parameter`` carries noise and two alert_criteria entries (older value
    first); priority 4 has none.  ``area`` starts with a NULL element.
    """
    ensure_utc(spark)
    oc = _orders_customers(spark, sf_dir)
    batch_time = _month_batch(F.col("o_orderdate"))
    level = _alert_level(F.col("o_orderpriority"))
    severity = F.struct(F.lit("severity").alias("valueName"),
                        F.col("o_orderpriority").alias("value"))
    older = F.struct(F.lit(ALERT_LEVEL_PARAMETER).alias("valueName"), F.lit("draft").alias("value"))
    final = F.struct(F.lit(ALERT_LEVEL_PARAMETER).alias("valueName"), level.alias("value"))
    parameter = F.when(level.isNull(), F.array(severity)).otherwise(F.array(severity, older, final))
    area = F.array(F.lit(None).cast("struct<areaDesc:string>"),
                   F.struct(_alert_area(F.col("c_nationkey"), F.col("c_mktsegment")).alias("areaDesc")))
    return oc.select(
        to_batch_id(batch_time).alias("batch_id"),
        batch_time.alias("batch_time"),
        F.floor(F.col("o_orderkey") / IDS_PER_DOCUMENT).alias("part"),
        F.struct(
            F.date_format("o_orderdate", ALERT_TS_FORMAT).alias("onset"),
            F.date_format(F.col("o_orderdate") + F.expr("INTERVAL 24 HOURS"),
                          ALERT_TS_FORMAT).alias("expires"),
            F.col("o_orderstatus").alias("event"),
            parameter.alias("parameter"),
            area.alias("area"),
        ).alias("info"),
    )


def alert_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw alert payloads as JSON text: (batch_id, batch_time, part, body)."""
    per_doc = alert_infos(spark, sf_dir).groupBy("batch_id", "batch_time", "part").agg(
        F.collect_list("info").alias("info"))
    return per_doc.select(
        "batch_id", "batch_time", "part",
        F.to_json(F.struct(F.struct("info").alias("records"))).alias("body"))


# ------------------------------------------------------------------ run state
#
# Run bookkeeping derived from ``events``: pipeline = 'p' || user_id.  A
# ``signup`` creates the pipeline's state row (updates logged before it are
# lost, as an UPDATE of a missing row is); view/click report RUNNING,
# purchase SUCCESS with a row count and the processed batch, error FAILED.

def _pipeline_name(ev: DataFrame) -> Column:
    return F.concat(F.lit("p"), ev.user_id.cast("string"))


def pipeline_registrations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Initial state rows: one per pipeline with a signup (plus ``created_seq``)."""
    ensure_utc(spark)
    ev = read_table(spark, sf_dir, "events")
    reg = ev.where(ev.event_type == "signup").groupBy(_pipeline_name(ev).alias("pipeline_name")).agg(
        F.min("event_id").alias("created_seq"),
        F.min_by(F.col("ts").cast("timestamp"), F.col("event_id")).alias("created_at"))
    return reg.select(
        "pipeline_name",
        F.lit(None).cast("string").alias("status"),
        F.lit(None).cast("long").alias("row_count"),
        F.lit(None).cast("timestamp").alias("last_processed_at"),
        F.lit(None).cast("timestamp").alias("last_run_at"),
        "created_at",
        F.col("created_at").alias("updated_at"),
        "created_seq",
    )


def pipeline_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The update log: pipeline_name, seq, status, row_count, last_processed_at, ts."""
    ensure_utc(spark)
    ev = read_table(spark, sf_dir, "events")
    success = ev.event_type == "purchase"
    return ev.where(ev.event_type != "signup").select(
        _pipeline_name(ev).alias("pipeline_name"),
        ev.event_id.alias("seq"),
        F.when(ev.event_type.isin("view", "click"), "RUNNING")
         .when(success, "SUCCESS").otherwise("FAILED").alias("status"),
        F.when(success, F.floor(ev.value)).cast("long").alias("row_count"),
        F.when(success, _day_batch(ev.ts)).alias("last_processed_at"),
        ev.ts.cast("timestamp").alias("ts"),
    )


# ------------------------------------------------------------------ retention
#
# Object names as the landing step of the source pipeline names them, one per
# fetch (event): forecasts as JSON with microseconds, others as silver
# parquet, error events leave a foreign log object without a timestamp.

def object_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_utc(spark)
    ev = read_table(spark, sf_dir, "events")
    name = (F.when(ev.event_type == "error",
                   F.concat(F.lit("weather/tmp/"), ev.event_id.cast("string"), F.lit(".log")))
            .when(ev.event_type.isin("view", "click"),
                  F.concat(F.lit("weather/temperature_"),
                           F.date_format(ev.ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
                           F.lit("+00:00.json")))
            .otherwise(F.concat(F.lit("weather/etl_temperature_"),
                                F.date_format(ev.ts, "yyyy-MM-dd'T'HH:mm:ss"),
                                F.lit("+00:00.parquet"))))
    return ev.select(name.alias("object_name"))
