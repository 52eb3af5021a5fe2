"""Flatten nested raw payloads into silver rows (all text, as in silver).

Chained ``explode`` over explicit schemas; an empty or NULL array yields no
rows.  The element-code filter runs between the explodes, before the time
slots are expanded.  Columns other than the payload (e.g. ``batch_id``) are
carried through unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyfold.constants import ALERT_LEVEL_PARAMETER
from skyfold.functions.columns import element_label, last_match


def _carry(df: DataFrame, payload: str) -> list[str]:
    return [c for c in df.columns if c != payload]


def require_shape(doc: Column, path: str) -> Column:
    """Fail the job (inside the task, no extra pass) if ``path`` is missing.

    An entry whose array or struct is absent is a broken payload; parsing would
    otherwise silently yield no rows for it.  An empty array is fine.
    """
    field = doc
    for part in path.split("."):
        field = field[part]
    return F.when(field.isNull(),
                  F.raise_error(F.lit(f"raw document without {path}"))).otherwise(field)


def _slots(df: DataFrame, names: list[str], elements: Column) -> DataFrame:
    """One row per time slot of each element, every slot with its parameter."""
    slot = df.select(*names, F.explode(elements).alias("t"))
    parameter = require_shape(F.col("t"), "parameter")
    return slot.select(*names, F.col("t.startTime").alias("startTime"),
                       F.col("t.endTime").alias("endTime"),
                       parameter["parameterName"].alias("Temp"),
                       parameter["parameterUnit"].alias("Unit"))


def forecast_locations(docs: DataFrame, payload: str = "doc") -> DataFrame:
    """One row per (location, weatherElement) with a kept element code.

    Output: carried columns, City, Type, time (array of slots).
    """
    carry = _carry(docs, payload)
    loc = docs.select(*carry, F.explode(require_shape(F.col(payload), "records.location"))
                      .alias("loc"))
    el = loc.select(*carry, F.col("loc.locationName").alias("City"),
                    F.explode(require_shape(F.col("loc"), "weatherElement")).alias("el"))
    kept = el.withColumn("Type", element_label(F.col("el.elementName"))
                         ).where(F.col("Type").isNotNull())
    # only a kept element needs its slots
    return kept.select(*carry, "City", "Type", require_shape(F.col("el"), "time").alias("time"))


def flatten_forecast(docs: DataFrame, payload: str = "doc") -> DataFrame:
    """location[] x weatherElement[] x time[] -> City, Type, startTime, endTime, Temp, Unit."""
    kept = forecast_locations(docs, payload)
    carry = [c for c in kept.columns if c not in ("City", "Type", "time")]
    return _slots(kept, [*carry, "City", "Type"], F.col("time"))


def alert_entries(docs: DataFrame, payload: str = "doc") -> DataFrame:
    """One row per alert ``info``: event, level (last alert_criteria), times, area[]."""
    carry = _carry(docs, payload)
    info = docs.select(*carry, F.explode(require_shape(F.col(payload), "records.info"))
                       .alias("info"))
    return info.select(
        *carry,
        F.col("info.event").alias("event"),
        last_match(require_shape(F.col("info"), "parameter"), "valueName", "value",
                   ALERT_LEVEL_PARAMETER).alias("level"),
        F.col("info.onset").alias("start_time"),
        F.col("info.expires").alias("end_time"),
        require_shape(F.col("info"), "area").alias("areas"),
    )


def flatten_alert(docs: DataFrame, payload: str = "doc") -> DataFrame:
    """info[] x area[] -> event, level, area, start_time, end_time (NULL areas skipped)."""
    entries = alert_entries(docs, payload)
    carry = [c for c in entries.columns
             if c not in ("event", "level", "start_time", "end_time", "areas")]
    rows = entries.select(*carry, "event", "level", "start_time", "end_time",
                          F.explode("areas").alias("a"))
    return (rows.where(F.col("a").isNotNull())
                .select(*carry, "event", "level", F.col("a.areaDesc").alias("area"),
                        "start_time", "end_time"))


def forecast_all_slots(docs: DataFrame, payload: str = "doc") -> DataFrame:
    """Every time slot of every element, codes not filtered:
    City, elementName, startTime, endTime, Temp, Unit."""
    carry = _carry(docs, payload)
    loc = docs.select(*carry, F.explode(require_shape(F.col(payload), "records.location"))
                      .alias("loc"))
    el = loc.select(*carry, F.col("loc.locationName").alias("City"),
                    F.explode(require_shape(F.col("loc"), "weatherElement")).alias("el"))
    named = el.select(*carry, "City", F.col("el.elementName").alias("elementName"), "el")
    return _slots(named, [*carry, "City", "elementName"], require_shape(F.col("el"), "time"))
