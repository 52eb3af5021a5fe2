"""Explicit schemas for every layer (no schema inference anywhere)."""

from __future__ import annotations

from pyspark.sql import types as T

S, I, L, D = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
TS, NTZ, DATE = T.TimestampType(), T.TimestampNTZType(), T.DateType()


def _fields(*spec: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in spec])


# Raw forecast payload: records.location[].weatherElement[].time[]
FORECAST_TIME = _fields(
    ("startTime", S), ("endTime", S),
    ("parameter", _fields(("parameterName", S), ("parameterUnit", S))),
)
FORECAST_ELEMENT = _fields(("elementName", S), ("time", T.ArrayType(FORECAST_TIME)))
FORECAST_LOCATION = _fields(("locationName", S),
                            ("weatherElement", T.ArrayType(FORECAST_ELEMENT)))
BRONZE_FORECAST = _fields(("records", _fields(("location", T.ArrayType(FORECAST_LOCATION)))))

# Raw alert payload: records.info[] with parameter[] and area[] (NULL elements allowed)
ALERT_PARAMETER = _fields(("valueName", S), ("value", S))
ALERT_AREA = _fields(("areaDesc", S))
ALERT_INFO = _fields(
    ("onset", S), ("expires", S), ("event", S),
    ("parameter", T.ArrayType(ALERT_PARAMETER)),
    ("area", T.ArrayType(ALERT_AREA, containsNull=True)),
)
BRONZE_ALERT = _fields(("records", _fields(("info", T.ArrayType(ALERT_INFO)))))

# Silver: flattened, still all text (positional column order matters)
SILVER_FORECAST = _fields(("City", S), ("Type", S), ("startTime", S), ("endTime", S),
                          ("Temp", S), ("Unit", S))
SILVER_ALERT = _fields(("event", S), ("level", S), ("area", S), ("start_time", S),
                       ("end_time", S))

# Staging: typed, one partition per batch
STAGING_FORECAST = _fields(("city", S), ("type", S), ("start_time", NTZ), ("end_time", NTZ),
                           ("temp", I), ("unit", S), ("batch_time", TS), ("update_time", TS))
STAGING_ALERT = _fields(("event", S), ("level", S), ("area", S), ("start_time", NTZ),
                        ("end_time", NTZ), ("batch_time", TS), ("update_time", TS))

# Primary keys declared by the staging DDL
STAGING_FORECAST_KEY = ("city", "type", "start_time", "end_time", "batch_time")
STAGING_ALERT_KEY = ("area", "level", "start_time", "end_time", "batch_time")

# Positional standard names (silver -> staging rename)
STAGING_FORECAST_NAMES = ("city", "type", "start_time", "end_time", "temp", "unit")
STAGING_ALERT_NAMES = ("event", "level", "area", "start_time", "end_time")

# City reference seed
CITY_REFERENCE = _fields(("city_id", I), ("city_name", S), ("country", S), ("latitude", D),
                         ("longitude", D), ("timezone", S), ("is_active", I))

# Run state
PIPELINE_STATE = _fields(("pipeline_name", S), ("status", S), ("row_count", L),
                         ("last_processed_at", TS), ("last_run_at", TS),
                         ("created_at", TS), ("updated_at", TS))
PIPELINE_UPDATE = _fields(("pipeline_name", S), ("seq", L), ("status", S), ("row_count", L),
                          ("last_processed_at", TS), ("ts", TS))

# Aggregates kept with each staged batch
FORECAST_DAYS = _fields(("city", S), ("weather_date", T.DateType()), ("n_rows", L), ("low_sum", L),
                        ("low_n", L), ("high_sum", L), ("high_n", L))
ALERT_AREAS = _fields(("area", S), ("n_rows", L))
