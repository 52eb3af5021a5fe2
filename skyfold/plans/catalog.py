"""Documentation of models and sources: descriptions, tags and column docs (Q9).

Column docs travel with the data as metadata (``comment``) on written tables;
descriptions and tags are written as the table ``_docs`` beside the marts, and
a catalog frame adds each model's size.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Tags that every model of a layer carries before its own ones.
LAYER_TAGS = {"view": ["staging"], "table": ["mart"]}

SOURCE_DOCS = {
    "staging_forecast": dict(
        description="Forecast time slots as loaded, one partition per batch.",
        columns={"city": "City name.", "type": "Weather element.",
                 "start_time": "Begin of the time slot.", "temp": "Temperature, Celsius."}),
    "staging_alert": dict(
        description="Temperature alerts as loaded, one partition per batch.",
        columns={"event": "Name of the alert.", "level": "Severity.", "area": "Area concerned.",
                 "start_time": "When the alert was issued."}),
}

MODEL_DOCS = {
    "stg_weather_forecast": dict(
        materialized="view", tags=["weather", "forecast"],
        description="Forecast time slots with the forecast date derived from the start time.",
        columns={"city": "City code.", "type": "LowestTemp or HighestTemp.",
                 "weather_date": "Date of the slot start.", "temp": "Temperature, Celsius."}),
    "stg_weather_alert": dict(
        materialized="view", tags=["weather", "alert"],
        description="Temperature alerts per area with the alert date.",
        columns={"event": "Alert event.", "level": "Alert level.", "area": "Area name.",
                 "weather_date": "Date of the alert onset."}),
    "dim_city": dict(
        materialized="table", tags=["dim", "city"],
        description="City keys of every city seen in forecasts or alerts.",
        columns={"city_key": "md5 of the city.", "city": "City code."}),
    "dim_area": dict(
        materialized="table", tags=["dim", "area"],
        description="Area keys of every area seen in alerts.",
        columns={"area_key": "md5 of city and district.", "city": "City prefix.",
                 "area": "District within the city."}),
    "fact_weather_forecast": dict(
        materialized="table", tags=["fact", "weather", "forecast"],
        description="Average low and high temperature per city and day, with a heat flag.",
        columns={"city_key": "Key of dim_city.", "weather_date": "Forecast date.",
                 "avg_LowestTemp": "Average forecast low.",
                 "avg_HighestTemp": "Average forecast high.",
                 "flag_HighestTemp": "Extreme, Hot, Warm or Normal."}),
    "fact_weather_alert": dict(
        materialized="table", tags=["fact", "weather", "alert"],
        description="One row per alert and area, keyed to both dimensions.",
        columns={"city_key": "Key of dim_city.", "area_key": "Key of dim_area.",
                 "weather_date": "Alert date.", "event": "Alert event.",
                 "level": "Alert level."}),
}


def with_docs(df: DataFrame, model: str) -> DataFrame:
    """Attach column comments as field metadata (kept by parquet writes)."""
    for col, text in MODEL_DOCS[model]["columns"].items():
        if col in df.columns:
            df = df.withMetadata(col, {"comment": text})
    return df


def tags_of(model: str) -> list[str]:
    docs = MODEL_DOCS[model]
    return LAYER_TAGS[docs["materialized"]] + docs["tags"]


def docs_frame(spark: SparkSession) -> DataFrame:
    rows = [(m, d["materialized"], d["description"], ",".join(tags_of(m)))
            for m, d in MODEL_DOCS.items()]
    rows += [(m, "source", d["description"], "") for m, d in SOURCE_DOCS.items()]
    return spark.createDataFrame(rows, "model string, materialized string, "
                                       "description string, tags string")


def catalog(docs: DataFrame, models: dict[str, DataFrame]) -> DataFrame:
    """``docs`` of each model and source with its current row count (one aggregate each)."""
    counts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("model"), "n_rows")
              for name, df in models.items()]
    return docs.join(reduce(DataFrame.unionByName, counts), "model", "inner")
