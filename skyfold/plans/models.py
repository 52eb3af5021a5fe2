"""The star-schema models: staging views, intermediates, dimensions, facts.

``stg_*`` are projections (views); ``eph_*`` are lazy intermediates that are
never written; ``dim_*`` and ``fact_*`` are what gets materialised.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyfold.constants import HIGHEST_TEMP, LOWEST_TEMP
from skyfold.functions.columns import (
    city_of,
    district_of,
    surrogate_key,
    weather_date,
    weather_level,
)
from skyfold.operators.joins import join_dimension, not_in


def stg_forecast(staging_forecast: DataFrame) -> DataFrame:
    """M1: city, type, weather_date, temp (every batch is kept)."""
    return staging_forecast.select(
        "city", "type", weather_date("start_time").alias("weather_date"), "temp")


def stg_alert(staging_alert: DataFrame) -> DataFrame:
    """M2: event, level, area, weather_date (every batch is kept)."""
    return staging_alert.select(
        "event", "level", "area", weather_date("start_time").alias("weather_date"))


def eph_alert(stg_al: DataFrame) -> DataFrame:
    """Alert rows with the area split into city prefix and district."""
    return stg_al.select("event", "level", "area", "weather_date",
                         city_of("area").alias("city"), district_of("area").alias("district"))


def city_list(stg_fc: DataFrame, stg_al: DataFrame) -> DataFrame:
    """Distinct cities of forecasts and alerts (UNION DISTINCT; NULL kept once)."""
    fc = stg_fc.select("city").distinct()
    al = stg_al.select(city_of("area").alias("city")).distinct()
    return fc.union(al).distinct()


def dim_city(stg_fc: DataFrame, stg_al: DataFrame) -> DataFrame:
    """city_key = md5(city), city."""
    return city_list(stg_fc, stg_al).select(surrogate_key("city").alias("city_key"), "city")


def area_list(stg_al: DataFrame) -> DataFrame:
    """A4: distinct (city prefix, district) pairs of the alerts."""
    return stg_al.select(city_of("area").alias("city"),
                         district_of("area").alias("area")).distinct()


def dim_area(stg_al: DataFrame) -> DataFrame:
    """area_key = md5(city || area), city, area."""
    return area_list(stg_al).select(surrogate_key("city", "area").alias("area_key"),
                                    "city", "area")


def dim_city_new(stg_fc: DataFrame, stg_al: DataFrame, target: DataFrame) -> DataFrame:
    """Incremental rows: cities NOT IN the existing dimension."""
    return not_in(dim_city(stg_fc, stg_al), "city", target, "city")


def dim_area_new(stg_al: DataFrame, target: DataFrame) -> DataFrame:
    """Incremental rows: area keys NOT IN the existing dimension."""
    return not_in(dim_area(stg_al), "area_key", target, "area_key")


def forecast_daily(stg_fc: DataFrame) -> DataFrame:
    """A1: conditional averages per (city, weather_date), a two-column pivot.

    Aggregating on ``city`` before the dimension join is exact because the
    dimension holds one row per city (city_key = md5(city)); it shrinks the
    join input to one row per city and day, and the partial (map-side)
    aggregate makes a hot city cheap to shuffle.
    """
    return stg_fc.groupBy("city", "weather_date").agg(
        F.avg(F.when(F.col("type") == LOWEST_TEMP, F.col("temp"))).alias("avg_LowestTemp"),
        F.avg(F.when(F.col("type") == HIGHEST_TEMP, F.col("temp"))).alias("avg_HighestTemp"),
    )


def forecast_day_parts(stg_fc: DataFrame, *by: str) -> DataFrame:
    """A1, kept state: per (city, weather_date) the rows, and the sum and count of both
    temperatures; ``by`` keeps the parts of e.g. each batch apart."""
    low, high = (F.when(F.col("type") == t, F.col("temp")) for t in (LOWEST_TEMP, HIGHEST_TEMP))
    return stg_fc.groupBy(*by, "city", "weather_date").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(low).alias("low_sum"), F.count(low).alias("low_n"),
        F.sum(high).alias("high_sum"), F.count(high).alias("high_n"))


def forecast_daily_merged(parts: DataFrame) -> DataFrame:
    """:func:`forecast_daily` from any set of :func:`forecast_day_parts`: sums and counts
    add up, averages don't."""
    merged = parts.groupBy("city", "weather_date").agg(*[F.sum(c).alias(c) for c in (
        "low_sum", "low_n", "high_sum", "high_n")])
    return merged.select("city", "weather_date", *[
        F.when(F.col(f"{k}_n") > 0, F.col(f"{k}_sum") / F.col(f"{k}_n")).alias(name)
        for k, name in (("low", "avg_LowestTemp"), ("high", "avg_HighestTemp"))])


def alert_area_parts(stg_al: DataFrame, *by: str) -> DataFrame:
    """Kept state of the alert dimensions: the rows of each area."""
    return stg_al.groupBy(*by, "area").agg(F.count(F.lit(1)).alias("n_rows"))


def eph_forecast(stg_fc: DataFrame, dim_c: DataFrame) -> DataFrame:
    """city_key, weather_date, avg_LowestTemp, avg_HighestTemp, from all rows."""
    return daily_forecast_keys(forecast_daily(stg_fc), dim_c)


def daily_forecast_keys(daily: DataFrame, dim_c: DataFrame) -> DataFrame:
    """The city keys of daily averages.

    Both join inputs are aggregates (one row per city and day, one row per
    city): their size follows the number of cities and days, not the number
    of forecast rows, so the join is left to Catalyst/AQE without a size
    check or a materialised dimension.
    """
    joined = daily.join(dim_c.select("city", "city_key"), "city", "inner")
    return joined.select("city_key", "weather_date", "avg_LowestTemp", "avg_HighestTemp")


def fact_forecast(eph_fc: DataFrame) -> DataFrame:
    """The forecast fact, averages plus the HighestTemp bucket (NULL -> Normal)."""
    return eph_fc.select("city_key", "weather_date", "avg_LowestTemp", "avg_HighestTemp",
                         weather_level("avg_HighestTemp").alias("flag_HighestTemp"))


def city_area_keys(dim_c: DataFrame, dim_a: DataFrame) -> DataFrame:
    """Both dimensions pre-joined on city: (city, area, city_key, area_key).

    ``s JOIN dim_city ON city JOIN dim_area ON (city, area)`` equals one join
    of ``s`` with this small relation, so the large alert side is joined
    once instead of twice.
    """
    return (dim_c.select("city", "city_key")
            .join(dim_a.select("city", "area", "area_key"), "city", "inner"))


def fact_alert(eph_al: DataFrame, keys: DataFrame) -> DataFrame:
    """city_key, area_key, weather_date, event, level (no dedupe across batches).

    ``keys`` is :func:`city_area_keys` of the two dimensions, ideally read
    from a materialised table so that its size in bytes is known.
    """
    keys = keys.withColumnRenamed("area", "district")
    joined = join_dimension(eph_al, keys, ["city", "district"])
    return joined.select("city_key", "area_key", "weather_date", "event", "level")
