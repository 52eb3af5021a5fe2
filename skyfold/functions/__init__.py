"""Column-level functions (JVM-side expressions only, no Python UDFs)."""

from skyfold.functions.columns import (  # noqa: F401
    city_of,
    district_of,
    element_label,
    last_match,
    non_null_elements,
    object_timestamp,
    surrogate_key,
    to_batch_id,
    weather_date,
    weather_level,
    weather_level_sql,
)
