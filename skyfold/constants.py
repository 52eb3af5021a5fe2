"""Fixed values.

These must equal the source pipeline's values for identical results; they
are stated here once, in their natural order, and imported everywhere else.
"""

# Forecast element codes kept by the flatten step, and the
# label each one becomes.  Every other element code is dropped.
ELEMENT_LABELS = {
    "MinT": "LowestTemp",
    "MaxT": "HighestTemp",
}
LOWEST_TEMP = "LowestTemp"
HIGHEST_TEMP = "HighestTemp"

# The alert parameter whose value becomes the alert level
# (the last matching entry wins).
ALERT_LEVEL_PARAMETER = "alert_criteria"

# Temperature buckets, checked top-down, inclusive lower bounds.
WEATHER_LEVELS = [
    (36, "Extreme"),
    (32, "Hot"),
    (28, "Warm"),
]
WEATHER_LEVEL_DEFAULT = "Normal"

# An area name starts with a city of this many characters.
CITY_PREFIX_CHARS = 3

# Bronze and silver objects older than this many days are expired.
RETENTION_DAYS = 2

# Pipeline run states.
STATUS_RUNNING = "RUNNING"
STATUS_SUCCESS = "SUCCESS"
STATUS_FAILED = "FAILED"

# Staging tables whose rows may be counted per batch.
STAGING_TABLES = ("staging_forecast", "staging_alert")

# Dataset names used for bronze and silver objects.
DATASET_FORECAST = "temperature"
DATASET_ALERT = "temperature_alert"
