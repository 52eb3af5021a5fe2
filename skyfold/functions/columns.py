"""Scalar column expressions used by the models and the flatten step.

Each function maps ``Column`` -> ``Column`` and stays inside whole-stage
codegen; none of them calls back into Python per row.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from skyfold.constants import (
    CITY_PREFIX_CHARS,
    ELEMENT_LABELS,
    WEATHER_LEVEL_DEFAULT,
    WEATHER_LEVELS,
)

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def weather_date(start_time: ColumnOrName) -> Column:
    """Calendar date of a wall-clock (``TIMESTAMP_NTZ``) start time."""
    return F.to_date(_col(start_time))


def city_of(area: ColumnOrName) -> Column:
    """The city prefix of an area name (characters, not bytes)."""
    return F.substring(_col(area), 1, CITY_PREFIX_CHARS)


def district_of(area: ColumnOrName) -> Column:
    """Everything after the city prefix; ``''`` for a bare city, NULL for NULL."""
    return F.substr(_col(area), F.lit(CITY_PREFIX_CHARS + 1))


def surrogate_key(*parts: ColumnOrName) -> Column:
    """32-hex md5 of the concatenated parts; NULL if any part is NULL."""
    return F.md5(F.concat(*[_col(p) for p in parts]))


def weather_level(temp: ColumnOrName) -> Column:
    """Bucket a temperature: top-down thresholds, else the default label.

    A NULL temperature falls through to the default, like SQL ``ELSE``.
    """
    c = _col(temp)
    (first_bound, first_label), *rest = WEATHER_LEVELS
    expr = F.when(c >= first_bound, first_label)
    for bound, label in rest:
        expr = expr.when(c >= bound, label)
    return expr.otherwise(WEATHER_LEVEL_DEFAULT)


def weather_level_sql(temp_sql: str) -> str:
    """The same bucketing as a SQL ``CASE`` (for SQL-first callers)."""
    whens = " ".join(f"WHEN {temp_sql} >= {b} THEN '{lbl}'" for b, lbl in WEATHER_LEVELS)
    return f"CASE {whens} ELSE '{WEATHER_LEVEL_DEFAULT}' END"


def element_label(code: ColumnOrName) -> Column:
    """Label of a kept element code; NULL for every other code."""
    c = _col(code)
    (k0, v0), *rest = ELEMENT_LABELS.items()
    expr = F.when(c == k0, v0)
    for k, v in rest:
        expr = expr.when(c == k, v)
    return expr


def last_match(entries: ColumnOrName, name_field: str, value_field: str,
               name: str) -> Column:
    """Value of the *last* ``{name_field: name}`` entry of an array of structs.

    NULL when no entry matches or the array is NULL (``try_element_at`` does
    not raise on an empty filter result).
    """
    matches = F.filter(_col(entries), lambda e: e[name_field] == F.lit(name))
    return F.try_element_at(matches, F.lit(-1))[value_field]


def non_null_elements(arr: ColumnOrName) -> Column:
    """The array without its NULL elements."""
    return F.filter(_col(arr), lambda e: e.isNotNull())


def to_batch_id(batch_time: ColumnOrName) -> Column:
    """Folder-safe batch id, e.g. ``20260603T203000Z`` (no colons in paths); a stamp
    with a fraction keeps it: ``20260603T203000.000042Z``."""
    c = _col(batch_time)
    fraction = F.date_format(c, ".SSSSSS")
    return F.concat(F.date_format(c, "yyyyMMdd'T'HHmmss"),
                    F.when(fraction == ".000000", "").otherwise(fraction), F.lit("Z"))


def batch_timestamp(batch_id: ColumnOrName) -> Column:
    """The stamp of a batch id, with or without a fraction; NULL if it is none."""
    c = _col(batch_id)
    return F.coalesce(F.try_to_timestamp(c, F.lit("yyyyMMdd'T'HHmmss'Z'")),
                      F.try_to_timestamp(c, F.lit("yyyyMMdd'T'HHmmss.SSSSSS'Z'")))


def batch_id_of(stamp: dt.datetime) -> str:
    """:func:`to_batch_id` of one Python stamp (naive stamps are UTC)."""
    utc = stamp.astimezone(dt.timezone.utc) if stamp.tzinfo else stamp
    return utc.strftime("%Y%m%dT%H%M%S.%fZ" if utc.microsecond else "%Y%m%dT%H%M%SZ")


# A bronze/silver object name carries its batch either as an ISO timestamp
# (``..._2026-06-03T20:30:00+00:00.json``) or as a batch folder
# (``.../batch_id=20260603T203000Z/...``).
_ISO_IN_NAME = r"_([0-9]{4}-[0-9]{2}-[0-9]{2}T[^/]*)[.](json|parquet)$"
_BATCH_FOLDER = r"batch_id=([0-9]{8}T[0-9]{6}(?:[.][0-9]{6})?Z)"


def object_timestamp(path: ColumnOrName) -> Column:
    """Batch timestamp parsed from an object name; NULL if it carries none.

    Handles fractions of a second and zone offsets; a name that does not
    parse is reported as NULL (and must never be deleted).
    """
    p = _col(path)
    iso = F.regexp_extract(p, _ISO_IN_NAME, 1)
    folder = F.regexp_extract(p, _BATCH_FOLDER, 1)
    from_iso = F.try_to_timestamp(F.nullif(iso, F.lit("")))
    return F.coalesce(from_iso, batch_timestamp(F.nullif(folder, F.lit(""))))
