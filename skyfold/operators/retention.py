"""Retention: expire bronze/silver objects older than the retention window.

The object's batch time is parsed from its name (never from file times).
A name that does not parse is reported and kept.  The cut-off is strict:
an object exactly ``RETENTION_DAYS`` old is kept.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from itertools import islice

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyfold.constants import RETENTION_DAYS
from skyfold.functions.columns import object_timestamp
from skyfold.sinks.tables import file_system


def cutoff(as_of: Column, days: int = RETENTION_DAYS) -> Column:
    return as_of - F.make_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(days))


def with_object_ts(objects: DataFrame, name_col: str = "path") -> DataFrame:
    return objects.withColumn("object_ts", object_timestamp(F.col(name_col)))


def expired(objects: DataFrame, as_of: Column | dt.datetime, name_col: str = "path",
            days: int = RETENTION_DAYS) -> DataFrame:
    """Objects whose parsed batch time is before ``as_of - days``."""
    now = F.lit(as_of).cast("timestamp") if isinstance(as_of, dt.datetime) else as_of
    return with_object_ts(objects, name_col).where(F.col("object_ts") < cutoff(now, days))


def kept(objects: DataFrame, as_of: Column | dt.datetime, name_col: str = "path",
         days: int = RETENTION_DAYS) -> DataFrame:
    """The complement of :func:`expired`: recent objects and unparseable names."""
    now = F.lit(as_of).cast("timestamp") if isinstance(as_of, dt.datetime) else as_of
    t = with_object_ts(objects, name_col)
    return t.where(F.col("object_ts").isNull() | (F.col("object_ts") >= cutoff(now, days)))


def delete_units(listing: DataFrame, as_of: dt.datetime, days: int = RETENTION_DAYS) -> DataFrame:
    """What a cleanup has to look at, one row each: ``unit``, ``expired``, ``n_objects``.

    A unit is what is deleted as a whole: a ``batch_id=...`` folder, or an object
    outside of one.  Objects without a timestamp are never expired.
    """
    folder = F.regexp_extract("path", r"^(.*/batch_id=[^/]+)/", 1)
    now = F.lit(as_of).cast("timestamp")
    flagged = with_object_ts(listing, "path").select(
        F.coalesce(F.nullif(folder, F.lit("")), F.col("path")).alias("unit"),
        (F.col("object_ts") < cutoff(now, days)).alias("expired"))
    return (flagged.where(F.col("expired") | F.col("expired").isNull())
            .groupBy("unit", "expired").agg(F.count(F.lit(1)).alias("n_objects")))


def delete_paths(spark: SparkSession, paths: Iterable[str], threads: int = 16) -> Iterator[str]:
    """Delete paths and give back those that are really gone.

    ``paths`` may be a stream; a bounded number of deletes runs at a time through
    the Hadoop file system of each path, so any storage Spark can write to works.
    """
    def drop(path: str) -> str | None:
        fs, p = file_system(spark, path)
        return path if fs.delete(p, True) and not fs.exists(p) else None

    it = iter(paths)
    with ThreadPoolExecutor(max_workers=threads) as pool:
        while chunk := list(islice(it, 16 * threads)):
            yield from (p for p in pool.map(drop, chunk) if p)
