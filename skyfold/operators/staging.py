"""Silver text rows -> typed staging rows: rename, cast, audit, key check."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyfold.functions.columns import batch_timestamp
from skyfold.sources import schemas as S


class KeyViolation(ValueError):
    """A batch breaks its primary key (duplicate or NULL key columns)."""


def rename_standard(df: DataFrame, names: tuple[str, ...] | list[str]) -> DataFrame:
    """Positional rename of the leading columns (parity with the source
    pipeline, whose silver -> staging rename is by position)."""
    if len(df.columns) < len(names):
        raise ValueError(f"expected at least {len(names)} columns, got {df.columns}")
    return df.toDF(*names, *df.columns[len(names):])


def cast_strict(c: Column | str, to: str, label: str | None = None) -> Column:
    """Cast text to ``to``; a malformed non-NULL value fails the job.

    Independent of the session's ANSI setting: ``try_cast`` decides, and a
    failure raises inside the task (no extra pass over the data).
    """
    col = F.col(c) if isinstance(c, str) else c
    cast = col.try_cast(to)
    name = label or (c if isinstance(c, str) else "value")
    checked = F.when(col.isNotNull() & cast.isNull(),
                     F.raise_error(F.concat(F.lit(f"malformed {to} in {name}: "), col))
                     ).otherwise(cast)
    return checked.alias(name) if isinstance(c, str) or label else checked


def cast_quarantine(df: DataFrame, casts: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """P7 (quarantine): split rows into (typed good rows, rejected raw rows with a reason).

    A row is rejected when any listed column is non-NULL but does not cast.
    One pass: the flag is computed once and both outputs filter on it.
    """
    bad_checks = [F.when(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull(), F.lit(c))
                  for c, t in casts.items()]
    flagged = df.withColumn("__bad", F.concat_ws(",", *bad_checks))
    good = flagged.where(F.col("__bad") == "").drop("__bad")
    for c, t in casts.items():
        good = good.withColumn(c, F.col(c).try_cast(t))
    rejects = (flagged.where(F.col("__bad") != "")
               .withColumn("reject_reason", F.concat(F.lit("malformed: "), F.col("__bad")))
               .drop("__bad"))
    return good, rejects


def audit_columns(df: DataFrame, batch_time: Column, as_of: dt.datetime | None = None) -> DataFrame:
    """Add ``batch_time`` (the batch stamp) and ``update_time`` (load time).

    ``as_of`` fixes the load time (reproducible runs); default is now.
    """
    update = F.lit(as_of).cast("timestamp") if as_of is not None else F.current_timestamp()
    return df.withColumn("batch_time", batch_time.cast("timestamp")).withColumn("update_time", update)


def batch_time_of(batch_id: Column | str) -> Column:
    """Batch timestamp of a folder-safe batch id; an unreadable id fails the job."""
    c = F.col(batch_id) if isinstance(batch_id, str) else batch_id
    ts = batch_timestamp(c)
    return F.when(c.isNotNull() & ts.isNull(),
                  F.raise_error(F.concat(F.lit("malformed batch id: "), c))).otherwise(ts)


def forecast_to_staging(silver: DataFrame, as_of: dt.datetime | None = None) -> DataFrame:
    """Silver forecast rows (+ batch_id) -> staging_forecast rows (+ batch_id)."""
    named = rename_standard(silver.select(*S.SILVER_FORECAST.fieldNames(), "batch_id"),
                            S.STAGING_FORECAST_NAMES)
    typed = named.select(
        "city", "type",
        cast_strict("start_time", "timestamp_ntz"), cast_strict("end_time", "timestamp_ntz"),
        cast_strict("temp", "int"), "unit", "batch_id")
    return audit_columns(typed, batch_time_of("batch_id"), as_of).select(
        *S.STAGING_FORECAST.fieldNames(), "batch_id")


def alert_to_staging(silver: DataFrame, as_of: dt.datetime | None = None) -> DataFrame:
    """Silver alert rows (+ batch_id) -> staging_alert rows (+ batch_id)."""
    named = rename_standard(silver.select(*S.SILVER_ALERT.fieldNames(), "batch_id"),
                            S.STAGING_ALERT_NAMES)
    typed = named.select(
        "event", "level", "area",
        cast_strict("start_time", "timestamp_ntz"), cast_strict("end_time", "timestamp_ntz"),
        "batch_id")
    return audit_columns(typed, batch_time_of("batch_id"), as_of).select(
        *S.STAGING_ALERT.fieldNames(), "batch_id")


def key_violations(df: DataFrame, key: tuple[str, ...] | list[str]) -> DataFrame:
    """Q3 / Q4: keys that occur more than once or have a NULL part: key columns + n_rows.

    Partial aggregation runs map-side, so a hot key costs one row per task
    in the shuffle.
    """
    any_null = F.lit(False)
    for k in key:
        any_null = any_null | F.col(k).isNull()
    counted = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.where((F.col("n_rows") > 1) | any_null)


def enforce_key(df: DataFrame, key: tuple[str, ...] | list[str], sample: int = 20) -> None:
    """Abort (raise) if the batch breaks its key, naming some offending keys."""
    bad = key_violations(df, key).take(sample)
    if bad:
        shown = "; ".join(str(tuple(r)) for r in bad)
        raise KeyViolation(f"primary key {tuple(key)} violated, e.g. {shown}")


def tag_key_violations(df: DataFrame, key: tuple[str, ...] | list[str]) -> DataFrame:
    """``df`` with ``reject_reason``: NULL for rows with a clean key, else why the
    row breaks it (``null key`` or ``duplicate key``).

    The violating keys are an aggregate joined back null-safely; Catalyst/AQE
    pick the join by its size and split a hot key.
    """
    any_null = F.lit(False)
    for k in key:
        any_null = any_null | F.col(k).isNull()
    viol = key_violations(df, key).select(*[F.col(k).alias(f"__v_{k}") for k in key]
                                          ).withColumn("__viol", F.lit(True))
    cond = reduce(lambda x, y: x & y,
                  [F.col(k).eqNullSafe(F.col(f"__v_{k}")) for k in key])
    reason = F.when(F.col("__viol"), F.when(any_null, "null key").otherwise("duplicate key"))
    return df.join(viol, cond, "left").select(*df.columns, reason.alias("reject_reason"))


def split_key_violations(df: DataFrame, key: tuple[str, ...] | list[str]
                         ) -> tuple[DataFrame, DataFrame]:
    """Quarantine mode: (rows with a clean key, rows of violating keys with the reason).

    Both are lazy; a job that needs both writes :func:`tag_key_violations` once
    and filters that table.
    """
    tagged = tag_key_violations(df, key)
    good = tagged.where(F.col("reject_reason").isNull()).drop("reject_reason")
    return good, tagged.where(F.col("reject_reason").isNotNull())
