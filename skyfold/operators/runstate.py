"""Pipeline run state: update, fold of an update log, lookup, row counts.

The state table has one row per known pipeline.  An update sets the
status, keeps the old ``row_count`` / ``last_processed_at`` when the update
carries none (``COALESCE``), stamps ``last_run_at`` only when the status is
RUNNING, and always stamps ``updated_at``.  Updates of unknown pipelines
are ignored (no row to update).

At scale the state is not updated row by row: a log of updates is folded
per pipeline with ordered aggregates (``max_by ... FILTER``), which
aggregate partially on the map side, so a hot pipeline is cheap.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyfold.constants import STAGING_TABLES, STATUS_FAILED, STATUS_RUNNING, STATUS_SUCCESS
from skyfold.operators.joins import join_dimension

STATE_COLUMNS = ("pipeline_name", "status", "row_count", "last_processed_at", "last_run_at",
                 "created_at", "updated_at")

# Statuses travel through aggregates as small int codes: every aggregation
# buffer stays fixed-width, so Spark can use hash (not sort) aggregation.
_STATUSES = (STATUS_RUNNING, STATUS_SUCCESS, STATUS_FAILED)


def status_code(status: Column) -> Column:
    expr = F.when(status == _STATUSES[0], F.lit(1))
    for i, s in enumerate(_STATUSES[1:], start=2):
        expr = expr.when(status == s, F.lit(i))
    return expr


def status_name(code: Column) -> Column:
    expr = F.when(code == 1, F.lit(_STATUSES[0]))
    for i, s in enumerate(_STATUSES[1:], start=2):
        expr = expr.when(code == i, F.lit(s))
    return expr


def apply_update(state: DataFrame, updates: DataFrame) -> DataFrame:
    """Apply at most one update per pipeline (``pipeline_name, status,
    row_count, last_processed_at, ts``) to the state.

    Pipelines without an update keep their row; updates of unknown
    pipelines are dropped.
    """
    u = updates.select(F.col("pipeline_name").alias("__name"), F.col("status").alias("__status"),
                       F.col("row_count").alias("__rows"),
                       F.col("last_processed_at").alias("__lpa"), F.col("ts").alias("__ts"))
    j = state.join(u, state.pipeline_name == u.__name, "left")
    has = F.col("__name").isNotNull()
    return j.select(
        "pipeline_name",
        F.when(has, F.col("__status")).otherwise(F.col("status")).alias("status"),
        F.coalesce(F.col("__rows"), F.col("row_count")).alias("row_count"),
        F.coalesce(F.col("__lpa"), F.col("last_processed_at")).alias("last_processed_at"),
        F.when(has & (F.col("__status") == STATUS_RUNNING), F.col("__ts"))
         .otherwise(F.col("last_run_at")).alias("last_run_at"),
        "created_at",
        F.when(has, F.col("__ts")).otherwise(F.col("updated_at")).alias("updated_at"),
    )


def fold_updates(state: DataFrame, log: DataFrame) -> DataFrame:
    """Q6 at scale: apply a whole update log (``pipeline_name, seq, status, row_count,
    last_processed_at, ts``) in ``seq`` order; equal to applying
    :func:`apply_update` once per log row.

    ``state`` needs ``created_seq``: updates logged before the row existed
    are ignored, like updates of unknown pipelines.
    """
    known = state.select(F.col("pipeline_name").alias("__name"), "created_seq")
    live = join_dimension(log, known, log.pipeline_name == known.__name).where(F.col("seq") > F.col("created_seq"))
    seq = F.col("seq")
    live = live.withColumn("__code", status_code(F.col("status")))
    folded = live.groupBy("pipeline_name").agg(
        F.max_by("__code", seq).alias("__status"),
        F.expr("max_by(row_count, seq) FILTER (WHERE row_count IS NOT NULL)").alias("__rows"),
        F.expr("max_by(last_processed_at, seq) FILTER (WHERE last_processed_at IS NOT NULL)")
        .alias("__lpa"),
        F.expr(f"max_by(ts, seq) FILTER (WHERE status = '{STATUS_RUNNING}')").alias("__run"),
        F.max_by("ts", seq).alias("__ts"),
    )
    j = state.join(folded, "pipeline_name", "left")
    has = F.col("__ts").isNotNull()
    return j.select(
        "pipeline_name",
        F.when(has, status_name(F.col("__status"))).otherwise(F.col("status")).alias("status"),
        F.coalesce("__rows", "row_count").alias("row_count"),
        F.coalesce("__lpa", "last_processed_at").alias("last_processed_at"),
        F.coalesce("__run", "last_run_at").alias("last_run_at"),
        "created_at",
        F.when(has, F.col("__ts")).otherwise(F.col("updated_at")).alias("updated_at"),
    )


def first_updates(state: DataFrame, log: DataFrame) -> DataFrame:
    """Each known pipeline's first update after its registration (by ``seq``)."""
    known = state.select(F.col("pipeline_name").alias("__name"), "created_seq")
    live = join_dimension(log, known, log.pipeline_name == known.__name).where(F.col("seq") > F.col("created_seq"))
    seq = F.col("seq")
    first = live.groupBy("pipeline_name").agg(
        F.min_by(status_code(F.col("status")), seq).alias("__code"),
        F.min_by("row_count", seq).alias("row_count"),
        F.min_by("last_processed_at", seq).alias("last_processed_at"),
        F.min_by("ts", seq).alias("ts"))
    return first.select("pipeline_name", status_name(F.col("__code")).alias("status"),
                        "row_count", "last_processed_at", "ts")


def high_water_mark(log: DataFrame, state: DataFrame) -> DataFrame:
    """Q8: per known pipeline, the latest batch processed by a successful run."""
    known = state.select(F.col("pipeline_name").alias("__name"), "created_seq")
    ok = (join_dimension(log.where(F.col("status") == STATUS_SUCCESS), known,
                         log.pipeline_name == known.__name)
          .where(F.col("seq") > F.col("created_seq")))
    return ok.groupBy("pipeline_name").agg(F.max("last_processed_at").alias("high_water_mark"))


def lookup(state: DataFrame, names: DataFrame) -> DataFrame:
    """State (status, last_processed_at, row_count) of each requested name;
    a name without a state row yields no row."""
    wanted = names.select(F.col("pipeline_name").alias("__name")).distinct()
    return (state.join(wanted, state.pipeline_name == wanted.__name, "left_semi")
            .select("pipeline_name", "status", "last_processed_at", "row_count"))


def check_table_name(table_name: str) -> str:
    """Only the staging tables may be counted (allow-list)."""
    if table_name not in STAGING_TABLES:
        raise ValueError(f"{table_name!r} is not a staging table that may be counted")
    return table_name


def batch_row_counts(tables: dict[str, DataFrame], batch_ids: list[str] | None = None) -> DataFrame:
    """A2: ``(table_name, batch_time, row_count)`` for every batch of each table.

    With ``batch_ids`` only these batches are counted, ``(table_name, row_count)``,
    and a table without rows for them reports 0; the ids filter the partition
    column, so other batches are not read.
    """
    parts = []
    for name, df in tables.items():
        check_table_name(name)
        if batch_ids is None:
            counted = df.groupBy("batch_time").agg(F.count(F.lit(1)).alias("row_count"))
            columns = ["batch_time", "row_count"]
        else:
            counted = df.where(F.col("batch_id").isin(batch_ids)).agg(
                F.count(F.lit(1)).alias("row_count"))
            columns = ["row_count"]
        parts.append(counted.select(F.lit(name).alias("table_name"), *columns))
    return reduce(DataFrame.unionByName, parts)


def batch_row_totals(tables: dict[str, DataFrame]) -> DataFrame:
    """A3: ``(batch_time, row_count)``: rows of all staging tables per batch."""
    return (batch_row_counts(tables).groupBy("batch_time")
            .agg(F.sum("row_count").cast("long").alias("row_count")))
