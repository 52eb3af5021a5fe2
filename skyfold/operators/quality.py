"""Data tests: not_null, unique, orphan (foreign key) checks.

Each test result is a small frame ``(model, column_name, n_rows, n_failing,
status)``; several columns of one model are checked in a single pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyfold.operators.joins import join_dimension

RESULT_COLUMNS = ("model", "column_name", "test", "n_rows", "n_failing", "status")


def _result(df: DataFrame) -> DataFrame:
    return df.withColumn("status", F.when(F.col("n_failing") == 0, "pass").otherwise("fail")
                         ).select(*RESULT_COLUMNS)


def not_null(df: DataFrame, model: str, columns: list[str]) -> DataFrame:
    """Q1: NULL counts of ``columns`` in one aggregate pass, one result row per column."""
    agg = df.agg(F.count(F.lit(1)).alias("__rows"),
                 *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    # one aggregate row -> one row per column (no re-evaluation per column)
    per_column = agg.unpivot("__rows", list(columns), "column_name", "n_failing")
    return _result(per_column.select(
        F.lit(model).alias("model"), "column_name", F.lit("not_null").alias("test"),
        F.col("__rows").alias("n_rows"), "n_failing"))


def not_null_merged(parts: DataFrame, model: str, columns: list[str], rows: str = "n_rows") -> DataFrame:
    """Q1 from kept counts: ``parts`` has one row per distinct value of ``columns`` (and
    whatever else keeps parts apart) with the number of rows it stands for, so a run
    tests the whole history without reading it."""
    agg = parts.agg(F.coalesce(F.sum(rows), F.lit(0)).alias("__rows"), *[
        F.coalesce(F.sum(F.when(F.col(c).isNull(), F.col(rows))), F.lit(0)).alias(c) for c in columns])
    per_column = agg.unpivot("__rows", list(columns), "column_name", "n_failing")
    return _result(per_column.select(
        F.lit(model).alias("model"), "column_name", F.lit("not_null").alias("test"),
        F.col("__rows").alias("n_rows"), "n_failing"))


def unique(df: DataFrame, model: str, column: str) -> DataFrame:
    """Q2: number of non-NULL values occurring more than once (NULLs are not
    counted, as in a ``unique`` data test)."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(
        F.count(F.lit(1)).alias("n"))
    agg = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n_rows"),
                     F.count_if(F.col("n") > 1).alias("n_failing"))
    return _result(agg.select(F.lit(model).alias("model"), F.lit(column).alias("column_name"),
                              F.lit("unique").alias("test"), "n_rows", "n_failing"))


def orphans(fact: DataFrame, model: str,
            references: list[tuple[str, DataFrame, str]]) -> DataFrame:
    """Q5: per ``(fk, dimension, pk)`` the fact rows whose non-NULL ``fk`` has no ``pk``
    in the dimension.

    The fact is read once: a left join with the distinct keys of each dimension
    and one aggregate with a count per reference.
    """
    counts = []
    for i, (fk, dim, pk) in enumerate(references):
        keys = dim.select(F.col(pk).alias(f"__pk{i}")).where(F.col(f"__pk{i}").isNotNull()).distinct()
        fact = join_dimension(fact, keys, F.col(fk) == F.col(f"__pk{i}"), "left")
        counts.append(F.count_if(F.col(fk).isNotNull() & F.col(f"__pk{i}").isNull()).alias(fk))
    agg = fact.agg(F.count(F.lit(1)).alias("__rows"), *counts)
    per_key = agg.unpivot("__rows", [fk for fk, _, _ in references], "column_name", "n_failing")
    return _result(per_key.select(
        F.lit(model).alias("model"), "column_name", F.lit("relationships").alias("test"),
        F.col("__rows").alias("n_rows"), "n_failing"))


class DataTestFailure(AssertionError):
    """Raised when a data test fails inside a job."""


def assert_passed(results: DataFrame) -> None:
    """Fail the job if any test failed (results are a handful of rows)."""
    failed = results.where(F.col("status") == "fail").collect()
    if failed:
        raise DataTestFailure("; ".join(
            f"{r.model}.{r.column_name} {r.test}: {r.n_failing} failing" for r in failed))
