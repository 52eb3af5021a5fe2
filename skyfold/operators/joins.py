"""Join operators: dimension joins sized by Catalyst/AQE, and NOT IN at scale."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def materialize(df: DataFrame, path: str) -> DataFrame:
    """Cut lineage: write ``df`` as a parquet table at ``path`` (a folder in the
    shared workspace) and read it back.  One job; counting the result later
    only reads parquet footers."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def join_dimension(fact: DataFrame, dim: DataFrame, on, how: str = "inner") -> DataFrame:
    """Join a (possibly large) fact side to a dimension.

    ``dim`` should be materialised (a written table): its size in bytes is then
    known, and Catalyst broadcasts it only below
    ``spark.sql.autoBroadcastJoinThreshold``; AQE decides again from the bytes
    really shuffled.  Anything larger is a shuffle join whose skewed keys AQE
    splits.  No hint overrides that: a row count says nothing about bytes.
    """
    return fact.join(dim, on, how)


def not_in(candidates: DataFrame, cand_key: Column | str, target: DataFrame,
           target_key: str) -> DataFrame:
    """``candidates WHERE cand_key NOT IN (SELECT target_key FROM target)``.

    SQL semantics, NULLs included:

    * empty target -> every candidate, also those with a NULL key;
    * a NULL key in the target -> no candidate at all;
    * otherwise -> candidates with a non-NULL key absent from the target.

    Spark's own null-aware anti join broadcasts the target whatever its size;
    here the two target facts (row count, NULL-key count) are one aggregate
    row, and the remaining case is a plain ``left_anti`` join that Catalyst
    may shuffle or broadcast.
    """
    key = F.col(cand_key) if isinstance(cand_key, str) else cand_key
    stats = target.agg(F.count(F.lit(1)).alias("n"),
                       F.count_if(F.col(target_key).isNull()).alias("n_null")).first()
    if stats["n"] == 0:
        return candidates
    if stats["n_null"] > 0:
        return candidates.where(F.lit(False))
    keys = target.select(F.col(target_key).alias("__key")).where(F.col("__key").isNotNull())
    return (candidates.where(key.isNotNull())
            .join(keys, key == F.col("__key"), "left_anti"))
