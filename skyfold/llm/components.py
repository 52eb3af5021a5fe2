"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyfold.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is hung below the node's smallest neighbour."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    return (both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u != v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, is hung below the smallest."""
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    return (edges.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
            .union(low.select("u", F.col("m").alias("v"))).distinct())


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``(u, v)`` with u the node and v the smallest node of its component.

    ``edges`` has two columns ``u, v`` of one type, in any direction and with
    repeats.  Nodes that are the smallest of their component have no row.  A hub
    is never gathered: a step is a partial minimum and a join that adaptive
    execution can split.  Each round is written to the shared folder; the number
    of rounds grows with the logarithm of a component's size.
    """
    edges = stored(edges.where("u != v").select(F.greatest("u", "v").alias("u"),
                                                F.least("u", "v").alias("v")).distinct(), name)
    seen = None
    while True:
        mark = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("h")).first()
        if not mark.n or mark == seen:
            return edges
        seen = mark
        edges = stored(_small_star(_large_star(edges)), name)
