"""The corpus pipeline: five stages over ``documents``, each on all that the one
before it kept.

A stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; it is written as
Parquet and read again as the next stage's ``docs``.  All stages but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyfold.llm import decontaminate, language_id, piece_bpe, secrets, simhash
from skyfold.llm.queries import model_path
from skyfold.session import workspace
from skyfold.sources.tables import read_table


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of no known language go."""
    return language_id.keep_known(docs, language_id.train(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    return simhash.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out; documents that are mostly such passages go."""
    return decontaminate.clean(docs, read_table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked."""
    return secrets.redact(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of the whole texts, and whether they decode to them (a text's own blank
    marks come back as blanks)."""
    found = piece_bpe.encode(docs, model_path(), others=("lang", "source"))
    return found.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids",
                        F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language ID", known_language),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontaminated),
    ("secret scans", without_secrets),
    ("SentencePiece encoding and decoding", tokens),
]

#: SQL can't express string kernels, fingerprints or the encoding; the stages are
#: tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what lies between them goes to the shared folder."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = workspace(spark, f"pipeline-{name.split()[0].lower()}")
        out = stage(spark, docs, sf_dir)
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
