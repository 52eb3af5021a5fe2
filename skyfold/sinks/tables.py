"""Path-based table writes under the shared folder.

Tables are parquet folders partitioned by ``batch_id``; no catalog or
metastore is needed, and every write goes through Spark's commit protocol,
so a lost executor only retries tasks and a rerun of a job is idempotent
(except the append publish, which duplicates by design).  The landing and
silver layers are such folders; the layers behind them change by commit
records (:mod:`skyfold.sinks.snapshots`).
"""

from __future__ import annotations

import functools
import os
from collections.abc import Iterable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def clustered(df: DataFrame, *by: str) -> DataFrame:
    """One shuffle that gathers each batch's rows into few files.

    The ``rebalance`` hint relies on AQE to split a hot batch over several tasks;
    with AQE off it would put each batch into one task, so rows then stay where
    they are (more, smaller files).
    """
    aqe = df.sparkSession.conf.get("spark.sql.adaptive.enabled", "true").lower() == "true"
    return df.hint("rebalance", *(by or ("batch_id",))) if aqe else df


def land_documents(docs: DataFrame, path: str) -> list[str]:
    """K1: land raw JSON text, one document per line, one folder per batch.

    Batches present in ``docs`` replace earlier landings of the same batch;
    other batches are left alone (dynamic partition overwrite).  Returns the
    batches present, observed during the write.
    """
    obs = Observation("landed")
    observed = docs.select("batch_id", "body").observe(obs, F.collect_set("batch_id").alias("ids"))
    (clustered(observed).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy("batch_id").text(path))
    return sorted(_observed(obs).get("ids") or [])


def write_partitioned(df: DataFrame, path: str, cluster: bool = True,
                      max_records_per_file: int | None = None) -> None:
    """Replace, per ``batch_id`` present in ``df``, that batch's parquet folder.

    With ``cluster`` the ``rebalance`` hint gathers each batch's rows into few
    files (AQE splits an oversized, skewed batch over several tasks and merges
    small ones).  That is one shuffle of the written rows, worth it when a
    write spans many batches; a single-batch write skips it (every task then
    writes one file into the one folder).  ``max_records_per_file`` caps the
    rows per output file (K10, chunked insert).
    """
    out = clustered(df) if cluster else df
    writer = out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.partitionBy("batch_id").parquet(path)


def replace_batches(df: DataFrame, path: str, batch_ids: list[str]) -> int:
    """Every batch of ``batch_ids`` ends up holding exactly its rows of ``df``; a listed
    batch without rows is emptied.  Returns the number of rows written.

    ``df`` holds rows of the listed batches only.  Rows and the batches present
    (one id per batch) are observed during the write, so no extra pass over
    ``df`` is needed.
    """
    obs = Observation("batches")
    write_partitioned(df.observe(obs, F.collect_set("batch_id").alias("ids"),
                                 F.count(F.lit(1)).alias("rows")), path,
                      cluster=len(batch_ids) > 1)
    seen = _observed(obs)
    present = set(seen.get("ids") or [])
    # emptied by the file system, no Spark job: the folder stays, so the batch is known
    spark = df.sparkSession
    for b in batch_ids:
        if b not in present:
            fs, folder = file_system(spark, f"{path}/batch_id={b}")
            for status in fs.listStatus(folder) if fs.exists(folder) else []:
                fs.delete(status.getPath(), True)
            fs.mkdirs(folder)
    return int(seen.get("rows") or 0)


def _observed(obs: Observation) -> dict:
    """Metrics observed during a finished write.  When the written frame had no
    rows at all, Spark reports an empty metrics row, which PySpark cannot
    convert: that case means nothing was written."""
    try:
        return obs.get
    except Py4JJavaError:
        return {}


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system and path object of ``path``.

    On a local disk the one below the checksum layer: that layer can't name the
    checksum files of objects with a colon in their name, such as a time stamp.
    """
    hadoop = _hadoop(spark.sparkContext)
    p = hadoop.path(path)
    scheme = p.toUri().getScheme()
    fs = hadoop.systems.get(scheme) if scheme in (None, "file") else None  # others differ by host
    if fs is None:
        fs = p.getFileSystem(hadoop.conf)
        if fs.getUri().getScheme() == "file":
            fs = hadoop.local
        if scheme in (None, "file"):
            hadoop.systems[scheme] = fs
    return fs, fs.makeQualified(p)


class _Hadoop:
    """Classes and objects of the JVM that are looked up once (each part of a class name is
    a call to the JVM)."""

    def __init__(self, sc) -> None:
        fs = sc._jvm.org.apache.hadoop.fs
        self.path, self.conf = fs.Path, sc._jsc.hadoopConfiguration()
        self.local = fs.FileSystem.getLocal(self.conf).getRaw()
        self.systems: dict = {}


@functools.lru_cache(maxsize=4)
def _hadoop(sc) -> _Hadoop:
    return _Hadoop(sc)


def names_in(spark: SparkSession, folder: str, prefix: str = "", not_empty: bool = False) -> list[str]:
    """Names right below a folder, hidden ones too (``not_empty``: without objects of no
    length); none if there is no folder.

    A local disk is listed by Python, which shares it with Spark's driver.
    """
    fs, p = file_system(spark, folder)
    if fs.getUri().getScheme() == "file":
        local = p.toUri().getPath()
        names = os.listdir(local) if os.path.isdir(local) else []
        return [n for n in names if n.startswith(prefix) and not (not_empty and not os.path.getsize(f"{local}/{n}"))]
    found = fs.listStatus(p) if fs.exists(p) else []
    names = [s.getPath().getName() for s in found if not (not_empty and not s.getLen())]
    return [n for n in names if n.startswith(prefix)]


def touch(spark: SparkSession, folder: str, names: Iterable[str]) -> None:
    """Objects of these names that hold a line end, as a landing leaves them that names
    each object by its stamp."""
    fs, top = file_system(spark, folder)
    for name in names:
        _, p = file_system(spark, f"{top.toString()}/{name}")
        out = fs.create(p)
        out.write(10)
        out.close()


def landed_batches(spark: SparkSession, path: str) -> list[str]:
    """Ids of the ``batch_id=...`` folders below ``path`` (their names only; a batch
    without rows counts), in order; empty if nothing was landed."""
    return sorted(n.removeprefix("batch_id=") for n in names_in(spark, path, "batch_id="))


def drop_folder(spark: SparkSession, path: str) -> None:
    """Remove a working folder."""
    fs, p = file_system(spark, path)
    fs.delete(p, True)


def replace_batch(df: DataFrame, path: str, batch_id: str) -> None:
    """K3: static replace of one batch: the folder ends up holding exactly ``df``.

    Unlike the dynamic overwrite, an empty ``df`` empties the batch.
    """
    df.drop("batch_id").write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def publish_append(df: DataFrame, path: str) -> int:
    """K5 / A5: append to a published table; returns the row count observed during
    the write (no second scan).  A rerun appends the rows again."""
    obs = Observation("published")
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    clustered(observed).write.mode("append").partitionBy("batch_id").parquet(path)
    return int(_observed(obs).get("rows") or 0)


def overwrite_table(df: DataFrame, path: str) -> None:
    """K8: full rebuild of a (dimension/fact) table."""
    df.write.mode("overwrite").parquet(path)


def append_rows(df: DataFrame, path: str) -> None:
    """K9: append rows (incremental models)."""
    df.write.mode("append").parquet(path)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None,
               partitioned: bool = False) -> DataFrame:
    """Read a table written above (``batch_id`` as string partition column)."""
    reader = spark.read
    if schema is not None:
        fields = list(schema.fields)
        if partitioned and "batch_id" not in schema.fieldNames():
            fields.append(T.StructField("batch_id", T.StringType()))
        reader = reader.schema(T.StructType(fields))
    return reader.parquet(path)
