"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from skyfold.session import workspace

#: The white space of the contracts' word pattern ``[^\x20\x09-\x0D]+``.  ``bytes.split()``
#: splits at exactly these bytes, so words of UTF-8 text are ``text.encode().split()``.
WHITE_SPACE = " \t\n\x0b\x0c\r"
#: ``bytes.translate`` table: A-Z to lower case, all else as it is.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def stored(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` below the shared folder and read it back.

    Cuts the lineage: what follows reads files that every executor can see, so
    a lost executor costs its running tasks only.
    """
    spark = df.sparkSession
    path = workspace(spark, f"llm-{name}")
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def freed(*tables: DataFrame) -> None:
    """Delete the files of ``stored`` tables that nothing reads any more."""
    for df in tables:
        context = df.sparkSession.sparkContext
        for folder in {file.rpartition("/")[0] for file in df.inputFiles()}:
            path = context._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def slices(batches: Iterable[pa.RecordBatch], text_at: int, max_rows: int = 4_000,
           max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The rows of Arrow batches in slices of bounded text (one row at least, whole texts)."""
    for batch in batches:
        lengths = pc.binary_length(batch.column(text_at)).to_pylist()
        a = total = 0
        for i, size in enumerate(lengths):
            size = size or 0
            if i > a and (total + size > max_bytes or i - a == max_rows):
                yield batch.slice(a, i - a)
                a, total = i, 0
            total += size
        if a < batch.num_rows:
            yield batch.slice(a)
