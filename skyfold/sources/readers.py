"""Readers for every layer: raw JSON, silver parquet, staging batches, seed,
object listings, ad-hoc SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyfold.sources import schemas as S


def parse_documents(texts: DataFrame, schema: T.StructType, text_col: str = "body",
                    out_col: str = "doc") -> DataFrame:
    """Parse stored JSON text with an explicit schema (FAILFAST on broken JSON)."""
    carry = [c for c in texts.columns if c != text_col]
    return texts.select(*carry, F.from_json(F.col(text_col), schema,
                                            {"mode": "FAILFAST"}).alias(out_col))


def read_bronze(spark: SparkSession, path: str | list[str], schema: T.StructType,
                multi_line: bool = False, base: str | None = None) -> DataFrame:
    """Read raw JSON documents with an explicit schema.

    JSON Lines (one document per line) is splittable and is what the landing
    step writes; ``multi_line=True`` reads pretty-printed single-document
    files as delivered by an API (one task per file).  Partition folders
    such as ``batch_id=...`` become columns (of single files, those below
    ``base``).  Output: partition columns + doc.
    """
    reader = spark.read.schema(schema).option("mode", "FAILFAST").option("multiLine", multi_line)
    raw = (reader.option("basePath", base) if base else reader).json(path)
    parts = [c for c in raw.columns if c not in schema.fieldNames()]
    return raw.select(*parts, F.struct(*[F.col(c) for c in schema.fieldNames()]).alias("doc"))


def read_silver(spark: SparkSession, path: str, schema: T.StructType,
                batch_id: str | None = None) -> DataFrame:
    """Read silver parquet (a file or a folder: all files are read).

    With ``batch_id`` the partition filter prunes every other batch folder.
    """
    df = spark.read.schema(
        T.StructType(schema.fields + [T.StructField("batch_id", T.StringType())])).parquet(path)
    return df if batch_id is None else df.where(F.col("batch_id") == F.lit(batch_id))


def scan_batch(table: DataFrame, batch_id, columns: list[str] | tuple[str, ...]) -> DataFrame:
    """Rows of one batch with a fixed column list.

    ``batch_id`` (a value or a scalar column) filters the partition column, so
    every other batch folder is pruned.
    """
    return table.where(F.col("batch_id") == batch_id).select(*columns)


def sql_query(spark: SparkSession, query: str, **params) -> DataFrame:
    """Ad-hoc SQL with bound (named) parameters, e.g. ``:threshold``."""
    return spark.sql(query, args=params or None)


def list_objects(spark: SparkSession, root: str, prefix: str | None = None) -> DataFrame:
    """Every file below ``root`` (path, modificationTime, length); content pruned.

    ``prefix`` is matched against the names right below ``root`` and is part of
    the load path, so other folders are not listed at all.  ``root`` may be
    given with or without a scheme.  No matching file gives an empty result.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    top = jvm.org.apache.hadoop.fs.Path(root)
    fs = top.getFileSystem(conf)
    path = fs.makeQualified(top).toString().rstrip("/")
    if prefix:
        path = f"{path}/{prefix}*"
        if not fs.globStatus(jvm.org.apache.hadoop.fs.Path(path)):
            return spark.createDataFrame([], "path string, modificationTime timestamp, length long")
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
            .load(path).select("path", "modificationTime", "length"))


# The city reference seed (20 rows, header first).
CITY_REFERENCE_CSV = """\
city_id,city_name,country,latitude,longitude,timezone,is_active
1,Taipei,TW,25.0330,121.5654,Asia/Taipei,1
2,New Taipei,TW,25.0169,121.4628,Asia/Taipei,1
3,Taichung,TW,24.1477,120.6736,Asia/Taipei,1
4,Tainan,TW,22.9997,120.2270,Asia/Taipei,1
5,Kaohsiung,TW,22.6273,120.3014,Asia/Taipei,1
6,Hsinchu,TW,24.8138,120.9675,Asia/Taipei,1
7,Tokyo,JP,35.6762,139.6503,Asia/Tokyo,1
8,Osaka,JP,34.6937,135.5023,Asia/Tokyo,1
9,Kyoto,JP,35.0116,135.7681,Asia/Tokyo,1
10,Yokohama,JP,35.4437,139.6380,Asia/Tokyo,1
11,Nagoya,JP,35.1815,136.9066,Asia/Tokyo,1
12,Fukuoka,JP,33.5904,130.4017,Asia/Tokyo,1
13,Seoul,KR,37.5665,126.9780,Asia/Seoul,1
14,Busan,KR,35.1796,129.0756,Asia/Seoul,1
15,Incheon,KR,37.4563,126.7052,Asia/Seoul,1
16,Singapore,SG,1.3521,103.8198,Asia/Singapore,1
17,Bangkok,TH,13.7563,100.5018,Asia/Bangkok,1
18,Kuala Lumpur,MY,3.1390,101.6869,Asia/Kuala_Lumpur,1
19,Jakarta,ID,-6.2088,106.8456,Asia/Jakarta,1
20,Manila,PH,14.5995,120.9842,Asia/Manila,1
"""


def read_seed(spark: SparkSession, path: str | None = None) -> DataFrame:
    """The city reference seed: a CSV at ``path`` (shared storage), or the
    bundled 20 rows when no path is given."""
    if path:
        return spark.read.csv(path, header=True, schema=S.CITY_REFERENCE, mode="FAILFAST")
    lines = CITY_REFERENCE_CSV.strip().splitlines()[1:]
    rows = []
    for ln in lines:
        cid, name, country, lat, lon, tz, active = ln.split(",")
        rows.append((int(cid), name, country, float(lat), float(lon), tz, int(active)))
    return spark.createDataFrame(rows, S.CITY_REFERENCE)


def active_cities(seed: DataFrame) -> DataFrame:
    """Coordinates of the active reference cities."""
    return seed.where(F.col("is_active") == 1).select("latitude", "longitude")
