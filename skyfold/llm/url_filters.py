"""URL filters as a sort-merge range join (operator 1).

A host is keyed by its labels in reverse, so a rule's host and all its subdomains
are the keys that start with the rule's: one interval, and the intervals of nested
hosts nest.  Rules and urls are sorted together by key.  Sweeping in that order,
the last rule host before a url is the top of the stack of hosts opened so far;
those whose interval has ended are popped, and of the rules left on the stack the
longest one whose path the url's path starts with decides.

The sweep runs in range shards of about equal size - a host with very many urls is
spread over several - and each shard begins with the stack that the shards before
it have left.  Built of DataFrame functions only.

Defined results: a null url, or one without ``://``, has an empty host and path; a
url that no rule fits gets the default verdict and a null rule; of two fitting
rules of equal length the one with the longer host wins, of equal rules ``block``;
rules with a null host or path fit nothing; repeated rows are judged one by one;
empty tables are fine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skyfold.llm.common import stored

ALLOW, BLOCK = "allow", "block"
DEFAULT = ALLOW
#: The rules of the registered query: host, path, verdict.
RULES = [
    ("com", "/", ALLOW),
    ("example.com", "/en/", BLOCK),
    ("www.example.com", "/en/", ALLOW),
    ("net", "/es/", BLOCK),
    ("net", "/fr/", BLOCK),
]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def host_key(host: Column) -> Column:
    """Labels in reverse, each followed by a dot: ``a.example.com`` is ``com.example.a.``"""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def _stacks(rules: DataFrame) -> DataFrame:
    """``key, stack`` for each rule host: its rules and those of the hosts around it.

    A host has as many enclosing ones as labels, so they are found by an equality
    join on its prefixes.
    """
    nodes = (rules.where("host IS NOT NULL AND path IS NOT NULL")
             .select(host_key(F.col("host")).alias("key"), "host", "path", "verdict").distinct()
             .groupBy("key").agg(F.collect_list(F.struct(
                 F.length(F.concat("host", "path")).alias("size"), F.length("host").alias("host_size"),
                 "verdict", F.concat("host", "path").alias("rule"), "path", "key")).alias("own")))
    labels = F.split(F.col("key"), r"\.")
    prefixes = F.transform(F.sequence(F.lit(1), F.size(labels) - 1),
                           lambda n: F.concat(F.array_join(F.slice(labels, 1, n), "."), F.lit(".")))
    around = nodes.select("key", F.explode(prefixes).alias("prefix"))
    return (around.join(nodes.select(F.col("key").alias("prefix"), "own"), "prefix")
            .groupBy("key").agg(F.flatten(F.collect_list("own")).alias("stack")))


def judge(pages: DataFrame, rules: DataFrame, default: str = DEFAULT, id_col: str = "page_id",
          url_col: str = "url") -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every url.

    ``rules``: ``host, path, verdict``.  A row carries the rules on its stack, so
    their number per chain of nested hosts should stay moderate.
    """
    spark = pages.sparkSession
    host, path = url_parts(F.coalesce(F.col(url_col), F.lit("")))
    urls = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    urls = urls.select("page_id", "host", "path", host_key(F.col("host")).alias("key"), F.lit(1).alias("kind"))
    opens = _stacks(rules).withColumn("kind", F.lit(0))
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # the hash only spreads the urls of one host over neighbouring shards
    swept = stored(
        urls.unionByName(opens, allowMissingColumns=True)
        .repartitionByRange(shards, "key", "kind", F.xxhash64("page_id", "path"))
        .withColumn("shard", F.spark_partition_id()), "url-shards")
    # one row a shard: the stack with which it begins
    ends = swept.where("kind = 0").groupBy("shard").agg(F.max_by("stack", "key").alias("end"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    begins = spark.range(shards).select(F.col("id").cast("int").alias("shard")).join(ends, "shard", "left").select(
        "shard", F.last("end", ignorenulls=True).over(before).alias("begin"))
    sweep = Window.partitionBy("shard").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    found = (swept.withColumn("top", F.last("stack", ignorenulls=True).over(sweep)).where("kind = 1")
             .join(F.broadcast(begins), "shard", "left"))
    fits = F.filter(F.coalesce("top", "begin"),
                    lambda r: F.col("key").startswith(r.key) & F.col("path").startswith(r.path))
    best = F.array_max(fits)  # by size, size of the host, verdict
    return (found.withColumn("best", best)
            .select("page_id", "host", "path", F.col("best.rule").alias("rule"),
                    F.coalesce("best.verdict", F.lit(default)).alias("verdict")))


def keep_allowed(pages: DataFrame, rules: DataFrame, default: str = DEFAULT, id_col: str = "page_id",
                 url_col: str = "url") -> DataFrame:
    """``pages`` (all columns) whose url is allowed; ids must not repeat."""
    allowed = judge(pages, rules, default, id_col, url_col).where(F.col("verdict") == ALLOW)
    return pages.join(allowed.select(F.col("page_id").alias(id_col)), id_col, "left_semi").select(pages.columns)


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(rules, "host string, path string, verdict string")


def query(pages: DataFrame) -> DataFrame:
    return judge(pages, rule_table(pages.sparkSession, RULES))


#: DuckDB statement with the rows of :func:`query`.
SQL = r"""
WITH rest AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r FROM pages),
part AS (
  SELECT page_id, translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rest),
rules(h, p, v) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
         ('net', '/es/', 'block'), ('net', '/fr/', 'block'))
SELECT page_id, host, path, arg_max(h || p, length(h || p)) AS rule,
       coalesce(arg_max(v, length(h || p)), 'allow') AS verdict
FROM part LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
GROUP BY page_id, host, path
"""
