"""Secret scans over an incremental blob ledger (operator 7).

Every version of a path is addressed by the SHA-256 of its content.  The ledger
remembers which rule, in which version, has been run over which blob, and what it
found; a scan runs only the pairs the ledger lacks, each once however many paths
and versions share the blob, and joins the findings back to all of them.

Built of DataFrame functions only.  Places come from cutting the text at a rule's
matches: the lengths of what lies between the matches and of the matches
themselves, summed up, are the spans in code points.

Defined results: a null text is an empty blob; rows are scanned one by one
whatever their id (a null id stays null); matches of different rules may overlap
and are all reported; an empty table gives no rows and an empty ledger.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skyfold.llm.common import stored
from skyfold.session import workspace


@dataclass(frozen=True)
class Rule:
    """``regex`` matches leftmost and without overlap; then matches go whose group
    ``group`` has fewer than ``shortest`` characters.  A change of anything but the
    kind needs a new version."""

    kind: str
    regex: str
    group: int = 0
    shortest: int = 1
    version: int = 1

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


#: The base kinds.  A run of digits or letters that is long enough is found by the count in
#: the pattern itself: such runs are maximal, so shorter ones hide no longer ones.
BASE = (
    Rule("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 12),
    Rule("access", r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", r"[0-9a-f]{16,}"),
)
#: Further kinds: private keys, to the END line or over the base64 lines behind a header that
#: lacks one, and signed web tokens.
MORE = (
    Rule("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"
                r"(?:(?:[^-]++|-(?!----))*+-----END [A-Z ]{0,40}PRIVATE KEY-----"
                r"|(?:(?:\s|\\[nr])*+[A-Za-z0-9+/=]{40,}+)*+(?:(?:\s|\\[nr])*+[A-Za-z0-9+/]*+={1,2})?)", version=2),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
RULES = BASE + MORE
MASK = "[secret]"

SCANNED = "blob binary, seen array<string>"
FINDINGS = "blob binary, rule string, start int, end int"


def address(text: str | Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text if isinstance(text, Column) else F.col(text), F.lit("")), 256))


def _cuts(rule: Rule, text: Column) -> Column:
    """One entry per match: characters before it (from the last match), of it, and of its group."""
    hits = F.regexp_extract_all(text, F.lit(rule.regex), F.lit(0))
    kept = F.regexp_extract_all(text, F.lit(rule.regex), F.lit(rule.group)) if rule.group else hits
    gaps = F.split(text, rule.regex, -1)
    return F.zip_with(F.zip_with(gaps, hits, lambda g, h: F.struct(F.length(g).alias("gap"), F.length(h).alias("hit"))),
                      kept, lambda c, k: F.struct(c.gap.alias("gap"), c.hit.alias("hit"), F.length(k).alias("kept")))


def _found(blobs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Findings in ``blob, text, todo``: rules to run are listed in ``todo``."""
    def places(r: Rule) -> Column:
        matches = F.transform(_cuts(r, F.col("text")), lambda c, n: F.struct(
            F.lit(r.key).alias("rule"), n.alias("n"), c.gap.alias("gap"), c.hit.alias("hit"),
            (c.kept >= r.shortest).alias("ok")))
        return F.when(F.array_contains("todo", r.key) & F.col("text").rlike(r.regex), matches)

    each = blobs.select("blob", F.explode(F.array(*map(places, rules))).alias("of_rule")).where("of_rule IS NOT NULL")
    # the piece behind the last match has no match of its own
    each = each.select("blob", F.explode("of_rule").alias("m")).where("m.hit IS NOT NULL").select("blob", "m.*")
    before = Window.partitionBy("blob", "rule").orderBy("n")
    end = F.sum(F.col("gap") + F.col("hit")).over(before)
    return each.withColumn("end", end.cast("int")).where("ok").select(
        "blob", "rule", (F.col("end") - F.col("hit")).alias("start"), "end")


class Ledger:
    """Two growing tables below one folder: which rules each blob has been through,
    and the findings."""

    def __init__(self, spark, path: str):
        self.spark, self.path = spark, path
        for name, schema in (("scanned", SCANNED), ("findings", FINDINGS)):
            spark.createDataFrame([], schema).write.mode("append").parquet(f"{path}/{name}")

    def _read(self, name: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")

    def findings(self) -> DataFrame:
        return self._read("findings", FINDINGS).distinct()

    def unseen(self, blobs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
        """``blobs`` with ``todo``, the rules they lack; blobs that lack none go."""
        every = F.array(*[F.lit(r.key) for r in rules])
        seen = self._read("scanned", SCANNED)
        if not seen.limit(1).count():
            return blobs.withColumn("todo", every)
        seen = seen.groupBy("blob").agg(F.flatten(F.collect_set("seen")).alias("seen"))
        return (blobs.join(seen, "blob", "left")
                .withColumn("todo", F.array_except(every, F.coalesce("seen", F.array().cast("array<string>"))))
                .drop("seen").where(F.size("todo") > 0))

    def scan(self, versions: DataFrame, paths: DataFrame, rules: tuple[Rule, ...]) -> None:
        """Run what is missing over the contents of ``versions`` (``path, text``).

        The text of a blob is taken from one version that has it.  The findings are
        written before the mark that the pairs are done: a run that ends in between
        scans them again, and equal findings count once.
        """
        blobs = paths.groupBy("blob").agg(F.min("path").alias("path"))
        todo = stored(self.unseen(blobs, rules), "secrets-todo")
        source = versions.select("path", "text", address("text").alias("blob"))
        text = (source.join(todo.hint("shuffle_hash"), (source.blob == todo.blob) & source.path.eqNullSafe(todo.path))
                .select(source.blob, F.coalesce("text", F.lit("")).alias("text"), "todo"))
        _found(text, rules).distinct().write.mode("append").parquet(f"{self.path}/findings")
        todo.select("blob", F.col("todo").alias("seen")).write.mode("append").parquet(f"{self.path}/scanned")


def scan(versions: DataFrame, ledger: Ledger | None = None, rules: tuple[Rule, ...] = RULES,
         path_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Bring the ledger up to date with ``versions`` and return

    * ``path, blob``: a row for each version of a path, and
    * ``blob, spans``: for blobs with findings the spans by start, then by the order
      of the rules, as ``(start, nth rule, end, kind)``.
    """
    spark = versions.sparkSession
    ledger = ledger or Ledger(spark, workspace(spark, "llm-secrets-ledger"))
    head = versions.select(F.col(path_col).alias("path"), F.col(text_col).alias("text"))
    paths = stored(head.select("path", address("text").alias("blob")), "secrets-paths")
    ledger.scan(head, paths, rules)
    order = F.create_map(*[F.lit(x) for i, r in enumerate(rules) for x in (r.key, i)])
    kind = F.substring_index("rule", "@", 1)
    found = ledger.findings().where(F.col("rule").isin([r.key for r in rules]))
    spans = found.groupBy("blob").agg(F.sort_array(F.collect_list(F.struct(
        "start", order[F.col("rule")].alias("nth"), "end", kind.alias("kind")))).alias("spans"))
    return paths, stored(spans, "secrets-spans")


def redact(docs: DataFrame, ledger: Ledger | None = None, rules: tuple[Rule, ...] = RULES,
           text_col: str = "text", path_col: str = "doc_id", length_col: str = "n_chars",
           mask: str = MASK) -> DataFrame:
    """``docs`` (all columns) with every span of a finding replaced by ``mask``;
    overlapping spans become one.  ``length_col``, if there is one, follows."""
    _, spans = scan(docs, ledger, rules, path_col, text_col)
    each = spans.select("blob", F.explode("spans").alias("s")).select("blob", "s.start", "s.end")
    earlier = Window.partitionBy("blob").orderBy("start", "end")
    each = each.withColumn("reach", F.max("end").over(earlier.rowsBetween(Window.unboundedPreceding, -1)))
    each = each.withColumn("part", F.sum(F.when(F.col("start") > F.coalesce("reach", F.lit(-1)), 1).otherwise(0)).over(earlier))
    whole = each.groupBy("blob", "part").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    whole = whole.groupBy("blob").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("cuts"))
    text, cuts = F.col(f"d.`{text_col}`"), F.col("w.cuts")
    # what lies before each cut, and behind the last
    before = F.transform(cuts, lambda c, i: text.substr(
        F.when(i > 0, F.get(cuts, i - 1).end).otherwise(0) + 1,
        c.start - F.when(i > 0, F.get(cuts, i - 1).end).otherwise(0)))
    rest = text.substr(F.element_at(cuts, -1).end + 1, F.length(text))
    new = F.when(cuts.isNotNull(), F.concat(F.array_join(before, mask), F.lit(mask), rest)).otherwise(text)
    d = docs.withColumn("__blob", address(text_col)).alias("d")
    joined = d.join(stored(whole, "secrets-cuts").withColumnRenamed("blob", "__blob").alias("w"), "__blob", "left")
    out = joined.select(*[(new if c == text_col else F.col(f"d.`{c}`")).alias(c) for c in docs.columns])
    if length_col in docs.columns:
        out = out.withColumn(length_col, F.length(text_col).cast(docs.schema[length_col].dataType))
    return out


def query(docs: DataFrame) -> DataFrame:
    paths, spans = scan(docs)
    def shown(s: Column) -> Column:
        return F.concat_ws(":", s.kind, s.start, s.end)

    def of(kind: str) -> Column:
        return F.filter("spans", lambda s: s.kind == kind)

    base = [r.kind for r in BASE]
    text = spans.select(
        "blob",
        *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in base],
        F.sha2(F.array_join(F.transform(F.filter("spans", lambda s: s.kind.isin(base)), shown), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", shown), ",").alias("spans"))
    found = paths.join(text, "blob", "left")
    return found.select(
        F.col("path").alias("doc_id"), *[F.coalesce(f"n_{k}", F.lit(0).cast("long")).alias(f"n_{k}") for k in base],
        F.coalesce("base_sha256", F.sha2(F.lit(""), 256)).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"))
