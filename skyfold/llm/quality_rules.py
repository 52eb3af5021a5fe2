r"""Quality rules with cross-document line frequency (operator 2).

Base rules look at one text: too few words, or too many words in repeated
five-word windows.  Beside them every line is normalised (words in lower case,
one blank between) and hashed; the distinct documents of a host that have the
line are counted, lines above the host's limit are removed, and a document that
keeps too little is rejected.

Words are ``[^\x20\x09-\x0D]+``.  A host is the document's ``source``.

Defined results: a null text has no words; documents with a null host form one
host; a document is a row, so rows that repeat an id count and are judged one by
one; lines without a word are never counted or removed; an empty table gives no
rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyfold.llm.common import LOWER, WHITE_SPACE, stored

WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
#: A line goes if more than ``LINE_DOCS`` documents of the host have it and these are more than
#: ``LINE_SHARE`` of the host's documents, or more than ``LINE_MANY`` on a host of any size.
LINE_DOCS, LINE_SHARE, LINE_MANY = 20, 0.005, 1_000
#: A document goes if less than this share of its words is left.
MIN_LEFT = 0.5
SYMBOLS = "#*$%&|<>"
#: Rows of frequent lines (16 bytes each) up to which they are broadcast; beyond, a shuffle join.
MAX_BROADCAST_ROWS = 1 << 20


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words in windows that occur twice or more in the text, the first included."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    ids = np.fromiter(map({}.setdefault, words, count()), np.uint64, len(words))
    h = np.zeros(n, np.uint64)
    for i in range(window):
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + ids[i:i + n]
    order = np.argsort(h, kind="stable")
    same = h[order[1:]] == h[order[:-1]]
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    edge = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(twice)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + window, -1)
    return int(np.count_nonzero(np.cumsum(edge)))


def line_hash(line: str) -> int | None:
    words = line.encode().translate(LOWER).split()
    return xxhash.xxh64_intdigest(b" ".join(words)) - (1 << 63) if words else None


def _lines(text: str) -> tuple[int, dict[int, int]]:
    """Lines equal to an earlier one, and the words of all lines by their hash."""
    lines: dict[str, int] = {}
    for line in text.split("\n"):
        lines[line] = lines.get(line, 0) + 1
    repeats, words_of = 0, {}
    for line, times in lines.items():
        words = line.encode().translate(LOWER).split()
        if words:
            repeats += times - 1
            h = xxhash.xxh64_intdigest(b" ".join(words)) - (1 << 63)
            words_of[h] = words_of.get(h, 0) + times * len(words)
    return repeats, words_of


def _measured(texts: list[str | None]) -> list[pa.Array]:
    base: list[list[int]] = [[], [], [], [], []]
    ends, hashes, sizes = [0], [], []
    for text in texts:
        text = text or ""
        words = text.encode().split()
        repeats, words_of = _lines(text)
        row = (len(words), len(text) - sum(map(text.count, WHITE_SPACE)), sum(map(text.count, SYMBOLS)),
               repeats, repeated_words(words))
        for column, value in zip(base, row):
            column.append(value)
        hashes.extend(words_of)
        sizes.extend(words_of.values())
        ends.append(len(hashes))
    lines = pa.StructArray.from_arrays([pa.array(hashes, pa.int64()), pa.array(sizes, pa.int32())], ["line", "words"])
    return [*(pa.array(c, pa.int64()) for c in base), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), lines)]


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            host_col: str = "source") -> DataFrame:
    """``doc_id, host``, the base measures, and ``lines``: hash and words of each
    distinct normalised line."""
    head = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(host_col).alias("host"), F.col(text_col).alias("text"))
    id_type = head.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 1000):
                part = batch.slice(a, 1000)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), *_measured(part.column(2).to_pylist())],
                    ["doc_id", "host", *BASE, "lines"])

    return head.mapInArrow(run, f"doc_id {id_type}, host long, " + ", ".join(f"{c} long" for c in BASE)
                           + ", lines array<struct<line:long,words:int>>")


def frequent_lines(measured: DataFrame, line_docs: int = LINE_DOCS, line_share: float = LINE_SHARE,
                   line_many: int = LINE_MANY) -> DataFrame:
    """``key``: hash of host and line of each line above its host's limit.

    A host's documents and a line's documents are counted with partial sums, so a
    host with a third of all rows is no hot key.
    """
    hosts = measured.groupBy("host").agg(F.count("*").alias("docs"))
    lines = measured.select("host", F.explode("lines.line").alias("line")).groupBy("host", "line").agg(
        F.count("*").alias("n")).where(F.col("n") > line_docs)
    return lines.join(hosts, "host").where(
        (F.col("n") > line_share * F.col("docs")) | (F.col("n") > line_many)).select(
        F.xxhash64("host", "line").alias("key"))


def judge(docs: DataFrame, min_words: int = MIN_WORDS, max_repeat_percent: int = MAX_REPEAT_PERCENT,
          line_docs: int = LINE_DOCS, line_share: float = LINE_SHARE,
          line_many: int = LINE_MANY, min_left: float = MIN_LEFT,
          id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """``doc_id``, the base measures, ``base_failed``, ``removed`` (hashes of removed
    lines), ``n_left`` (words left) and ``kept``."""
    measured = stored(measure(docs, id_col, text_col, host_col).withColumn(
        "row", F.monotonically_increasing_id()), "quality-measured")
    frequent = stored(frequent_lines(measured, line_docs, line_share, line_many), "quality-frequent")
    small = frequent.limit(MAX_BROADCAST_ROWS + 1).count() <= MAX_BROADCAST_ROWS
    lines = measured.select("row", "host", F.explode("lines").alias("l")).select(
        "row", "l.line", "l.words", F.xxhash64("host", "l.line").alias("key"))
    cut = lines.join(F.broadcast(frequent) if small else frequent, "key").groupBy("row").agg(
        F.sum("words").alias("cut"), F.collect_list("line").alias("removed"))
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    out = measured.drop("lines", "host").join(cut, "row", "left")
    out = out.withColumn("n_left", F.col("n_words") - F.coalesce("cut", F.lit(0))).withColumn("base_failed", failed)
    left = (F.col("n_left") >= min_words) & (F.col("n_left") >= min_left * F.col("n_words"))
    return out.select("doc_id", *BASE, "base_failed", F.coalesce("removed", F.array().cast("array<long>")).alias("removed"),
                      "n_left", (~F.col("base_failed") & left).alias("kept"))


def clean(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
          length_col: str = "n_chars", **limits) -> DataFrame:
    """``docs`` (all columns; ids without repeats) that are kept, without their frequent lines."""
    verdicts = judge(docs, id_col=id_col, text_col=text_col, host_col=host_col, **limits).where("kept")
    names, at = docs.columns, docs.columns.index(text_col)
    joined = docs.withColumn("__id", F.col(id_col)).join(
        verdicts.select(F.col("doc_id").alias("__id"), F.col("removed").alias("__removed")), "__id").select(
        *[docs[c] for c in names], "__removed")
    length_at = names.index(length_col) if length_col in names else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, columns = batch.column(at).to_pylist(), list(batch.columns[:-1])
            for i, gone in enumerate(batch.column(len(names)).to_pylist()):
                if gone:
                    texts[i] = "\n".join(x for x in texts[i].split("\n") if line_hash(x) not in set(gone))
            columns[at] = pa.array(texts, batch.schema.field(at).type)
            if length_at is not None:
                columns[length_at] = pa.array([None if t is None else len(t) for t in texts], batch.schema.field(length_at).type)
            yield pa.RecordBatch.from_arrays(columns, names)

    return joined.mapInArrow(run, docs.schema)


def query(docs: DataFrame) -> DataFrame:
    return judge(docs).select("doc_id", *BASE, "base_failed", "kept")


#: DuckDB statement with the rows of :func:`query`.
SQL = rf"""
WITH doc AS (
  SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
five AS (
  SELECT doc_id, p, array_to_string(w[p:p + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS p FROM doc WHERE len(w) >= 5)),
again AS (
  SELECT doc_id, count(DISTINCT q) AS n
  FROM (SELECT doc_id, unnest(range(p, p + 5)) AS q
        FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, g) AS times FROM five) WHERE times > 1)
  GROUP BY doc_id),
line AS (
  SELECT doc_id, host, l, regexp_extract_all(
           translate(l, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS lw
  FROM (SELECT doc_id, host, unnest(string_split(t, chr(10))) AS l FROM doc)),
worded AS (SELECT *, array_to_string(lw, ' ') AS norm FROM line WHERE len(lw) > 0),
dup AS (SELECT doc_id, count(*) - count(DISTINCT l) AS n FROM worded GROUP BY doc_id),
hosts AS (SELECT host, count(*) AS docs FROM doc GROUP BY host),
frequent AS (
  SELECT host, norm FROM worded JOIN hosts USING (host) GROUP BY host, norm, docs
  HAVING count(DISTINCT doc_id) > {LINE_DOCS}
    AND (count(DISTINCT doc_id) > {LINE_SHARE} * docs OR count(DISTINCT doc_id) > {LINE_MANY})),
cut AS (SELECT doc_id, sum(len(lw)) AS n FROM worded SEMI JOIN frequent USING (host, norm) GROUP BY doc_id),
base AS (
  SELECT doc.doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(again.n, 0) AS BIGINT) AS n_repeat_words,
         len(w) - coalesce(cut.n, 0) AS n_left
  FROM doc LEFT JOIN again USING (doc_id) LEFT JOIN dup USING (doc_id) LEFT JOIN cut USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed,
       NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words)
         AND n_left >= {MIN_WORDS} AND n_left >= {MIN_LEFT} * n_words AS kept
FROM base
"""
