r"""Phrase collocation mining by the stripes pattern (operator 12).

Texts are split once: a slice of text becomes the codes of its words and a dictionary, and a
word's 64-bit hash (seeded by its language) names it from then on.

A stripe is keyed by a prefix and counts the words that follow it.  A task makes one stripe
for each prefix of its slice and sends those of a bucket of prefixes (``BUCKETS`` for each
shuffle partition) as one row; stripes of a prefix are merged elementwise.  The words
after a prefix that can't be part of a frequent phrase, and the end of a piece, share one
place of the stripe, so one merged structure gives

* the extensions: ``f(prefix + word)`` is the word's count;
* the prefix totals: ``f(prefix)`` is the sum over the stripe;
* the subsumption maxima: the greatest count is the most frequent extension to the right,
  and the greatest count over the stripes that end in a phrase the one to the left.

A longer phrase is no more frequent than its one-word-shorter parts, so a phrase lies in a
longer candidate of ``x`` occurrences only if it lies in one that is one word longer and has
``x`` at least: the two maxima decide.

Lengths grow one word a pass.  A word extends a prefix only if the phrase without its first
word is frequent too.  The frequent phrases of the length before reach the tasks as a
bitmap of fixed size (``BITS``) over their hashes, whatever their number: a false hit sends
an element more, the counts come from the merged stripes and are exact.  The stripes of prefixes with more than a
``HEAVY``-th of a shuffle partition's share of all words (a second bitmap; there are at most
``HEAVY`` times as many as partitions) are cut into ``SEGMENTS`` by the following word, each in
a bucket of its own, so the stripe of a very frequent word is never in one task.

Memory is bounded by a slice: tasks read the slices one by one (``_row_by_row``), and the
shuffle files of a pass go before the next one.

Frequent words and phrases get their text back by a join.  Two of a language with one hash
would be taken for one: their hashes are checked, and an equal pair ends the job.

Words: A-Z in lower case, pieces split at ``[.,;:!?\x0A-\x0D]``, words ``[^\x20\x09]+``.

Defined results: a null text has no words; a null language is ``und``; ids are not used,
rows that repeat one count one by one; equal phrases of a language are ranked by score,
occurrences, then the phrase's UTF-8 bytes; an empty table gives no rows; further columns
are ignored.  Scores are decimals of 38 digits, which more than 10^17 words would need; beyond
that the job ends with an overflow, no wrong row is given.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyfold.llm.common import slices, stored
from skyfold.llm.suffix_dedup import _release

MAX_WORDS = 5
MIN_COUNT = 100
TOP = 2_000
#: A phrase goes if a longer candidate around it has this share of its occurrences.
SUBSUMED_PERCENT = 100
#: Bits of the bitmap of frequent phrases (8 MB).
BITS = 1 << 26
SEGMENTS, HEAVY = 32, 4
#: Buckets of prefixes for each shuffle partition.
BUCKETS = 8
#: Bytes of text in a slice.
SLICE_BYTES = 8 << 20
#: Parts of a language's candidates that are ranked on their own before the final ranking.
RANK_PARTS = 64

#: A-Z to lower case, the ends of pieces to a byte that UTF-8 doesn't have.
_CUT = 0xFF
_TABLE = bytes(b + 32 if 65 <= b <= 90 else _CUT if b in b".,;:!?\n\x0b\x0c\r" else b for b in range(256))
_END = bytes([_CUT])


def tokens(texts: list[bytes]) -> list[bytes]:
    """The words of the texts, with the mark ``_END`` between pieces and after each text."""
    return (_END.join(texts) + _END).translate(_TABLE).replace(_END, b" " + _END + b" ").split()


class _Words(dict):
    """Codes of words in order of appearance; 0 is the end of a piece."""

    def __init__(self) -> None:
        super().__init__({_END: 0})
        self.words = [b""]

    def __missing__(self, word: bytes) -> int:
        self[word] = code = len(self.words)
        self.words.append(word)
        return code


def word_hashes(words: list[bytes], lang: str) -> np.ndarray:
    """Hash of each word; 0 of the end of a piece, which comes first."""
    seed = xxhash.xxh32_intdigest(lang.encode())
    out = np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words), np.uint64, len(words))
    out[:1] = 0
    return out


def coded(texts: list[bytes], lang: str) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """Codes of the words of all texts, the words (the end of a piece first), their hashes."""
    words, found = _Words(), tokens(texts)
    codes = np.fromiter(map(words.__getitem__, found), np.int32, len(found))
    return codes, words.words, word_hashes(words.words, lang)


CODED = "lang string, n long, words array<string>, hashes array<long>, counts array<long>, codes binary"


def _one_list(values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def coded_slices(docs: DataFrame) -> DataFrame:
    """A row per slice of text and language: the number of its words, its distinct words, their
    hashes and counts, and the code of each word of the text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 1, max_bytes=SLICE_BYTES, max_rows=1 << 30):
            of: dict[str, list[bytes]] = {}
            for lang, text in zip(part.column(0).to_pylist(), part.column(1).cast(pa.binary()).to_pylist()):
                if text:
                    of.setdefault(lang, []).append(text)
            for lang, texts in of.items():
                codes, words, hashes = coded(texts, lang)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang]), pa.array([np.count_nonzero(codes)], pa.int64()), _one_list(pa.array(words, pa.binary()).cast(pa.string())),
                     _one_list(pa.array(hashes.view(np.int64))),
                     _one_list(pa.array(np.bincount(codes, minlength=len(words)))),
                     pa.array([codes.tobytes()], pa.binary())], ["lang", "n", "words", "hashes", "counts", "codes"])

    return docs.mapInArrow(run, CODED)


def joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of a phrase from the hash of all but its last word and its last word's."""
    return (left ^ (left >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + right


def _bit(h: np.ndarray) -> np.ndarray:
    return (((h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(38)).astype(np.int64)


def _bitmap(phrases: DataFrame) -> np.ndarray:
    """The bitmap of the phrases' hashes ``h``: at most ``BITS / 64`` rows reach the driver,
    however many phrases there are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(_bit(batch.column(0).to_numpy().view(np.uint64)))], ["bit"])

    rows = (phrases.select("h").mapInArrow(run, "bit long").groupBy(F.shiftright("bit", 6).alias("at"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 as int))")).alias("bits")).toArrow())
    out = np.zeros(BITS // 64, np.int64)
    out[rows.column("at").to_numpy()] = rows.column("bits").to_numpy()
    return out.view(np.uint64)


def _has(bitmap: np.ndarray, h: np.ndarray) -> np.ndarray:
    bit = _bit(h)
    return (bitmap[bit >> 6] >> (bit & 63).astype(np.uint64)) & np.uint64(1) == 1


def stripes_of(codes: np.ndarray, hashes: np.ndarray, size: int, frequent: np.ndarray, heavy: np.ndarray
               ) -> pa.RecordBatch:
    """The stripes of the prefixes of ``size - 1`` words of one slice: ``prefix, segment``, the
    following words (null: the common place of the rest) and their counts, all by hash."""
    n = len(codes) - size + 1  # the last code ends a piece
    if n < 1:
        codes, n = np.zeros(size, np.int32), 1
    of_word = hashes[codes]
    phrase = of_word[:n + 1].copy()  # of size - 1 words, from every place
    inside = codes[:n + 1] != 0
    for i in range(1, size - 1):
        phrase = joined(phrase, of_word[i:n + 1 + i])
        inside &= codes[i:n + 1 + i] != 0
    usual = inside & _has(frequent, phrase)
    at = np.flatnonzero(usual[:n])
    last = codes[at + size - 1]
    follows = np.where((last != 0) & usual[at + 1], last, 0)
    phrase = phrase[at]
    del of_word, inside, usual, at, last
    prefix, prefix_of = np.unique(phrase, return_inverse=True)
    cut = _has(heavy, prefix)[prefix_of]
    segment = np.where(cut, (hashes[follows] % np.uint64(SEGMENTS)).astype(np.int64), 0)
    pair, counts = np.unique((prefix_of * SEGMENTS + segment) * len(hashes) + follows, return_counts=True)
    stripe, begin = np.unique(pair // len(hashes), return_index=True)
    follows = pair % len(hashes)
    ends = pa.array(np.r_[begin, len(pair)], pa.int32())
    nexts = pa.array(hashes[follows].view(np.int64), mask=follows == 0)
    return pa.RecordBatch.from_arrays(
        [pa.array(prefix[stripe // SEGMENTS].view(np.int64)), pa.array(stripe % SEGMENTS, pa.int32()),
         pa.ListArray.from_arrays(ends, nexts), pa.ListArray.from_arrays(ends, pa.array(counts, pa.int64()))],
        ["prefix", "segment", "nexts", "counts"])


def packed(stripes: pa.RecordBatch, buckets: int) -> Iterator[pa.RecordBatch]:
    """The stripes of one slice, a row for each bucket: prefixes, following words, counts."""
    sizes = stripes.column(2).value_lengths().to_numpy()
    prefix = np.repeat(stripes.column(0).to_numpy(), sizes)
    key = stripes.column(0).to_numpy().view(np.uint64) + stripes.column(1).to_numpy().astype(np.uint64) * np.uint64(
        0xC2B2AE3D27D4EB4F)
    bucket = np.repeat((((key ^ (key >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(33))
                       % np.uint64(buckets), sizes).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    begin = np.flatnonzero(np.diff(bucket, prepend=-1))
    ends, take = pa.array(np.append(begin, len(bucket)), pa.int32()), pa.array(order)
    lists = (pa.ListArray.from_arrays(ends, c.take(take)) for c in (
        pa.array(prefix), stripes.column(2).values, stripes.column(3).values.cast(pa.int32())))
    out = pa.RecordBatch.from_arrays([pa.array(bucket[begin]), *lists], ["bucket", "prefixes", "nexts", "counts"])
    for a in range(0, out.num_rows, 10_000):
        yield out.slice(a, 10_000)


@contextmanager
def _row_by_row(spark: SparkSession) -> Iterator[None]:
    """What runs inside reads one row at a time: rows are slices of megabytes."""
    of = {k: spark.conf.get(k) for k in (
        "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.parquet.columnarReaderBatchSize")}
    try:
        for k in of:
            spark.conf.set(k, "1")
        yield
    finally:
        for k, v in of.items():
            spark.conf.set(k, v)


def merged_stripes(texts: DataFrame, size: int, frequent: DataFrame, min_count: int, heavy_from: float) -> DataFrame:
    """The stripes of the frequent prefixes (``h``, occurrences ``n``) of ``size - 1`` words,
    merged elementwise, by bucket: ``prefix, total``, ``stripe``, the words that follow
    ``min_count`` times or more with their counts, and ``top``, the greatest of these.
    Stripes of prefixes that occur ``heavy_from`` times are cut.

    One shuffle: elements are summed where their bucket has come to.
    """
    spark = texts.sparkSession
    shared = spark.sparkContext.broadcast((_bitmap(frequent), _bitmap(frequent.where(F.col("n") >= heavy_from))))
    buckets = BUCKETS * int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                codes = np.frombuffer(batch.column(1)[i].as_buffer(), np.int32)
                hashes = batch.column(0)[i].values.to_numpy().view(np.uint64)
                yield from packed(stripes_of(codes, hashes, size, *shared.value), buckets)

    sent = texts.select("hashes", "codes").mapInArrow(
        run, "bucket int, prefixes array<long>, nexts array<long>, counts array<int>")
    place = ("bucket", "prefix")  # the bucket follows from prefix and segment
    counted = (sent.repartition("bucket").select("bucket", F.inline(F.arrays_zip("prefixes", "nexts", "counts")))
               .groupBy("bucket", F.col("prefixes").alias("prefix"), F.col("nexts").alias("next"))
               .agg(F.sum("counts").alias("n")))
    often = F.col("next").isNotNull() & (F.col("n") >= min_count)
    return counted.groupBy(*place).agg(
        F.sum("n").alias("total"), F.max(F.when(often, F.col("n"))).alias("top"),
        F.collect_list(F.when(often, F.struct("next", "n"))).alias("stripe")).drop("bucket")


def _distinct(phrases: DataFrame) -> DataFrame:
    """``phrases``, once no two of them have one hash."""
    twice = phrases.groupBy("h").agg(F.count("*").alias("times")).where("times > 1").limit(1).count()
    if twice:
        raise ValueError("two frequent phrases have the same 64-bit hash")
    return phrases


def _extended(stripes: DataFrame, frequent: DataFrame, words: DataFrame) -> DataFrame:
    """``h, lang, phrase, n`` of the frequent phrases that are one word longer."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h = joined(*(b.column(i).to_numpy().view(np.uint64) for i in (0, 1)))
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), *b.columns[2:]], ["h", "lang", "phrase", "n"])

    ends = words.select(F.col("h").alias("next"), F.col("phrase").alias("last"))
    found = (stripes.select("prefix", F.explode("stripe").alias("e")).select("prefix", "e.next", "e.n")
             .join(frequent.select(F.col("h").alias("prefix"), "lang", "phrase"), "prefix").join(ends, "next"))
    return found.select("prefix", "next", "lang", F.concat_ws(" ", "phrase", "last").alias("phrase"), "n").mapInArrow(
        run, "h long, lang string, phrase string, n long")


def mine(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS,
         subsumed_percent: int = SUBSUMED_PERCENT, top: int = TOP, text_col: str = "text",
         lang_col: str = "lang") -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of each language's first ``top`` phrases."""
    docs = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                       F.col(text_col).alias("text"))
    spark = docs.sparkSession
    texts = stored(coded_slices(docs), "collocation-slices", "zstd")
    with _row_by_row(spark):
        words = stored(texts.select("lang", F.explode(F.arrays_zip("words", "hashes", "counts")).alias("w"))
                       .where("w.words <> ''").groupBy("lang", F.col("w.words").alias("phrase"), F.col("w.hashes").alias("h"))
                       .agg(F.sum("w.counts").alias("n")).where(F.col("n") >= min_count), "collocation-words")
    totals = texts.groupBy("lang").agg(F.sum("n").alias("n"))  # one row per language
    every = totals.agg(F.sum("n")).first()[0] or 0
    heavy_from = every / (HEAVY * int(spark.conf.get("spark.sql.shuffle.partitions")))
    frequent = words = _distinct(words)
    phrases, prefixes = [], []
    for size in range(2, max_words + 1):
        _release(spark)
        merged = merged_stripes(texts, size, frequent, min_count, heavy_from)
        with _row_by_row(spark):
            stripes = stored(merged, f"collocation-stripes-{size}")
        del merged
        prefixes.append(stripes.groupBy(F.col("prefix").alias("h")).agg(F.sum("total").alias("f"), F.max("top").alias("top"))
                        .join(frequent.select("h", "lang", "phrase"), "h").select("lang", "phrase", "f", "top"))
        frequent = _distinct(stored(_extended(stripes, frequent, words), f"collocation-phrases-{size}"))
        phrases.append(frequent.select("lang", "phrase", F.lit(size).alias("size"), F.col("n").alias("a")))
    candidates = reduce(DataFrame.unionByName, phrases)
    _release(spark)
    f_of = stored(reduce(DataFrame.unionByName, prefixes), "collocation-prefixes")
    return _ranked(_scored(candidates, f_of, totals, subsumed_percent), top)


def _scored(candidates: DataFrame, f_of: DataFrame, totals: DataFrame, subsumed_percent: int) -> DataFrame:
    """The candidates that no longer one subsumes, with their lowest cut."""
    parts = F.split("phrase", " ")
    left = candidates.where("size > 2").groupBy(
        "lang", F.array_join(F.slice(parts, F.lit(2), F.col("size") - 1), " ").alias("phrase")
    ).agg(F.max("a").alias("left_top"))
    right = f_of.select("lang", "phrase", F.col("top").alias("right_top"))
    whole = (candidates.join(left, ["lang", "phrase"], "left").join(right, ["lang", "phrase"], "left")
             .where(F.lit(100) * F.greatest(F.coalesce("left_top", F.lit(0)), F.coalesce("right_top", F.lit(0)))
                    < F.lit(subsumed_percent) * F.col("a")))
    cuts = whole.join(totals, "lang").select(
        "lang", "phrase", "a", "n", F.explode(F.expr("sequence(1, size - 1)")).alias("k"), parts.alias("parts")
    ).select("lang", "phrase", "a", "n", "k", F.array_join(F.slice("parts", F.lit(1), F.col("k")), " ").alias("first"),
             F.array_join(F.slice("parts", F.col("k") + 1, F.size("parts") - F.col("k")), " ").alias("rest"))
    l_of = f_of.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    r_of = f_of.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    # l and r are a at least, so the quotient is no more than 10 * n
    score = F.expr("cast(1000 * cast(a as decimal(38,0)) * n as decimal(38,0)) "
                   "div cast(cast(l as decimal(38,0)) * r as decimal(38,0))")
    return (cuts.join(l_of, ["lang", "first"]).join(r_of, ["lang", "rest"])
            .withColumn("cut", F.struct(score.alias("score"), "k", "l", "r"))
            .groupBy("lang", "phrase", "a", "n").agg(F.min("cut").alias("cut"))
            .select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n",
                    F.col("cut.score").alias("score")))


def _ranked(scored: DataFrame, top: int) -> DataFrame:
    """The first ``top`` of each language; each part of a language gives its own first, so
    the last ranking sorts ``RANK_PARTS * top`` rows of a language at most."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS)).alias("part")
    first = (scored.select("*", part)
             .withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
             .where(F.col("rank") <= top).drop("part", "rank"))
    return (first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
            .where(F.col("rank") <= top)
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))


def query(docs: DataFrame) -> DataFrame:
    return mine(docs)


#: All phrases of up to five words by position, counted; every longer candidate is compared
#: with the phrases it contains.
SQL = r"""
WITH texts AS (
  SELECT row_number() OVER () AS d, coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents),
pieces AS (SELECT lang, unnest(regexp_extract_all(t, '[^.,;:!?\x0A-\x0D]+')) AS piece FROM texts),
numbered AS (SELECT lang, row_number() OVER () AS p, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
occurrences AS (
  SELECT lang, list_slice(w, i, i + m - 1) AS words, m
  FROM (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM numbered), range(1, 6) AS sizes(m)
  WHERE i + m - 1 <= len(w)),
counts AS (SELECT lang, array_to_string(words, ' ') AS phrase, words, m, count(*)::HUGEINT AS f
           FROM occurrences GROUP BY lang, words, m),
totals AS (SELECT lang, sum(f)::HUGEINT AS n FROM counts WHERE m = 1 GROUP BY lang),
frequent AS (SELECT * FROM counts WHERE f >= 100),
candidates AS (SELECT * FROM frequent WHERE m >= 2),
inner_parts AS (
  SELECT lang, f, unnest(list_distinct(flatten(list_transform(range(2, m),
      lambda k: list_transform(range(1, m - k + 2), lambda i: array_to_string(list_slice(words, i, i + k - 1), ' ')))))) AS phrase
  FROM candidates WHERE m > 2),
subsumed AS (SELECT DISTINCT c.lang, c.phrase FROM candidates c JOIN inner_parts i
             ON i.lang = c.lang AND i.phrase = c.phrase AND 100 * i.f >= 100 * c.f),
cuts AS (
  SELECT lang, phrase, f AS a, k, array_to_string(list_slice(words, 1, k), ' ') AS first,
         array_to_string(list_slice(words, k + 1, m), ' ') AS rest
  FROM candidates ANTI JOIN subsumed USING (lang, phrase), range(1, 5) AS ks(k) WHERE k < m),
scores AS (
  SELECT c.lang, c.phrase, c.a, c.k, x.f AS l, y.f AS r, t.n, (1000::HUGEINT * c.a * t.n) // (x.f * y.f) AS score
  FROM cuts c JOIN totals t ON t.lang = c.lang
  JOIN frequent x ON x.lang = c.lang AND x.phrase = c.first
  JOIN frequent y ON y.lang = c.lang AND y.phrase = c.rest),
lowest AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM ranked WHERE rank <= 2000
"""
