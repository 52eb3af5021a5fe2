"""SimHash near-duplicates (operator 4).

Every text gets a 64-bit fingerprint; fingerprints that differ in few bits are
linked, and documents of one connected component are near-duplicates.

Links are found by a hierarchical index over Gray order.  Two fingerprints
within ``max_bits`` differences agree in at least one of ``max_bits + 1`` bit
blocks, so the distinct fingerprints are dealt once per block by that block's
value.  In a group the fingerprints are sorted by Gray rank, which puts those
with few differences close together; every four neighbours share a node that
holds the bits on which they agree (mask and pattern), four nodes an upper node,
and so on.  The search goes down from the root with pairs of nodes: a pair whose
shared patterns already differ in more than ``max_bits`` bits goes with all that
is below it, one that can't differ in more is linked as a whole, and one whose
members are already connected needs no further look.  Groups with very many
fingerprints are dealt again by blocks of their remaining bits.

Defined results: a null text counts as an empty one; texts without words have
fingerprint zero and are linked like others; rows with a null id get a
fingerprint but no component; repeated rows and ids are judged one by one; an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyfold.llm.common import LOWER, stored
from skyfold.llm.components import components

SHINGLE = 3
MAX_BITS = 3
SEED = 42
#: Distinct fingerprints that share a bit block above which the group is dealt again.
MAX_GROUP = 50_000
FAN_OUT = 4
#: Node pairs looked at together, and rows of complete groups indexed together.
PAIRS, ROWS = 50_000, 200_000


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Majority bits of the XXH64 of all word shingles, repeats included."""
    words = text.encode().translate(LOWER).split() if text else []
    if not words:
        return 0
    whole = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(whole, SEED)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        cuts = map(slice, starts[:len(words) - shingle + 1].tolist(), ends[shingle - 1:].tolist())
        hashes = list(map(xxhash.xxh64_intdigest, map(whole.__getitem__, cuts), repeat(SEED)))
    h = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), 65536):
        ones += np.unpackbits(h[i:i + 65536], axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(h), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``doc_id, fp``: the fingerprint as a signed 64-bit integer; and ``mark``, which
    tells rows of one id with different texts apart."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t, shingle) for t in b.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64)), b.column(2)],
                                             ["doc_id", "fp", "mark"])

    id_type = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), _mark(text_col)).mapInArrow(
        run, f"doc_id {id_type}, fp long, mark binary")


def _mark(text_col: str) -> Column:
    return F.unhex(F.md5(F.coalesce(F.col(text_col), F.lit("")))).alias("mark")


def _turned(x: Column, low: int, by: int) -> Column:
    """``x`` with its ``low`` lowest bits rotated left by ``by``."""
    if by == 0:
        return x
    mask = F.lit((1 << low) - 1 if low < 64 else -1).cast("long")
    part = x.bitwiseAND(mask)
    turned = F.shiftleft(part, by).bitwiseOR(F.shiftrightunsigned(part, low - by)).bitwiseAND(mask)
    return turned if low == 64 else x.bitwiseAND(F.bitwise_not(mask)).bitwiseOR(turned)


def gray_rank(x: Column) -> Column:
    """Position of the code word ``x`` in the 64-bit Gray sequence."""
    for by in (1, 2, 4, 8, 16, 32):
        x = x.bitwiseXOR(F.shiftrightunsigned(x, by))
    return x


def _blocks(bits: int, n: int) -> list[int]:
    return [bits // n + (i < bits % n) for i in range(n)]


def _dealt(rows: DataFrame, fixed: int, n: int) -> DataFrame:
    """Each row of ``(path, code, fp)`` once per block of the bits that are not
    fixed yet, that block turned to the front; ``key`` is all that is fixed then."""
    left, at, parts = 64 - fixed, 0, []
    for i, width in enumerate(_blocks(left, n)):
        code = _turned(F.col("code"), left, at)
        parts.append(F.struct((F.col("path") * (n + 1) + (i + 1)).alias("path"), code.alias("code"),
                              F.shiftrightunsigned(code, left - width).alias("key"),
                              F.lit(left - width).alias("free")))
        at += width
    return rows.select("fp", F.explode(F.array(*parts)).alias("x")).select("fp", "x.*")


class _Forest:
    """Union-find over row numbers; a root is the smallest row of its set."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def roots(self) -> np.ndarray:
        while True:
            up = self.up[self.up]
            if np.array_equal(up, self.up):
                return up
            self.up = up

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            root = self.roots()
            ra, rb = root[a], root[b]
            apart = ra != rb
            if not apart.any():
                return
            a, b = a[apart], b[apart]
            np.minimum.at(self.up, np.maximum(ra, rb)[apart], np.minimum(ra, rb)[apart])


def linked(codes: np.ndarray, groups: np.ndarray, max_bits: int) -> np.ndarray:
    """For each row the smallest row of its connected set.

    ``codes``: unsigned 64-bit fingerprints, by Gray rank in each group;
    ``groups``: the rows' group numbers, ascending.  Only rows of one group are
    compared.
    """
    n = len(codes)
    forest = _Forest(n)
    if n < 2:
        return forest.up
    near = (groups[1:] == groups[:-1]) & (np.bitwise_count(codes[1:] ^ codes[:-1]) <= max_bits)
    forest.join(np.flatnonzero(near), np.flatnonzero(near) + 1)
    # levels of nodes, from the rows up: bits all members have (every), any has (some)
    first = np.flatnonzero(np.concatenate(([True], groups[1:] != groups[:-1])))
    levels = [(codes, codes, np.arange(n + 1))]
    starts = [np.arange(n + 1)]  # first row of each node
    at, per = first, np.diff(np.append(first, n))
    while per.max() > 1:
        every, some, _ = levels[-1]
        inner = np.arange(len(every)) - np.repeat(at, per)
        heads = np.flatnonzero(inner % FAN_OUT == 0)
        levels.append((np.bitwise_and.reduceat(every, heads), np.bitwise_or.reduceat(some, heads),
                       np.append(heads, len(every))))
        starts.append(starts[-1][levels[-1][2]])
        per = -(-per // FAN_OUT)
        at = np.concatenate(([0], np.cumsum(per)[:-1]))
    top = len(levels) - 1
    pairs = np.arange(len(levels[top][0]))
    todo = [(top, pairs, pairs)]
    while todo:
        level, a, b = todo.pop()
        if len(a) > PAIRS:
            todo.append((level, a[PAIRS:], b[PAIRS:]))
            a, b = a[:PAIRS], b[:PAIRS]
        if level == 0:
            forest.join(a, b)
            continue
        # members that are all in one set need no further look
        root, rows = forest.roots(), starts[level]
        low, high = np.minimum.reduceat(root, rows[:-1]), np.maximum.reduceat(root, rows[:-1])
        one = (low[a] == high[b]) & (low[b] == high[a])
        a, b = a[~one], b[~one]
        heads = levels[level][2]
        na, nb = heads[a + 1] - heads[a], heads[b + 1] - heads[b]
        total = na * nb
        k = np.arange(total.sum()) - np.repeat(np.cumsum(total) - total, total)
        width = np.repeat(nb, total)
        x, y = np.repeat(heads[a], total) + k // width, np.repeat(heads[b], total) + k % width
        same = np.repeat(a == b, total)
        below = ~same | (x < y) if level == 1 else ~same | (x <= y)
        x, y = x[below], y[below]
        every, some, _ = levels[level - 1]
        shared = ~((every[x] ^ some[x]) | (every[y] ^ some[y]))
        apart = np.bitwise_count((every[x] ^ every[y]) & shared)
        keep = apart <= max_bits
        x, y, apart, shared = x[keep], y[keep], apart[keep], shared[keep]
        if level > 1:
            sure = apart + np.bitwise_count(~shared) <= max_bits
            _join_whole(forest, starts[level - 1], x[sure], y[sure])
            x, y = x[~sure], y[~sure]
        if len(x):
            todo.append((level - 1, x, y))
    return forest.roots()


def _join_whole(forest: _Forest, rows: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
    """All members of node x with all of node y."""
    for p, q in ((x, y), (y, x)):
        n = rows[p + 1] - rows[p]
        inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        forest.join(np.repeat(rows[p], n) + inner, np.repeat(rows[q], n))


def _links(max_bits: int):
    """Task: rows ``path, key, code, fp`` sorted by path, key and Gray rank; gives
    each fingerprint with the first of its connected set in the group."""
    def flush(parts: list[pa.Table], last: bool) -> tuple[pa.RecordBatch, list[pa.Table]]:
        t = pa.concat_tables(parts)
        path, key = t["path"].to_numpy(), t["key"].to_numpy()
        new = np.concatenate(([True], (path[1:] != path[:-1]) | (key[1:] != key[:-1])))
        end = len(new) if last else int(np.flatnonzero(new)[-1])  # the last group may go on
        fps = t["fp"].to_numpy()[:end]
        root = linked(t["code"].to_numpy()[:end].view(np.uint64), np.cumsum(new[:end]), max_bits)
        moved = np.flatnonzero(root != np.arange(end))
        return (pa.RecordBatch.from_arrays([pa.array(fps[moved]), pa.array(fps[root[moved]])], ["u", "v"]),
                [t.slice(end)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[pa.Table] = []
        for b in batches:
            parts.append(pa.Table.from_batches([b]))
            if sum(map(len, parts)) >= ROWS:
                out, parts = flush(parts, False)
                yield out
        if parts and sum(map(len, parts)):
            yield flush(parts, True)[0]

    return run


def links(distinct: DataFrame, max_bits: int = MAX_BITS, max_group: int = MAX_GROUP) -> DataFrame:
    """``u, v``: pairs of fingerprints within ``max_bits`` bits, or connected through
    such pairs in one group, whose components are those of all such pairs.

    ``distinct``: one column ``fp`` without repeats.
    """
    spark = distinct.sparkSession
    n, fixed = max_bits + 1, 0
    rows = distinct.select(F.lit(0).alias("path"), F.col("fp").alias("code"), "fp")
    out = []
    while True:
        dealt = _dealt(rows, fixed, n)
        fixed += min(_blocks(64 - fixed, n))
        # at most (blocks x values of a block) keys at the first level, below it at most a
        # 1/max_group-th of the rows: written, so that their number is known before the join
        hot = stored(dealt.groupBy("path", "key").agg(F.count("*").alias("rows"))
                     .where(F.col("rows") > max_group).select("path", "key"), "simhash-hot")
        again = 64 - fixed > 2 * n and hot.limit(1).count() > 0
        cold = dealt.join(hot, ["path", "key"], "left_anti") if again else dealt
        width = int(spark.conf.get("spark.sql.shuffle.partitions"))
        found = (cold.withColumn("rank", gray_rank(F.col("code"))).repartition(width, "path", "key")
                 .sortWithinPartitions("path", "key", "rank").select("path", "key", "code", "fp")
                 .mapInArrow(_links(max_bits), "u long, v long"))
        out.append(found)
        if not again:
            break
        # blocks differ in width by one at most: what the narrower ones fix counts for all
        rows = dealt.join(hot, ["path", "key"], "left_semi").select("path", "code", "fp")
    edges = out[0]
    for more in out[1:]:
        edges = edges.union(more)
    return edges


def _placed(docs: DataFrame, shingle: int, max_bits: int, max_group: int, id_col: str, text_col: str
            ) -> tuple[DataFrame, DataFrame]:
    """The fingerprints of all rows, and of each distinct one the smallest id and the root
    of its component (a fingerprint of it)."""
    fps = stored(fingerprints(docs, shingle, id_col, text_col), "simhash-fps")
    distinct = stored(fps.where("doc_id IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("first")),
                      "simhash-distinct")
    roots = components(links(distinct.select("fp"), max_bits, max_group), "simhash-components")
    return fps, distinct.join(roots.withColumnRenamed("u", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("v", "fp").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS,
                    max_group: int = MAX_GROUP, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``doc_id, fp, component_id``: the smallest id reachable over links of at most
    ``max_bits`` differing bits, the document's own included."""
    fps, placed = _placed(docs, shingle, max_bits, max_group, id_col, text_col)
    first = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    named = placed.join(first, "root").select("fp", "component_id")
    return fps.join(named, "fp", "left").select(
        "doc_id", "fp", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))


def keep_one(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each near-duplicate group, one of its smallest id (of
    several rows with that id the one whose text has the smallest digest).

    Rows are judged one by one: rows of one id whose texts are not near duplicates are in
    groups of their own, and both stay.  Rows with a null id stay.
    """
    fps, placed = _placed(docs, shingle, max_bits, MAX_GROUP, id_col, text_col)
    rows = (fps.where("doc_id IS NOT NULL").join(placed.select("fp", "root"), "fp")
            .groupBy("root", "doc_id", "mark").agg(F.count("*").alias("rows")))
    first = stored(rows.groupBy("root").agg(F.min(F.struct("doc_id", "mark", "rows")).alias("kept")).select(
        F.col("kept.doc_id").alias("__id"), F.col("kept.mark").alias("__mark"), "kept.rows"), "simhash-first")
    marked = docs.withColumn("__m", _mark(text_col))
    kept = marked.join(first.hint("shuffle_hash"),
                       (marked[id_col] == F.col("__id")) & (F.col("__m") == F.col("__mark")), "left_semi")
    if first.where("rows > 1").limit(1).count():  # rows alike in id and text
        kept = kept.dropDuplicates([id_col, "__m"])
    return kept.select(docs.columns).union(docs.where(F.col(id_col).isNull()))


def query(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
