r"""Periodic run detection by a dictionary of basic factors (operator 13).

A run of a text is a stretch of consecutive words with smallest period ``q`` (words ``q``
apart are identical), at least ``max(MIN_WORDS, MIN_POWER * q)`` words long, that no
neighbouring word extends.

The dictionary names every factor whose length is a power of two: equal factors of a
document share a name, and a factor of twice the length is named by the names of its
halves.  A factor that occurs once in its document can't lie in a run (nor can one that
has it for a half), so each level holds what the level before saw twice.  At a level of
length ``L`` the next occurrence of the same factor, if at most ``2 * L`` away, proposes
its distance as a period: along a run, consecutive places have the same distance ``q``, a
bundle of arithmetic progressions ``i, i + q, i + 2q``.  Only bundles of more than ``q``
places count, since a run of four periods has ``q + 2`` at the first level with
``L >= q``.  A proposal is extended as far as words a period apart are equal; several
levels propose the same run, which is kept once.  The distance is the *next* occurrence's,
so a smaller period of the same stretch would have been proposed in its place.

All documents of a slice are named together, one sort a level; documents keep apart because
the first name holds the document.

Words are ``[^\x20\x09-\x0D]+``.

Defined results: a null or empty text has no words and no runs; rows that repeat an id are
judged one by one; a null id plants nothing (:func:`planted`); an empty table gives no
rows; further columns are ignored.  Texts of any length are processed whole: a slice holds
one document at least.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyfold.llm.common import slices

MIN_WORDS = 6
MIN_POWER = 4


def planted(words: list[bytes], h: int | None) -> list[bytes]:
    """The contract's planted repetition: of every tenth document (``h`` is the CRC-32 of
    its id) the words from place ``a`` on repeat the ``p`` words found there."""
    n = len(words)
    if h is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    period = words[a:a + p]
    return words[:a] + (period * (-(-(n - a) // p)))[:n - a]


def _bundles(places: np.ndarray, gaps: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """First place, last place and gap of each stretch of consecutive places with one gap
    that has more places than the gap."""
    order = np.lexsort((places, gaps))
    p, g = places[order], gaps[order]
    first = np.flatnonzero(np.r_[True, (g[1:] != g[:-1]) | (p[1:] != p[:-1] + 1)])
    last = np.r_[first[1:], len(p)] - 1
    long = last - first + 1 > g[first]
    return zip(p[first[long]].tolist(), p[last[long]].tolist(), g[first[long]].tolist())


def find_runs(words: np.ndarray, bounds: np.ndarray, min_words: int = MIN_WORDS,
              min_power: int = MIN_POWER) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of every run, sorted by start, then period.

    ``words`` holds the word codes of several documents end to end, ``bounds`` where each
    of them begins, and the end of the last; starts are places in ``words``.  ``min_power``
    is 4 at least, which the proposals rely on.
    """
    if min_power < 4:
        raise ValueError("runs of less than four periods are not proposed")
    if not len(words):
        return []
    sizes = np.diff(bounds)
    longest = int(sizes.max())
    end = np.repeat(bounds[1:], sizes)
    code = words.tolist()
    found: set[tuple[int, int, int]] = set()
    at = np.arange(len(words))
    name = np.repeat(np.arange(len(sizes)), sizes) * (int(words.max()) + 1) + words
    length = 1
    while len(at):
        order = np.argsort(name, kind="stable")  # places ascend within a name
        p, sorted_names = at[order], name[order]
        same = sorted_names[1:] == sorted_names[:-1]
        gap = p[1:] - p[:-1]
        near = same & (gap <= 2 * length)
        if near.any():
            for i, j, q in _bundles(p[:-1][near], gap[near]):
                found.add(_extended(code, int(bounds[np.searchsorted(bounds, i, "right") - 1]), int(end[i]),
                                    i, j + q + length, q))
        if 2 * length > longest // 2:
            break  # a longer period than half the next length has no four periods
        twice = np.r_[same, False] | np.r_[False, same]
        rank = np.cumsum(np.r_[True, ~same])[twice]
        p = p[twice]
        order = np.argsort(p)
        p, rank = p[order], rank[order]
        half = np.minimum(np.searchsorted(p, p + length), max(len(p) - 1, 0))
        whole = (p[half] == p + length) & (p + 2 * length <= end[p])
        at, name = p[whole], rank[whole] * (len(words) + 1) + rank[half[whole]]
        length *= 2
    return sorted((a, b - a, q) for a, b, q in found if b - a >= max(min_words, min_power * q))


def _extended(code: list[int], low: int, high: int, a: int, b: int, q: int) -> tuple[int, int, int]:
    while a > low and code[a - 1] == code[a - 1 + q]:
        a -= 1
    while b < high and code[b] == code[b - q]:
        b += 1
    return a, b, q


def _coded(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    codes: dict[bytes, int] = {}
    number = count()
    sizes = [len(t) for t in texts]
    flat = np.fromiter((codes[w] if w in codes else codes.setdefault(w, next(number))
                        for w in chain.from_iterable(texts)), np.int64, sum(sizes))
    return flat, np.r_[0, np.cumsum(sizes, dtype=np.int64)]


def runs_of(texts: list[list[bytes]], min_words: int = MIN_WORDS, min_power: int = MIN_POWER
            ) -> list[list[tuple[int, int, int]]]:
    """The runs of each text, starts counted from its first word."""
    words, bounds = _coded(texts)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for start, length, q in find_runs(words, bounds, min_words, min_power):
        d = int(np.searchsorted(bounds, start, "right")) - 1
        out[d].append((start - int(bounds[d]), length, q))
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run contains after its first period."""
    if not runs:
        return words
    edge = np.zeros(len(words) + 1, np.int64)
    for start, length, q in runs:
        edge[start + q] += 1
        edge[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]


def detect(docs: DataFrame, plant: bool = False, min_words: int = MIN_WORDS, min_power: int = MIN_POWER,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, runs, n_words, text``: every run as ``(start, length, period)`` in words,
    and the words left joined by one blank.  A narrow map, no shuffle.

    ``plant`` puts the contract's repetitions into the texts first.
    """
    head = docs.select(F.col(id_col).alias("doc_id"), F.crc32(F.col(id_col).cast("string")).alias("h"),
                       F.col(text_col).alias("text"))
    id_type = head.schema["doc_id"].dataType.simpleString()
    run_type = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 2):
            texts = [(t or b"").split() for t in part.column(2).cast(pa.binary()).to_pylist()]
            if plant:
                texts = [planted(t, h) for t, h in zip(texts, part.column(1).to_pylist())]
            runs = runs_of(texts, min_words, min_power)
            rows = np.array(list(chain.from_iterable(runs)), np.int64).reshape(-1, 3)
            flat = pa.StructArray.from_arrays([pa.array(rows[:, c]) for c in range(3)], fields=list(run_type))
            ends = pa.array(np.cumsum([0, *map(len, runs)]), pa.int32())
            left = [b" ".join(collapsed(t, r)).decode() for t, r in zip(texts, runs)]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.ListArray.from_arrays(ends, flat),
                 pa.array([len(t) for t in texts], pa.int64()), pa.array(left, pa.string())],
                ["doc_id", "runs", "n_words", "text"])

    return head.mapInArrow(run, f"doc_id {id_type}, runs array<struct<start:long,length:long,period:long>>, "
                                "n_words long, text string")


def digest(runs: list[tuple[int, int, int]]) -> str:
    """What ``runs_sha256`` is to be, for tests."""
    return hashlib.sha256("".join(f"{a},{b},{q}\n" for a, b, q in runs).encode()).hexdigest()


def query(docs: DataFrame) -> DataFrame:
    found = detect(docs, plant=True)
    # the greatest length first, of equal ones the smallest start, then period
    best = F.array_min(F.transform("runs", lambda r: F.struct(
        (-r["length"]).alias("minus"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
        (-F.col("best.minus")).alias("length"), F.col("best.period").alias("period"),
        F.expr("1000 * -best.minus div best.period").alias("exponent_milli"),
        F.sha2(F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise("")), 256)
        .alias("runs_sha256"),
        F.sha2("text", 256).alias("collapsed_sha256"))
