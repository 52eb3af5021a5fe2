"""Benchmark decontamination (operator 8).

The normalised words of the benchmark items form one generalised suffix
automaton.  Training documents stream through it; at every word the state
gives the longest suffix of the text read so far that occurs in an item.
Words inside a match of at least ``window`` words (or inside a whole shorter
item) are hit; :func:`clean` removes the hit spans and drops documents whose
hit share exceeds the coverage limit.

Defined results: a null text has no words; an item without words matches
nothing; an empty benchmark hits nothing; repeated rows are judged one by one;
items of equal text are all reported; items with a null id still hit words but
are not listed.  Only the id and text columns of either table are read, so
further columns may have any name.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 10
#: Bytes of benchmark text in one automaton.  A larger benchmark is dealt to
#: several automata, each over its own items, and their hits are united.
MAX_INDEX_BYTES = 32 << 20
#: Share of hit words from which :func:`clean` drops the whole document.
MAX_COVERAGE = 0.5

#: A-Z to lower case; the bytes of [\x00-\x2F\x3A-\x60\x7B-\x7F] to a blank.
NORMAL = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
               for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(NORMAL).split() if text else []


class Automaton:
    """Generalised suffix automaton over word sequences.

    ``vocab`` numbers the words; ``step[s]`` maps a word number to the next
    state, ``link[s]`` is the state of the longest suffix in another class,
    ``size[s]`` the longest string of ``s``.
    """

    def __init__(self, items: Iterable[tuple[object, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.vocab: dict[bytes, int] = {}
        self.step: list[dict[int, int]] = [{}]
        self.link, self.size = [-1], [0]
        numbered = []
        for item_id, words in items:
            if words:
                seq = [self.vocab.setdefault(w, len(self.vocab)) for w in words]
                numbered.append((item_id, seq))
                self._add(seq)
        self._mark(numbered)
        pairs = {a * len(self.vocab) + b for _, s in numbered for a, b in zip(s, s[1:])}
        self.pairs = np.array(sorted(pairs), dtype=np.int64)
        self.shortest = min((min(window, len(s)) for _, s in numbered), default=window)

    def _add(self, seq: list[int]) -> None:
        last = 0
        for c in seq:
            last = self._extend(last, c)

    def _extend(self, p: int, c: int) -> int:
        step, link, size = self.step, self.link, self.size
        q = step[p].get(c)
        if q is not None and size[q] == size[p] + 1:
            return q
        if q is None:
            cur = self._state({}, size[p] + 1)
            while p >= 0 and c not in step[p]:
                step[p][c] = cur
                p = link[p]
            if p < 0:
                link[cur] = 0
                return cur
            q = step[p][c]
            link[cur] = q if size[q] == size[p] + 1 else self._clone(p, c, q)
            return cur
        return self._clone(p, c, q)

    def _state(self, step: dict[int, int], size: int) -> int:
        self.step.append(step)
        self.size.append(size)
        self.link.append(0)
        return len(self.size) - 1

    def _clone(self, p: int, c: int, q: int) -> int:
        new = self._state(dict(self.step[q]), self.size[p] + 1)
        self.link[new], self.link[q] = self.link[q], new
        while p >= 0 and self.step[p].get(c) == q:
            self.step[p][c] = new
            p = self.link[p]
        return new

    def _mark(self, numbered: list[tuple[object, list[int]]]) -> None:
        """Items by the state of each of their windows.

        ``home[s]`` is the state of the last ``window`` words of any match that
        ends in ``s``; ``whole[s]`` lists (words, item) of the shorter items that
        are suffixes of the strings of ``s``.
        """
        w = self.window
        order = np.argsort(self.size, kind="stable").tolist()
        self.home = [-1] * len(self.size)
        for s in order[1:]:
            if self.size[s] >= w:
                self.home[s] = s if self.size[self.link[s]] < w else self.home[self.link[s]]
        self.items: dict[int, set] = {}
        self.whole: dict[int, list[tuple[int, object]]] = {}
        for item_id, seq in numbered:
            s = 0
            for i, c in enumerate(seq, 1):
                s = self.step[s][c]
                if i >= w:
                    self.items.setdefault(self.home[s], set()).add(item_id)
            if len(seq) < w:
                self.whole.setdefault(s, []).append((len(seq), item_id))
        if self.whole:
            for s in order[1:]:
                up = self.whole.get(self.link[s])
                if up:
                    self.whole[s] = self.whole.get(s, []) + up

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Spans ``[start, end)`` of hit words, merged and in order, and the items met."""
        n = len(words)
        if n < self.shortest or not self.vocab:
            return [], set()
        codes = np.fromiter(map(self.vocab.get, words, repeat(-1)), np.int64, n)
        spans: list[tuple[int, int]] = []
        met: set = set()
        for a, b in self._runs(codes):
            self._walk(codes[a:b].tolist(), a, spans, met)
        merged: list[list[int]] = []
        for a, b in sorted(spans):
            if merged and a <= merged[-1][1]:
                merged[-1][1] = max(b, merged[-1][1])
            else:
                merged.append([a, b])
        return [(a, b) for a, b in merged], met

    def _runs(self, codes: np.ndarray) -> list[tuple[int, int]]:
        """Stretches in which every word and word pair occurs in an item and
        which are long enough for a window: outside them no match can be."""
        if self.shortest == 1:
            inside = codes >= 0
            edge = np.flatnonzero(np.diff(np.concatenate(([0], inside.view(np.int8), [0]))))
            return [(a, b) for a, b in edge.reshape(-1, 2).tolist()]
        pair = codes[:-1] * len(self.vocab) + codes[1:]
        pair[(codes[:-1] < 0) | (codes[1:] < 0)] = -1
        known = np.flatnonzero(pair >= 0)
        at = np.searchsorted(self.pairs, pair[known])
        inside = np.zeros(len(pair), np.int8)
        inside[known] = self.pairs[np.minimum(at, len(self.pairs) - 1)] == pair[known]
        edge = np.flatnonzero(np.diff(np.concatenate(([0], inside, [0])))).reshape(-1, 2)
        edge = edge[edge[:, 1] - edge[:, 0] + 1 >= self.shortest]
        return [(a, b + 1) for a, b in edge.tolist()]

    def _walk(self, run: list[int], at: int, spans: list[tuple[int, int]], met: set) -> None:
        step, link, size, w = self.step, self.link, self.size, self.window
        s = length = 0
        for i, c in enumerate(run, at + 1):
            while s and c not in step[s]:
                s = link[s]
                length = size[s]
            if c in step[s]:
                s = step[s][c]
                length += 1
            if length >= w:
                if spans and spans[-1][0] == i - length:
                    spans[-1] = (i - length, i)
                else:
                    spans.append((i - length, i))
                met |= self.items[self.home[s]]
            for size_, item in self.whole.get(s, ()):
                if size_ <= length:
                    spans.append((i - size_, i))
                    met.add(item)


def automata(benchmark: DataFrame, window: int = WINDOW, item_col: str = "item_id",
             text_col: str = "text", max_bytes: int = MAX_INDEX_BYTES) -> list[Automaton]:
    """Automata over the whole benchmark, each of at most about ``max_bytes`` of text.

    The benchmark's size is checked first; what one automaton can't hold goes to
    further ones by the item's hash.
    """
    items = benchmark.select(F.col(item_col).alias("item"), F.col(text_col).alias("text")).where(
        F.col("text").isNotNull())
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = -(-total // max_bytes) or 1
    dealt = items.withColumn("part", F.pmod(F.xxhash64("item", "text"), F.lit(parts)))
    return [Automaton(((r.item, words_of(r.text))
                       for r in dealt.where(F.col("part") == i).orderBy("item", "text").toLocalIterator()),
                      window)
            for i in range(parts)]


def _scan(index, ids: pa.Array, texts: pa.Array) -> pa.RecordBatch:
    n_words, n_hit, items, spans = [], [], [], []
    for text in texts.to_pylist():
        words = words_of(text)
        found, met = index.hits(words)
        n_words.append(len(words))
        n_hit.append(sum(b - a for a, b in found))
        items.append(sorted({str(m) for m in met if m is not None}))
        spans.append([{"start": a, "end": b} for a, b in found])
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    return pa.RecordBatch.from_arrays(
        [ids, pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()),
         pa.array(items, pa.list_(pa.string())), pa.array(spans, span)],
        names=["doc_id", "n_words", "n_hit", "items", "spans"])


class _All:
    """Several automata as one."""

    def __init__(self, parts: list[Automaton]):
        self.parts = parts

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        if len(self.parts) == 1:
            return self.parts[0].hits(words)
        spans, met = [], set()
        for part in self.parts:
            found, items = part.hits(words)
            spans += found
            met |= items
        merged: list[tuple[int, int]] = []
        for a, b in sorted(spans):
            if merged and a <= merged[-1][1]:
                merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
            else:
                merged.append((a, b))
        return merged, met


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id",
         text_col: str = "text", max_bytes: int = MAX_INDEX_BYTES) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_hit, items, spans``.

    ``items`` are the ids, as sorted strings, of the items with an occurring
    window; ``spans`` the hit stretches as word positions, end exclusive.
    """
    sc = docs.sparkSession.sparkContext
    shared = [sc.broadcast(a) for a in automata(benchmark, window, max_bytes=max_bytes)]
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        index = _All([b.value for b in shared])
        for batch in batches:
            yield _scan(index, batch.column(0), batch.column(1))

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"doc_id {id_type}, n_words long, n_hit long, items array<string>, "
             "spans array<struct<start:int,end:int>>")


def remove_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the words of ``spans`` (word positions, end exclusive)."""
    raw = text.encode()
    at = [m.span() for m in re.finditer(rb"[^ ]+", raw.translate(NORMAL))]
    kept, pos = [], 0
    for a, b in spans:
        kept.append(raw[pos:at[a][0]])
        pos = at[b - 1][1]
    kept.append(raw[pos:])
    return b"".join(kept).decode()


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
          max_coverage: float = MAX_COVERAGE, text_col: str = "text",
          length_col: str | None = "n_chars", max_bytes: int = MAX_INDEX_BYTES) -> DataFrame:
    """``docs`` (all columns) without benchmark passages.

    Hit spans are cut out of the text (``length_col``, if the table has it, follows);
    a document whose hit words are more than ``max_coverage`` of its words goes.
    A narrow map: no row of ``docs`` is shuffled.
    """
    sc = docs.sparkSession.sparkContext
    shared = [sc.broadcast(a) for a in automata(benchmark, window, max_bytes=max_bytes)]
    names, at = docs.columns, docs.columns.index(text_col)
    length_at = names.index(length_col) if length_col in names else None

    def run(batches):
        index = _All([b.value for b in shared])
        for batch in batches:
            keep, texts, sizes = [], batch.column(at).to_pylist(), None
            if length_at is not None:
                sizes = batch.column(length_at).to_pylist()
            for i, text in enumerate(texts):
                words = words_of(text)
                spans, _ = index.hits(words)
                if not spans:
                    keep.append(True)
                    continue
                keep.append(sum(b - a for a, b in spans) <= max_coverage * len(words))
                texts[i] = remove_spans(text, spans)
                if sizes is not None:
                    sizes[i] = len(texts[i])
            columns = list(batch.columns)
            columns[at] = pa.array(texts, batch.schema.field(at).type)
            if sizes is not None:
                columns[length_at] = pa.array(sizes, batch.schema.field(length_at).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema).filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)


def query(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    found = scan(docs, benchmark)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


#: DuckDB statement with the rows of :func:`query`.
SQL = r"""
WITH item AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL),
gram AS (
  SELECT item_id, n, array_to_string(w[p:p + n - 1], ' ') AS g
  FROM (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS p
        FROM item WHERE len(w) > 0)),
doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
place AS (
  SELECT doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p
        FROM doc CROSS JOIN (SELECT DISTINCT n FROM gram) WHERE len(w) >= n)),
met AS (
  SELECT doc_id, p, place.n, item_id FROM place JOIN gram ON place.g = gram.g AND place.n = gram.n),
hit AS (
  SELECT doc_id, count(DISTINCT q) AS n_hit
  FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM met) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM met WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT doc.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""
