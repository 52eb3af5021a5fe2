"""Exact substring removal with suffix arrays (operator 5).

Removes each byte that a string of ``LENGTH`` bytes covers which also starts in a
document with a smaller id.

Every window of ``LENGTH`` bytes has an anchor, its ``ANCHOR``-byte string of least
hash.  Equal windows have equal anchors, so only texts around equal anchors need
be compared, in three steps:

1. A document is cut into pieces, each the text of neighbouring windows with one
   anchor.  Pieces are dealt by anchor.  Where a smaller document has the whole
   piece, it is removed.  Where another piece of the anchor is alike in one of the
   stretches of 44 bytes that a shared window would cover, the first document's
   piece is a candidate.  All other pieces have no repeated window.
2. Candidate texts are dealt by anchor again, joined to blocks, and each block gets
   a suffix array by linear grouping (:mod:`skyfold.llm.suffix_groups`).  Equal
   windows are neighbours there; those not of the smallest document are removed.
3. The spans are united and cut out of the texts.

A piece found in very many documents costs a row for each input batch at most: the
batch settles all but its first document itself.  An anchor with very many different
pieces in a batch is spread by piece, and its candidates are compared by two 64-bit
hashes of each window instead of in one block.  No text is shuffled but once, by id.

Defined results: a null text is empty; rows with a null id are compared with
nothing; rows that repeat an id remove nothing from each other, each is compared with the
smaller ids only; ids may be any 64-bit numbers; an empty table gives no rows.
"""

from __future__ import annotations

import gc
import time
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skyfold.llm.common import slices, stored
from skyfold.llm.suffix_groups import suffix_array

LENGTH, ANCHOR = 50, 24
#: Bytes to the left and right of an anchor: every window around it covers at least one of
#: these stretches whole, whatever its place.
STRETCHES = ((0, 20), (7, 14), (13, 7), (20, 0))
#: Different pieces of an anchor in one batch from which the anchor is spread by piece.
SPREAD = 64
#: Candidates of an anchor above which they are compared window by window.
MAX_GROUP = 5_000
#: Bytes of text cut together, of a segment of a long text, and of a suffix array's block (one that
#: stays in the processor cache is twice as fast as one of 64 KB); rows judged together.
BATCH_BYTES, SEGMENT, BLOCK, ROWS = 16 << 20, 1 << 20, 1 << 13, 500_000
#: Bytes of texts whose pieces are made together, and of texts whose spans are handled together.
GROUP, TEXT_BYTES = 1 << 16, 1 << 20

REMOVED, PIECE, SPREAD_PIECE, MARK, WINDOWS, CANDIDATE = range(6)

_PLACE = np.uint64((1 << 21) - 1)  # places in a segment and its overlap
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_OF_BYTE = ((np.arange(256, dtype=np.uint64) + np.uint64(1)) * _A) ^ ((np.arange(256, dtype=np.uint64) + np.uint64(77)) * _B)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _A
    return x ^ (x >> np.uint64(29))


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return _mix(a * _B + b)


def _hashes(b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all 8- and 16-byte strings."""
    h = _OF_BYTE[b]
    out = []
    for n in (1, 2, 4, 8):
        h = _pair(h[:-n], h[n:])
        out.append(h)
    return out[2], out[3]


def _least(h: np.ndarray, width: int) -> np.ndarray:
    """Place of the leftmost least value of every ``width`` neighbours; values count by
    their upper 43 bits, places take the rest."""
    value, done = (h & ~_PLACE) | np.arange(len(h), dtype=np.uint64), 1
    while done < width:
        by = min(done, width - done)
        value = np.minimum(value[:-by], value[by:])
        done += by
    return (value & _PLACE).astype(np.int64)


def pieces(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, length, anchor hash and hash of every piece of a text, and its stretches
    (four 7-bit hashes, 0 where the piece does not reach so far)."""
    parts = []
    for a in range(0, len(raw) - LENGTH + 1, SEGMENT):
        _, start, *rest = pieces_of([raw[a:a + SEGMENT + LENGTH - 1]])
        parts.append((start + a, *rest))
    return tuple(np.concatenate(c) for c in zip(*parts)) if parts else pieces_of([])[1:]


def pieces_of(raws: list[bytes]) -> tuple[np.ndarray, ...]:
    """Of each piece of texts of ``LENGTH`` bytes or more, together no longer than a segment, the
    number of its text, then as ``pieces``."""
    if not raws:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2 + (np.zeros(0, np.int64),)
    b = np.frombuffer(b"".join(raws), np.uint8)
    sizes = np.array([len(r) for r in raws])
    begin = np.cumsum(sizes) - sizes
    past = begin + sizes - LENGTH + 1  # of the text's windows
    h8, h16 = _hashes(b)
    anchor = _pair(h16[:len(b) - ANCHOR + 1], h8[16:16 + len(b) - ANCHOR + 1])
    place = _least(anchor, LENGTH - ANCHOR + 1)
    edge = np.zeros(len(place) + 1, np.int8)
    edge[begin], edge[past] = 1, -1
    inside = np.cumsum(edge[:-1], dtype=np.int8) > 0
    new = inside.copy()
    new[1:] &= (place[1:] != place[:-1]) | ~inside[:-1]
    first = np.flatnonzero(new)
    of = np.searchsorted(begin, first, "right") - 1
    size = np.minimum(np.append(first[1:], len(place)), past[of]) - first + LENGTH - 1
    at = place[first]
    whole = _pair(h16[first], size.astype(np.uint64))
    for step in (16, 32, 48):
        whole = _pair(whole, h16[first + np.minimum(step, size - 16)])
    whole = _pair(whole, h16[first + size - 16])
    beside = np.zeros(len(first), np.int64)
    for i, (left, right) in enumerate(STRETCHES):
        rows = np.flatnonzero((at - left >= first) & (at + ANCHOR + right <= first + size))
        start, n = at[rows] - left, left + ANCHOR + right
        h = _pair(_pair(h16[start], h16[start + 16]), h16[start + n - 16])
        beside[rows] |= (h % np.uint64(127) + np.uint64(1)).astype(np.int64) << (7 * i)
    return of, first - begin[of], size, anchor[at], whole, beside


def merged(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of the union of spans."""
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order]) if len(end) else end
    new = np.concatenate(([True], start[1:] > end[:-1])) if len(start) else np.zeros(0, bool)
    heads = np.flatnonzero(new)
    return start[heads], end[np.append(heads[1:], len(start)) - 1] if len(heads) else end


def _spans(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """Spans of many documents, merged within each."""
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], end[order]
    cuts = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])) if len(doc) else np.zeros(0, bool))
    rank = np.zeros(len(doc), np.int64)
    rank[cuts[1:]] = 1
    shift = np.cumsum(rank) * (int(end.max(initial=0)) + 2)  # documents one behind the other
    a, b = merged(start + shift, end + shift)
    at = np.searchsorted(start + shift, a)
    return doc[at], a - shift[at], b - shift[at]


def is_later(doc: np.ndarray, first: np.ndarray, shift: int) -> np.ndarray:
    """Which documents have a greater id than the first that has the same string; below
    ``shift`` bits, documents tell the rows of one id apart."""
    return (doc >> shift) > (first >> shift)


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Where a new run of equal keys begins."""
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return new


#: Kind and document first: in the order of documents they repeat from row to row and pack well.
ROW = "kind short, doc long, key long, piece long, place long"


def _batch(columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({k: pa.array(v) for k, v in columns.items()})


def _row(kind, key, piece, doc, place) -> pa.RecordBatch:
    n = len(doc)
    full = lambda v, t: np.full(n, v, t) if np.isscalar(v) else v.astype(t, copy=False)
    return _batch({"kind": full(kind, np.int16), "doc": full(doc, np.int64), "key": full(key, np.int64),
                   "piece": full(piece, np.int64), "place": full(place, np.int64)})


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _packed(start: np.ndarray, size: np.ndarray, beside: np.ndarray) -> np.ndarray:
    """Start (31 bits), length beyond LENGTH (5 bits) and the stretches (28 bits)."""
    return (start << 33) | ((size - LENGTH) << 28) | beside


def _cut(batches: Iterator[pa.RecordBatch], shift: int = 0) -> Iterator[pa.RecordBatch]:
    """Task: documents to pieces.  Of a piece only its first document of the batch goes
    on; the later ones are settled here."""
    def flush(found: list[tuple]) -> Iterator[pa.RecordBatch]:
        doc, start, size, anchor, whole, beside = (np.concatenate(c) for c in zip(*found))
        order = np.argsort(_pair(anchor, whole))
        by_anchor, by_whole, by_doc = anchor[order], whole[order], doc[order]
        new = _runs(by_anchor, by_whole)
        heads = np.flatnonzero(new)
        first = np.minimum.reduceat(by_doc, heads)
        later = np.empty(len(doc), bool)
        later[order] = is_later(by_doc, first[np.cumsum(new) - 1], shift)
        if later.any():
            d, a, b = _spans(doc[later], start[later], (start + size)[later])
            yield _row(REMOVED, d, a, d, b)  # the piece column carries the start
        different = np.sort(by_anchor[heads])
        at = np.flatnonzero(_runs(different))
        many = different[at[np.diff(np.append(at, len(different))) >= SPREAD]]
        kind = np.full(len(doc), PIECE, np.int16)
        if len(many):
            yield _row(MARK, _signed(many), np.iinfo(np.int64).min, np.zeros(len(many), np.int64), 0)
            kind[np.isin(anchor, many)] = SPREAD_PIECE
        own = ~later
        yield _row(kind[own], _signed(anchor[own]), _signed(whole[own]), doc[own], _packed(start, size, beside)[own])

    found, size, group, held = [], 0, ([], []), 0

    def together() -> None:
        nonlocal held
        if group[0]:
            of, *rest = pieces_of(group[1])
            found.append((np.array(group[0], np.int64)[of], *rest))
            for c in group:
                c.clear()
        held = 0

    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            raw = text.encode() if text else b""
            if len(raw) < LENGTH:
                continue
            if held + len(raw) > GROUP:
                together()
            if len(raw) > GROUP:
                start, *rest = pieces(raw)
                found.append((np.full(len(start), doc, np.int64), start, *rest))
            else:
                group[0].append(doc)
                group[1].append(raw)
                held += len(raw)
            size += len(raw)
            if size >= BATCH_BYTES:
                together()
                yield from flush(found)
                found, size = [], 0
    together()
    if found:
        yield from flush(found)


def _judged(kind, key, piece, doc, place, shift: int = 0) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key, piece and document, all rows of each piece together; all rows of
    a key too, unless it is marked or spread."""
    new = _runs(key, piece)
    later = is_later(doc, doc[np.flatnonzero(new)][np.cumsum(new) - 1], shift)
    start, size = place >> 33, ((place >> 28) & 31) + LENGTH
    if later.any():
        d, a, b = _spans(doc[later], start[later], (start + size)[later])
        yield _batch({"kind": np.full(len(d), REMOVED, np.int16), "key": np.zeros(len(d), np.int64), "doc": d, "start": a, "end": b})
    heads = np.flatnonzero(_runs(key))
    group = np.cumsum(_runs(key)) - 1
    wanted = np.add.reduceat((kind != PIECE).astype(np.int64), heads)[group] > 0
    one = np.flatnonzero(new & (kind != MARK))  # a row for each piece
    for i in range(len(STRETCHES)):
        side = (place[one] >> (7 * i)) & 127
        rows = one[side > 0]
        side = side[side > 0]
        if not len(rows):
            continue
        order = np.lexsort((side, group[rows]))
        rows, side = rows[order], side[order]
        at = np.flatnonzero(_runs(group[rows], side))
        alike = is_later(np.maximum.reduceat(doc[rows], at), np.minimum.reduceat(doc[rows], at), shift)
        hit = np.zeros(len(doc), bool)
        hit[rows] = np.repeat(alike, np.diff(np.append(at, len(rows))))
        wanted |= hit[np.flatnonzero(new)][np.cumsum(new) - 1]
    keep = wanted & ~later & (kind != MARK)
    if keep.any():
        yield _batch({"kind": np.full(keep.sum(), CANDIDATE, np.int16), "key": key[keep], "doc": doc[keep],
                      "start": start[keep], "end": (start + size)[keep]})


def _match(batches: Iterator[pa.RecordBatch], shift: int = 0) -> Iterator[pa.RecordBatch]:
    """Task: pieces sorted by key (the anchor), piece and document, judged key by key."""
    parts: list[list[np.ndarray]] = []
    rows = 0

    def columns() -> list[np.ndarray]:
        return [np.concatenate(c) for c in zip(*parts)]

    for batch in batches:
        c = [x.to_numpy() for x in batch.columns]
        settled = c[0] == REMOVED
        if settled.any():
            yield _batch({"kind": c[0][settled], "key": np.zeros(settled.sum(), np.int64), "doc": c[1][settled],
                          "start": c[3][settled], "end": c[4][settled]})
        kind, doc, key, piece, place = (x[~settled] for x in c)
        parts.append([kind, key, piece, doc, place])
        rows += int((~settled).sum())
        if rows < ROWS:
            continue
        kind, key, piece, doc, place = columns()
        end = int(np.flatnonzero(_runs(key))[-1])
        if not end:  # one anchor fills the buffer: its pieces are judged one by one, all candidates
            end = int(np.flatnonzero(_runs(piece))[-1])
            kind = kind.copy()
            kind[:] = np.where(kind == PIECE, SPREAD_PIECE, kind)
        if end:
            yield from _judged(kind[:end], key[:end], piece[:end], doc[:end], place[:end], shift)
        parts = [[kind[end:], key[end:], piece[end:], doc[end:], place[end:]]]
        rows = len(kind) - end
    if rows:
        yield from _judged(*columns(), shift)


FOUND = "kind short, key long, doc long, start long, end long"
TEXT = "kind short, key long, key2 long, doc long, start long, end long, text binary"


def _texts(batches: Iterator[pa.RecordBatch], shift: int = 0) -> Iterator[pa.RecordBatch]:
    """Task: candidates of each document with their texts, or with the hashes of
    their windows where the anchor has too many."""
    for batch in slices(batches, 1, max_bytes=TEXT_BYTES):
        of, start, end, key, many = _flat(batch.column(2))
        raws = [text.encode() for text in batch.column(1).to_pylist()]
        doc = batch.column(0).to_numpy()[of]
        parts = [raws[i][a:b] for i, a, b in zip(of.tolist(), start.tolist(), end.tolist())]
        own = ~many
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(own.sum(), CANDIDATE, np.int16)), pa.array(key[own]), pa.array(np.zeros(own.sum(), np.int64)),
             pa.array(doc[own]), pa.array(start[own]), pa.array(end[own]),
             pa.array([p for p, m in zip(parts, many.tolist()) if not m], pa.binary())],
            ["kind", "key", "key2", "doc", "start", "end", "text"])
        if many.any():
            at = np.flatnonzero(many)
            yield from _window_rows(list(zip(doc[at].tolist(), start[at].tolist(), [parts[i] for i in at.tolist()])), shift)


def _flat(lists: pa.ListArray) -> tuple[np.ndarray, ...]:
    """Of the structs in lists the number of their list, then their fields; null lists are empty."""
    n = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
    return np.repeat(np.arange(len(lists)), n), *(c.to_numpy(zero_copy_only=False) for c in lists.flatten().flatten())


def _text_batch(out: dict) -> pa.RecordBatch:
    types = (pa.int16(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), types)], list(out))


def _window_rows(parts: list[tuple[int, int, bytes]], shift: int = 0) -> Iterator[pa.RecordBatch]:
    b = np.frombuffer(b"".join(p for _, _, p in parts), np.uint8)
    sizes = np.array([len(p) for _, _, p in parts])
    base = np.cumsum(sizes) - sizes
    n = sizes - LENGTH + 1
    inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    at = np.repeat(base, n) + inner
    doc = np.repeat(np.array([d for d, _, _ in parts], np.int64), n)
    start = np.repeat(np.array([s for _, s, _ in parts], np.int64), n) + inner
    _, h16 = _hashes(b)
    cuts = [h16[at + i] for i in (0, 16, 32, LENGTH - 16)]
    one, two = _pair(_pair(cuts[0], cuts[1]), _pair(cuts[2], cuts[3])), _pair(_pair(cuts[3], cuts[1] ^ _A), _pair(cuts[0], cuts[2]))
    order = np.lexsort((doc, two, one))
    one, two, doc, start = one[order], two[order], doc[order], start[order]
    new = _runs(one, two)
    later = is_later(doc, doc[np.flatnonzero(new)][np.cumsum(new) - 1], shift)
    for kind, rows in ((REMOVED, later), (WINDOWS, ~later)):
        if rows.any():
            key, key2 = (doc[rows], start[rows]) if kind == REMOVED else (_signed(one[rows]), _signed(two[rows]))
            yield _text_batch({"kind": np.full(rows.sum(), kind, np.int16), "key": key, "key2": key2, "doc": doc[rows],
                               "start": start[rows], "end": start[rows] + LENGTH,
                               "text": pa.nulls(int(rows.sum()), pa.binary())})


def repeats(parts: list[tuple[int, int, bytes]], shift: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, start and end of the windows of the texts ``(doc, start, bytes)`` that a
    smaller document has too, by the suffix array of all texts together."""
    joined = b"\x00".join(p for _, _, p in parts) + b"\x00"  # the cut after each text
    raw = np.frombuffer(joined, np.uint8)
    sizes = np.array([len(p) for _, _, p in parts])
    base = np.cumsum(sizes + 1) - sizes - 1
    codes = raw.astype(np.int64) + 1
    codes[base + sizes] = 0  # a zero byte of a text is not the cut
    order = suffix_array(codes)
    owner = np.repeat(np.arange(len(parts)), sizes + 1)
    inside = (base + sizes)[owner[order]] - order >= LENGTH
    order = order[inside]
    window = np.lib.stride_tricks.sliding_window_view(raw, LENGTH)[order]
    new = np.ones(len(order), bool)
    new[1:] = (window[1:] != window[:-1]).any(axis=1)
    doc = np.array([d for d, _, _ in parts], np.int64)[owner[order]]
    heads = np.flatnonzero(new)
    first = np.minimum.reduceat(doc, heads)[np.cumsum(new) - 1] if len(heads) else doc
    later = is_later(doc, first, shift)
    own = owner[order][later]
    start = np.array([s for _, s, _ in parts], np.int64)[own] + order[later] - base[own]
    return _spans(doc[later], start, start + LENGTH)


def _sorted_blocks(batches: Iterator[pa.RecordBatch], shift: int = 0) -> Iterator[pa.RecordBatch]:
    """Task: rows sorted by key, key2 and document.  Candidates are gathered to blocks of
    whole keys, each with a suffix array; window rows are judged by their first document."""
    def give(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.RecordBatch:
        return _batch({"doc": doc, "start": start, "end": end})

    block: list[tuple[int, int, bytes]] = []
    size, last, first_of = 0, None, (None, None, 0)
    for batch in batches:
        c = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
        kind = c["kind"].to_numpy()
        doc, start, end = (c[n].to_numpy() for n in ("doc", "start", "end"))
        plain = kind == REMOVED
        rows = np.flatnonzero(kind == WINDOWS)
        if len(rows):
            key, key2 = c["key"].to_numpy()[rows], c["key2"].to_numpy()[rows]
            new = _runs(key, key2)
            first = doc[rows][np.flatnonzero(new)][np.cumsum(new) - 1]
            if (key[0], key2[0]) == first_of[:2]:  # goes on from the batch before
                first[np.cumsum(new) == 1] = first_of[2]
            plain[rows] = is_later(doc[rows], first, shift)
            first_of = (key[-1], key2[-1], first[-1])
        if plain.any():
            yield give(*_spans(doc[plain], start[plain], end[plain]))
        rows = np.flatnonzero(kind == CANDIDATE)
        texts = c["text"].take(pa.array(rows)).to_pylist()
        keys = c["key"].to_numpy()[rows].tolist()
        for k, d, s, t in zip(keys, doc[rows].tolist(), start[rows].tolist(), texts):
            if k != last and size >= BLOCK:
                yield give(*repeats(block, shift))
                block, size = [], 0
            last = k
            block.append((d, s, t))
            size += len(t) + 1
    if block:
        yield give(*repeats(block, shift))


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task: documents with the spans to remove."""
    for batch in slices(batches, 1, max_bytes=TEXT_BYTES):
        raws = [text.encode() if text else b"" for text in batch.column(1).to_pylist()]
        of, a, b = _spans(*_flat(batch.column(2)))
        ends = np.cumsum(np.bincount(of, minlength=len(raws)))
        kept, i, starts, stops = [], 0, a.tolist(), b.tolist()
        for raw, j in zip(raws, ends.tolist()):
            kept.append(b"".join([raw[x:y] for x, y in zip([0, *stops[i:j]], [*starts[i:j], len(raw)])]) if j > i else raw)
            i = j
        spans = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)).astype(np.int32)),
                                         pa.StructArray.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["start", "end"]))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([len(raw) for raw in raws], pa.int64()), spans, pa.array(kept, pa.binary())],
            ["doc", "n_bytes", "spans", "kept"])


def _release(spark) -> None:
    """Shuffle files of finished steps go when the driver's garbage is collected: once for
    what Python holds of them, once more for what that has freed."""
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)


RESULT = "doc long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary"


#: Parts that the rows of one id are numbered in.
PARTS = 256


def numbered(named: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """Rows ``doc, text`` that repeat ids: a number per different row, whose bits above
    the returned shift are in the order of the ids; and ``doc, doc_id, copies``, the id each
    stands for and how many equal rows."""
    rows = named.groupBy("doc", "text").agg(F.count("*").alias("copies"))
    part = F.pmod(F.xxhash64("text"), F.lit(PARTS))
    nth = F.row_number().over(Window.partitionBy("doc", "part").orderBy("text")).cast("long") - 1
    rows = stored(rows.withColumn("part", part).withColumn("nth", nth * PARTS + F.col("part")).drop("part"), "suffix-rows")
    # a number for each id in their order: the place after a range partitioned sort
    ids = stored(rows.select("doc").distinct().repartitionByRange("doc").sortWithinPartitions("doc")
                 .withColumn("at", F.monotonically_increasing_id()), "suffix-ids")
    before, offset = 0, {}
    for r in ids.groupBy(F.shiftright("at", 33).alias("p")).count().orderBy("p").collect():  # a row a partition
        offset[r.p], before = before, before + r["count"]
    base = F.create_map(*[F.lit(x) for kv in offset.items() for x in kv]) if offset else F.lit(None).cast("map<long,long>")
    rank = base[F.shiftright("at", 33)] + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    shift = int(rows.agg(F.max("nth")).first()[0] or 0).bit_length()
    if before.bit_length() + shift > 63:
        raise ValueError("more rows of one id times ids than 63 bits can number")
    code = (F.shiftleft(rank.cast("long"), shift) + F.col("nth")).alias("code")
    rows = stored(rows.join(ids, "doc").select(code, "doc", "text", "copies"), "suffix-docs")
    return (rows.select(F.col("code").alias("doc"), "text"),
            rows.select(F.col("code").alias("doc"), F.col("doc").alias("doc_id"), "copies"), shift)


def dedup(docs: DataFrame, max_group: int = MAX_GROUP, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, spans, kept``: the byte spans removed, maximal and in order, and
    the remaining bytes."""
    spark = docs.sparkSession
    head = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    named, shift = head.where("doc IS NOT NULL"), 0
    apart = named.groupBy("doc").agg(F.count("*").alias("n")).where("n > 1").limit(1).count() > 0
    if apart:
        named, of, shift = numbered(named)
    cut, match, texts, blocks = (partial(f, shift=shift) for f in (_cut, _match, _texts, _sorted_blocks))
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spread = F.when(F.col("kind") == SPREAD_PIECE, F.pmod("piece", F.lit(256))).otherwise(0)
    found = stored(
        named.mapInArrow(cut, ROW).repartition(width, F.col("key"), spread)
        .sortWithinPartitions("key", "piece", "doc").mapInArrow(match, FOUND), "suffix-found")
    _release(spark)
    candidates = found.where(F.col("kind") == CANDIDATE)
    many = stored(candidates.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > max_group).select("key"),
                  "suffix-many")
    marked = candidates.join(many.withColumn("many", F.lit(True)), "key", "left")
    spots = marked.groupBy("doc").agg(F.collect_list(F.struct(
        "start", "end", "key", F.coalesce("many", F.lit(False)).alias("many"))).alias("spots"))
    # dealt by id once: the second step and the third read the same exchange
    dealt = named.repartition(width, "doc")
    compared = (
        dealt.join(spots.hint("shuffle_hash"), "doc").select("doc", "text", "spots").mapInArrow(texts, TEXT)
        .repartition(width, "key", "key2").sortWithinPartitions("key", "key2", "doc")
        .mapInArrow(blocks, "doc long, start long, end long"))
    spans = found.where(F.col("kind") == REMOVED).select("doc", "start", "end").union(compared)
    cuts = spans.groupBy("doc").agg(F.collect_list(F.struct("start", "end")).alias("cuts"))
    out = dealt.join(cuts.hint("shuffle_hash"), "doc", "left").select("doc", "text", "cuts").mapInArrow(_apply, RESULT)
    if apart:
        out = (out.join(of, "doc").withColumn("n", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
               .select(F.col("doc_id").alias("doc"), "n_bytes", "spans", "kept"))
    unnamed = head.where("doc IS NULL").select("doc", "text", F.lit(None).cast(
        "array<struct<start:long,end:long>>").alias("cuts")).mapInArrow(_apply, RESULT)
    return out.union(unnamed).withColumnRenamed("doc", "doc_id")


def query(docs: DataFrame) -> DataFrame:
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s.end - s.start)
    return dedup(docs).select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))
