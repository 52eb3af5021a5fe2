"""Suffix arrays and exact substring removal against brute force."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyfold.llm import suffix_dedup as D
from skyfold.llm.suffix_groups import suffix_array


def test_suffix_array_equals_sorting(rng):
    for _ in range(1500):
        a = rng.choice([1, 2, 3, 26])
        t = [rng.randrange(a) for _ in range(rng.randrange(60))]
        assert suffix_array(t).tolist() == sorted(range(len(t)), key=lambda i: t[i:])


def test_suffix_array_of_repeats():
    for t in ([0] * 500, [1, 0] * 200, [0, 1, 0, 0, 1] * 80, list(b"abracadabra" * 30)):
        assert suffix_array(t).tolist() == sorted(range(len(t)), key=lambda i: t[i:])


def brute(docs, n=50):
    """docs: (order, text); the spans of each."""
    first = {}
    raws = [(i, (t or "").encode()) for i, t in docs]
    for i, r in raws:
        for p in range(len(r) - n + 1):
            w = r[p:p + n]
            first[w] = min(first.get(w, i), i)
    out = []
    for i, r in raws:
        gone = np.zeros(len(r), bool)
        for p in range(len(r) - n + 1):
            if first[r[p:p + n]] < i:
                gone[p:p + n] = True
        edge = np.flatnonzero(np.diff(np.concatenate(([0], gone.view(np.int8), [0]))))
        out.append((len(r), [tuple(x) for x in edge.reshape(-1, 2).tolist()], r[:0].join(
            r[a:b] for a, b in zip([0, *edge[1::2].tolist()], [*edge[::2].tolist(), len(r)]))))
    return out


def planted(prose, rng):
    passages = [prose(rng.randint(8, 30)) for _ in range(8)] + ["é漢" * 30, "z" * 70, "All rights reserved. " * 3]
    texts = [" ".join(rng.choice([prose(rng.randint(1, 20)), rng.choice(passages)]) for _ in range(rng.randint(1, 5)))
             for _ in range(70)]
    texts += texts[:6] + ["", None, "x" * 49, "x" * 50, "x" * 51, "x" * 300, "ab" * 100, "\x00" * 80, "\x00" * 60]
    rng.shuffle(texts)
    return texts


def check(rows, docs):
    for (i, _), (size, spans, kept) in zip(docs, brute(docs), strict=True):
        r = rows[i]
        assert (r.n_bytes, [(s.start, s.end) for s in r.spans], bytes(r.kept)) == (size, spans, kept)


@pytest.mark.parametrize("max_group, spread, segment", [(5000, 64, 1 << 20), (1, 2, 1 << 20), (3, 64, 100)])
def test_dedup_equals_brute_force(make_docs, prose, rng, monkeypatch, max_group, spread, segment):
    monkeypatch.setattr(D, "SPREAD", spread)
    monkeypatch.setattr(D, "SEGMENT", segment)
    docs = list(enumerate(planted(prose, rng)))
    check({r.doc_id: r for r in D.dedup(make_docs(docs), max_group).collect()}, docs)


def run_tasks(docs, rows):
    """The two steps without Spark, in batches of few rows."""
    import pyarrow as pa

    def batches(table, n):
        return iter(pa.Table.from_batches(table).combine_chunks().to_batches(max_chunksize=n))

    inputs = [pa.RecordBatch.from_pydict({"doc": [d for d, _ in docs[i:i + 7]], "text": [t for _, t in docs[i:i + 7]]})
              for i in range(0, len(docs), 7)]
    cut = pa.Table.from_batches([b for x in inputs for b in D._cut(iter([x]))])
    cut = cut.sort_by([("key", "ascending"), ("piece", "ascending"), ("doc", "ascending")]).to_batches(max_chunksize=rows)
    return pa.Table.from_batches(list(D._match(iter(cut)))).to_pylist()


def test_small_buffers_lose_nothing(prose, rng, monkeypatch):
    docs = list(enumerate(planted(prose, rng)))
    whole = run_tasks(docs, 10_000)
    monkeypatch.setattr(D, "ROWS", 5)
    small = run_tasks(docs, 3)

    def removed(rows):
        return {(r["doc"], p) for r in rows if r["kind"] == D.REMOVED for p in range(r["start"], r["end"])}

    def candidates(rows):
        return {(r["doc"], r["start"], r["key"]) for r in rows if r["kind"] == D.CANDIDATE}

    assert removed(whole) == removed(small) and candidates(whole) <= candidates(small)


def test_repeats_of_texts(rng):
    base = bytes(rng.choice(b"ab") for _ in range(400))
    parts = [(d, 1000 * d, base[a:a + rng.randint(50, 76)]) for d in range(12) for a in (rng.randrange(320),)]
    doc, start, end = D.repeats(parts)
    got = {(d, p) for d, s, e in zip(doc.tolist(), start.tolist(), end.tolist()) for p in range(s, e)}
    expect = set()
    for d, s, t in parts:
        for p in range(len(t) - 49):
            if any(e < d and t[p:p + 50] in u for e, _, u in parts):
                expect |= {(d, s + p + i) for i in range(50)}
    assert got == expect


def test_query_and_odd_ids(make_docs, prose):
    t = prose(40)
    rows = {r.doc_id: r for r in D.query(make_docs([(3, "a " + t), (-5, t + " b"), (None, t)]).withColumn("spans", F.lit(1))).collect()}
    assert rows[-5].n_removed == 0 and rows[None].n_removed == 0
    assert (rows[3].n_removed, rows[3].n_spans) == (len(t), 1)
    assert rows[3].kept_sha256 == hashlib.sha256(b"a ").hexdigest()
    # rows of one id remove nothing from each other: no smaller id has their text
    rows = D.query(make_docs([(3, t), (3, t), (2, "x")])).collect()
    assert sorted((r.doc_id, r.n_removed) for r in rows) == [(2, 0), (3, 0), (3, 0)]
    assert D.query(make_docs([])).count() == 0


def test_given_documents(spark):
    from conftest import SF_SMALL
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    texts = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    check({r.doc_id: r for r in D.dedup(docs).collect()}, texts)


def test_repeated_and_huge_ids_equal_brute_force(make_docs, prose, rng):
    """Ids at both ends of 64 bits, many rows of one id: each row against smaller ids."""
    shared = [prose(25) for _ in range(6)]
    ids = [-(1 << 63), (1 << 63) - 1, 1 << 43, 0, 7, 7, 7, 7, 7, (1 << 62) + 5]
    rows = []
    for n in range(60):
        parts = [rng.choice([rng.choice(shared), rng.choice(shared)[7:110], prose(4)]) for _ in range(rng.randint(0, 4))]
        rows.append((rng.choice(ids), " | ".join(parts)))
    rows += [(7, shared[0])] * 5 + [(7, None), (0, shared[0])]

    def expected(doc, text):
        raw = (text or "").encode()
        hit = set()
        for p in range(len(raw) - 49):
            w = raw[p:p + 50]
            if any(d < doc and w in (t or "").encode() for d, t in rows):
                hit |= set(range(p, p + 50))
        return doc, len(raw), len(hit), hashlib.sha256(bytes(b for i, b in enumerate(raw) if i not in hit)).hexdigest()

    got = sorted((r.doc_id, r.n_bytes, r.n_removed, r.kept_sha256) for r in D.query(make_docs(rows)).collect())
    assert got == sorted(expected(d, t) for d, t in rows)
    assert sum(r[2] > 0 for r in got) > 10
    few = sorted((r.doc_id, r.n_bytes, r.n_removed) for r in D.dedup(make_docs(rows), max_group=1).selectExpr(
        "doc_id", "n_bytes", "aggregate(spans, 0L, (n, s) -> n + s.end - s.start) AS n_removed").collect())
    assert few == [r[:3] for r in got]  # the way for crowded anchors


def test_pieces_of_many_texts_at_once(rng):
    """As one text after the other: no piece goes from one text into the next."""
    raws = [bytes(rng.choice(b"ab") if rng.random() < 0.5 else rng.randrange(256) for _ in range(rng.choice([50, 51, 99, 400])))
            for _ in range(60)] + [b"a" * 50] * 3 + [b"z" * 300]
    of, *many = D.pieces_of(raws)
    expect = [D.pieces(raw) for raw in raws]
    assert of.tolist() == [i for i, p in enumerate(expect) for _ in p[0]]
    for got, one in zip(many, zip(*expect)):
        assert got.tolist() == np.concatenate(one).tolist()
    assert [len(c) for c in D.pieces(b"a" * 49)] == [0] * 5


def test_spans_of_many_documents_are_cut_at_once(monkeypatch):
    """Null texts, null lists, spans that touch and overlap; whatever the number of texts handled together."""
    import pyarrow as pa
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    cuts = [[(3, 5), (0, 2), (2, 3)], None, [], None, [(1, 2), (4, 9), (6, 7)]]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(5), pa.int64()), pa.array(["0123456", "ab", "cd", None, "äbcdefgh"]),
         pa.array([c and [dict(zip(("start", "end"), x)) for x in c] for c in cuts], span)], ["doc", "text", "cuts"])
    for size in (1, 1 << 20):
        monkeypatch.setattr(D, "TEXT_BYTES", size)
        rows = [r for b in D._apply(iter([batch])) for r in b.to_pylist()]
        assert [r["kept"] for r in rows] == [b"56", b"ab", b"cd", b"", b"\xc3bc"]
        assert [[(x["start"], x["end"]) for x in r["spans"]] for r in rows] == [[(0, 5)], [], [], [], [(1, 2), (4, 9)]]
        assert [r["n_bytes"] for r in rows] == [7, 2, 2, 0, 9]
