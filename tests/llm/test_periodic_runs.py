"""Periodic runs: the dictionary of basic factors against all periods and places."""

import hashlib
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import SF_SMALL
from skyfold.llm import periodic_runs as P


def brute(words, min_words=6, min_power=4):
    """Every period and place; a run counts by its smallest period only."""
    n, out = len(words), []
    for q in range(1, n // min_power + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if j > i and length >= max(min_words, min_power * q):
                smaller = any(all(words[x] == words[x + p] for x in range(i, i + length - p)) for p in range(1, q))
                if not smaller:
                    out.append((i, length, q))
            i = max(j, i) + 1
    return sorted(out)


def planted(words, doc_id):
    h = zlib.crc32(str(doc_id).encode())
    n = len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def expected(doc_id, text):
    words = planted((text or "").encode().split(), doc_id)
    runs = brute(words)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    drop = {i for a, n, q in runs for i in range(a + q, a + n)}
    left = b" ".join(w for i, w in enumerate(words) if i not in drop)
    return (len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2], P.digest(runs),
            hashlib.sha256(left).hexdigest())


blocks = st.lists(st.tuples(st.lists(st.sampled_from([b"a", b"b", b"c"]), min_size=1, max_size=9),
                            st.integers(1, 7), st.integers(0, 3)), max_size=6)


@settings(max_examples=300, deadline=None)
@given(st.lists(blocks, min_size=1, max_size=4))
def test_runs_equal_brute_force(texts):
    texts = [[w for block, times, cut in t for w in (block * times)[cut:]] for t in texts]
    assert P.runs_of(texts) == [brute(t) for t in texts]


def test_long_runs_and_other_limits():
    period = [str(i).encode() for i in range(700)]
    text = [b"x"] + period * 4 + period[:13] + [b"y"]
    assert P.runs_of([text, [b"z"] * 50_000, text]) == [[(1, 2813, 700)], [(0, 50_000, 1)], [(1, 2813, 700)]]
    assert P.runs_of([[b"a"] * 5]) == [[]]
    assert P.runs_of([[b"a"] * 5], min_words=5) == [[(0, 5, 1)]]
    with pytest.raises(ValueError):
        P.runs_of([[b"a"] * 9], min_power=3)


COLUMNS = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def test_query_equals_brute_force(spark, make_docs, rng):
    texts = []
    for i in range(400):
        words = [rng.choice("ka lo mi nu".split()) for _ in range(rng.randint(0, 40))]
        times = rng.randint(1, 9)
        texts.append(" ".join(words) + rng.choice([" ", "\n", "\t\t"]) + " ".join(words[-3:] * times))
    docs = make_docs(texts)
    rows = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in P.query(docs).collect()}
    assert rows == {i: expected(i, t) for i, t in enumerate(texts)}
    assert sum(r[0] > 0 for r in rows.values()) > 100


def test_given_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").where("n_chars < 6000")
    rows = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in P.query(docs).collect()}
    assert rows == {r.doc_id: expected(r.doc_id, r.text) for r in docs.collect()}
    ids = [i for i in rows if zlib.crc32(str(i).encode()) % 10 == 0]
    assert sum(rows[i][0] > 0 for i in ids) > len(ids) // 2  # planted ones are seen


def test_edges(spark, make_docs):
    assert P.query(make_docs([])).count() == 0
    from pyspark.sql import functions as F
    texts = [(1, None), (1, ""), (None, "a " * 9), (5, "\n \t"), (5, "é " * 6), (5, "é " * 6), (7, "w\xa0w " * 70_000)]
    docs = make_docs(texts).withColumn("runs", F.lit("x")).withColumn("h", F.lit(3)).withColumn("start", F.lit(None))
    rows = P.query(docs).collect()
    assert len(rows) == len(texts)
    empty = hashlib.sha256(b"").hexdigest()
    for r in rows:
        if r.doc_id == 1:
            assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli) == (0, None, None, None, None)
            assert r.runs_sha256 == r.collapsed_sha256 == empty
        if r.doc_id is None:
            assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli) == (1, 0, 9, 1, 9000)
            assert r.collapsed_sha256 == hashlib.sha256(b"a").hexdigest()
        if r.doc_id == 7:
            assert (r.length, r.period) == (70_000, 1)
    assert sorted(r.n_runs for r in rows if r.doc_id == 5) == [0, 1, 1]
    strings = P.query(docs.withColumn("doc_id", F.concat(F.lit("d"), "doc_id")))
    assert strings.schema["doc_id"].dataType.simpleString() == "string" and strings.count() == len(texts)
