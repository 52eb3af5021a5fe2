"""SimHash near-duplicates against brute force."""

import itertools

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from skyfold.llm import simhash as S

U64 = (1 << 64) - 1


def brute_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", low) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_roots(fps, bits):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(fps)), 2):
        if (fps[i] ^ fps[j]).bit_count() <= bits:
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def planted(rng, n, clusters):
    fps = {rng.getrandbits(64) for _ in range(n)}
    for _ in range(clusters):
        x = rng.getrandbits(64)
        for _ in range(rng.randint(2, 30)):
            fps.add(x)
            for _ in range(rng.randint(1, 4)):
                x ^= 1 << rng.randrange(64)
    return sorted(fps)


def gray_rank(x):
    for s in (1, 2, 4, 8, 16, 32):
        x ^= x >> s
    return x


@pytest.mark.parametrize("text", ["", None, "One", "a B", "x y z", "  a\tb\nc d e\x85f  g\x1ch i ", "ÄÖ äö Straße " * 40])
def test_fingerprint(text):
    assert S.fingerprint(text) == brute_fingerprint(text)


def test_fingerprint_random(prose):
    for n in (3, 4, 50, 400):
        t = prose(n)
        assert S.fingerprint(t) == brute_fingerprint(t)


def test_linked_equals_brute_force(rng):
    for bits in (0, 1, 3, 5):
        fps = sorted(planted(rng, 300, 12), key=gray_rank)
        got = S.linked(np.array(fps, np.uint64), np.zeros(len(fps), np.int64), bits)
        assert got.tolist() == brute_roots(fps, bits)


def test_linked_dense_ball():
    ball = sorted({0} | {1 << i for i in range(64)} | {(1 << i) | (1 << j) for i in range(64) for j in range(i)}, key=gray_rank)
    assert not S.linked(np.array(ball, np.uint64), np.zeros(len(ball), np.int64), 3).any()


@pytest.mark.parametrize("max_group", [50_000, 3])
def test_components_equal_brute_force(spark, rng, max_group):
    from skyfold.llm.components import components
    fps = planted(rng, 150, 10)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    found = {r.u: r.v for r in components(S.links(df, 3, max_group)).collect()}
    assert len({(x, found.get(x, x)) for x in signed}) == len(signed)
    expect = brute_roots(fps, 3)
    classes = {}
    for x, e in zip(signed, expect):
        classes.setdefault(e, set()).add(found.get(x, x))
    assert all(len(v) == 1 for v in classes.values())
    assert len({next(iter(v)) for v in classes.values()}) == len(classes)


def test_query_against_brute_force(make_docs, prose, rng):
    base = [prose(60) for _ in range(12)]
    texts = base + [t + " kador" for t in base] + base[:4] + ["", None, " \n", "one", "ONE", "a b"]
    rows = {r.doc_id: r for r in S.query(make_docs(texts)).collect()}
    fps = [brute_fingerprint(t) for t in texts]
    root = brute_roots(fps, 3)
    for i in range(len(texts)):
        assert (rows[i].fingerprint, rows[i].component_id) == (f"{fps[i]:016x}", root[i])


def test_edges(spark, make_docs):
    assert S.query(make_docs([])).count() == 0
    rows = S.query(make_docs([(None, "x y"), (5, "x y"), (5, "x y"), (9, "x y")])).collect()
    assert sorted((r.doc_id is None, r.component_id) for r in rows if r.doc_id is not None) == [(False, 5)] * 3
    assert [r.component_id for r in rows if r.doc_id is None] == [None]


def test_keep_one(make_docs, prose):
    t = [prose(40) for _ in range(3)]
    docs = make_docs([(4, t[0]), (2, t[0]), (3, t[1]), (3, t[1]), (7, t[2]), (None, t[0])])
    from pyspark.sql import functions as F
    docs = docs.withColumn("fp", F.lit("clash")).withColumn("component_id", F.lit(1))
    kept = S.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [(False, 2), (False, 3), (False, 7), (True, 0)]


def test_rows_of_one_id_are_judged_one_by_one(make_docs, prose):
    """Two clean texts of one id both stay, a copy under a repeated id goes, and of rows
    alike in id and text one stays."""
    a, b, c, d = (prose(60) for _ in range(4))
    docs = make_docs([(1, a), (1, b), (2, b), (2, c), (3, a), (4, d), (4, d), (None, a), (5, None), (5, "")])
    kept = S.keep_one(docs.withColumn("mark", F.lit(1)).withColumn("fp", F.lit("x"))).collect()
    assert sorted(((r.doc_id, r.text or "") for r in kept), key=repr) == sorted(
        [(1, a), (1, b), (2, c), (4, d), (None, a), (5, "")], key=repr)
