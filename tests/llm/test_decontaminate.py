"""Benchmark decontamination against brute force."""

import hashlib
import re

import pytest

from skyfold.llm import decontaminate as D


def brute_words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)


def brute(text, items, window=10):
    w = brute_words(text)
    hit, met = set(), set()
    for item_id, t in items:
        v = brute_words(t)
        n = min(window, len(v))
        grams = {tuple(v[i:i + n]) for i in range(len(v) - n + 1)} if n else set()
        for i in range(len(w) - n + 1):
            if n and tuple(w[i:i + n]) in grams:
                hit |= set(range(i, i + n))
                met.add(item_id)
    return len(w), hit, met


@pytest.fixture
def bench(spark):
    return lambda items: spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("max_bytes", [1 << 20, 200])
def test_scan_equals_brute_force(spark, make_docs, prose, rng, bench, max_bytes):
    items = [(i, prose(rng.choice([1, 3, 9, 10, 11, 30]))) for i in range(25)]
    items += [(100, items[5][1]), (101, ""), (102, None), (103, "Short, one")]
    texts = [prose(80) for _ in range(20)]
    for i in range(40):
        v = items[rng.randrange(25)][1].split()
        a = rng.randrange(len(v))
        texts.append(prose(rng.randrange(15)) + " " + ", ".join(v[a:a + rng.randint(1, 25)]).upper() + "\n" + prose(5))
    texts += ["", None, "short ONE", "the short é one"]
    rows = {r.doc_id: r for r in D.scan(make_docs(texts), bench(items), max_bytes=max_bytes).collect()}
    out = {r.doc_id: r for r in D.query(make_docs(texts), bench(items)).collect()}
    for i, t in enumerate(texts):
        n, hit, met = brute(t, items)
        got = {p for s in rows[i].spans for p in range(s.start, s.end)}
        assert (rows[i].n_words, got, rows[i].items) == (n, hit, sorted(map(str, met)))
        assert out[i].n_hit == len(hit) and out[i].contaminated == bool(hit)
        assert out[i].items_sha256 == hashlib.sha256(",".join(sorted(map(str, met))).encode()).hexdigest()


def test_clean_cuts_spans_and_drops_covered_documents(make_docs, prose, bench):
    item = prose(12)
    a, b = prose(20), prose(20)
    texts = [a + ". " + item.upper() + " -- " + b, item, prose(5), None, ""]
    docs = make_docs(texts)
    kept = {r.doc_id: r for r in D.clean(docs, bench([(1, item)])).collect()}
    assert set(kept) == {0, 2, 3, 4}
    assert kept[0].text == a + ".  -- " + b and kept[0].n_chars == len(kept[0].text)
    assert kept[2].text == texts[2] and kept[3].text is None


def test_empty_tables_and_clashing_columns(spark, make_docs, bench):
    from pyspark.sql import functions as F
    docs = make_docs(["a b", None]).withColumn("n_words", F.lit(1)).withColumn("spans", F.lit("x"))
    none = bench([])
    assert [r.n_hit for r in D.scan(docs, none).collect()] == [0, 0]
    assert D.clean(docs, none).collect() == docs.collect()
    assert D.scan(make_docs([]), none).count() == 0
    assert D.clean(make_docs([]).withColumn("items", F.lit(1)), bench([(1, "a b")])).count() == 0


def test_long_text(make_docs, prose, bench):
    item = prose(15)
    text = prose(30_000) + " " + item + " " + prose(30_000)
    row = D.scan(make_docs([text]), bench([(3, item)])).first()
    assert row.n_words == 60_015 and row.items == ["3"] and row.n_hit >= 15
