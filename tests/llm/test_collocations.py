"""Collocations: stripes against counting all phrases, and the ranking's edges."""

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyfold.llm import collocations as C

CUT = re.compile(r"[.,;:!?\x0A-\x0D]")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_count, percent=100, top=2000, longest=5):
    """Rows (lang, text): every phrase counted, every longer candidate compared."""
    f, n = {}, Counter()
    for lang, text in rows:
        lang = lang or "und"
        for piece in CUT.split((text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for i in range(len(words)):
                for m in range(1, min(longest, len(words) - i) + 1):
                    f.setdefault(lang, Counter())[tuple(words[i:i + m])] += 1
    out = []
    for lang, counts in f.items():
        cand = {p: c for p, c in counts.items() if len(p) > 1 and c >= min_count}
        ranked = []
        for p, a in cand.items():
            if any(len(q) > len(p) and 100 * x >= percent * a
                   and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, x in cand.items()):
                continue
            score, k, l, r = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]])
                                 for k in range(1, len(p)))
            ranked.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def planted(rng, make, n):
    words = ["the", "of", "é", "Ä", "new", "york", "city", "hall", "x1"]
    out = []
    for i in range(n):
        parts = []
        for _ in range(rng.randint(0, 12)):
            parts.append(rng.choice(["New York City", "new york", "the the the", "x1 é", " ".join(
                rng.choice(words) for _ in range(rng.randint(1, 7)))]))
        out.append((rng.choice(["en", "de", None]), rng.choice([" ", ", ", "\n", "\t"]).join(parts)))
    return out


def test_stripes_equal_brute_force(spark, rng):
    for min_count, percent, top in ((5, 100, 2000), (9, 60, 2000), (4, 100, 7)):
        rows = planted(rng, None, 120)
        docs = spark.createDataFrame([(i, lang, t) for i, (lang, t) in enumerate(rows)], "doc_id long, lang string, text string")
        got = found(C.mine(docs.repartition(5), min_count, subsumed_percent=percent, top=top))
        assert got == brute(rows, min_count, percent, top) and got


def stripe_counts(batch, words, hashes):
    """The stripes of a slice with words for hashes."""
    name = dict(zip(hashes.view(np.int64).tolist(), (w.decode() for w in words)))
    out = Counter()
    for r in batch.to_pylist():
        for w, c in zip(r["nexts"], r["counts"]):
            out[name[r["prefix"]], w if w is None else name[w]] += c
    return out


def test_false_hits_send_more_rows_only(monkeypatch):
    codes, words, hashes = C.coded([b"a b a c", b"A b"], "en")
    nothing = np.zeros(C.BITS // 64, np.uint64)
    assert C.stripes_of(codes, hashes, 2, nothing, nothing).num_rows == 0
    monkeypatch.setattr(C, "_has", lambda bitmap, h: np.full(len(h), bitmap is not nothing))  # everything hits
    every = nothing + np.uint64(1)
    expect = {("a", "b"): 2, ("a", "c"): 1, ("b", "a"): 1, ("b", None): 1, ("c", None): 1}
    for heavy in (nothing, every):  # in one segment, and cut
        assert stripe_counts(C.stripes_of(codes, hashes, 2, every, heavy), words, hashes) == expect
    assert C.stripes_of(*C.coded([b"a"], "en")[::2], 5, every, every).num_rows == 0


def test_heavy_prefixes_are_cut_and_merged(spark, rng, monkeypatch):
    rows = planted(rng, None, 60)
    docs = spark.createDataFrame(rows, "lang string, text string")
    for heavy in (1e-9, 3, 1e9):  # no stripe is cut, some, all
        monkeypatch.setattr(C, "HEAVY", heavy)
        assert found(C.mine(docs.repartition(4), 4)) == brute(rows, 4)


def test_equal_hashes_end_the_job(spark):
    phrases = spark.createDataFrame([(1, "en", "a", 5), (1, "en", "b", 5)], "h long, lang string, phrase string, n long")
    with pytest.raises(ValueError, match="hash"):
        C._distinct(phrases)
    assert C._distinct(phrases.limit(1)).count() == 1


def test_exact_beyond_64_bits(spark):
    candidates = spark.createDataFrame([("en", "a b", 2, 10 ** 13)], "lang string, phrase string, size int, a long")
    f_of = spark.createDataFrame([("en", "a", 10 ** 13 + 3, 1), ("en", "b", 10 ** 13 + 7, 1)],
                                 "lang string, phrase string, f long, top long")
    totals = spark.createDataFrame([("en", 10 ** 16)], "lang string, n long")
    row = C._scored(candidates, f_of, totals, 100).first()
    assert row.score == 1000 * 10 ** 13 * 10 ** 16 // ((10 ** 13 + 3) * (10 ** 13 + 7))


def test_ties_by_bytes_and_first_cut(spark):
    text = ". ".join(["a b", "é f", "z y", "𝒳 q", "ￃ q"] * 4)
    rows = [("en", text)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    got = found(C.mine(docs, 2))
    assert got == brute(rows, 2)
    assert [r[2] for r in got] == sorted((r[2] for r in got), key=lambda p: (p.endswith("q"), p.encode()))


def test_edges(spark, make_docs):
    assert C.query(make_docs([])).count() == 0
    assert C.query(make_docs([None, "", " \n.", "a"])).count() == 0
    texts = [None, "", "A b " * 120_000, "a b", ("a b." * 150)]
    docs = make_docs(texts).withColumn("phrase", F.lit("q")).withColumn("n", F.lit(1)).withColumn("e", F.lit(0))
    assert found(C.query(docs)) == brute([(None, t) for t in texts], 100)
    again = docs.unionByName(docs)
    assert found(C.query(again)) == brute([(None, t) for t in texts] * 2, 100)


def test_tasks_hold_one_slice_at_a_time(spark, rng, monkeypatch):
    rows = planted(rng, None, 80)
    docs = spark.createDataFrame(rows, "lang string, text string").coalesce(1)
    monkeypatch.setattr(C, "SLICE_BYTES", 200)  # many slices in one task
    texts = C.stored(C.coded_slices(docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")), "test-slices")
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    most = texts.coalesce(1).select("codes").mapInArrow(
        lambda batches: (C.pa.RecordBatch.from_arrays([C.pa.array([b.num_rows])], ["n"]) for b in batches), "n long")
    with C._row_by_row(spark):
        assert most.agg(F.max("n")).first()[0] == 1 < texts.count()
    assert spark.conf.get(setting) == before
    assert found(C.mine(docs, 4)) == brute(rows, 4)


def test_stripes_of_a_slice_are_sent_by_bucket(rng):
    codes, words, hashes = C.coded([t.encode() for _, t in planted(rng, None, 80)], "en")
    every = np.full(C.BITS // 64, np.iinfo(np.uint64).max)
    for heavy in (every, np.zeros_like(every)):
        stripes = C.stripes_of(codes, hashes, 3, every, heavy)
        rows = [r for b in C.packed(stripes, 7) for r in b.to_pylist()]
        assert len(rows) <= 7 < stripes.num_rows and len({r["bucket"] for r in rows}) == len(rows)
        sent = Counter()
        for r in rows:
            for p, w, c in zip(r["prefixes"], r["nexts"], r["counts"]):
                sent[p, w] += c
        expect = Counter()
        for r in stripes.to_pylist():
            for w, c in zip(r["nexts"], r["counts"]):
                expect[r["prefix"], w] += c
        assert sent == expect
    nothing = C.stripes_of(codes, hashes, 3, np.zeros_like(every), every)
    assert not [r for b in C.packed(nothing, 7) for r in b.to_pylist()]
