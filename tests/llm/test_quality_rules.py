"""Quality rules against brute force."""

import re
from collections import Counter

from pyspark.sql import functions as F

from skyfold.llm import quality_rules as Q

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute_base(text):
    text = text or ""
    w = WORD.findall(text)
    five = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    times = Counter(five)
    covered = {p for i, g in enumerate(five) if times[g] > 1 for p in range(i, i + 5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def norm(line):
    return " ".join(re.sub("[A-Z]", lambda c: c[0].lower(), x) for x in WORD.findall(line))


def brute(rows, line_docs, line_share, min_left=0.5):
    """rows: (text, host); returns base, base_failed, words left, kept."""
    hosts = Counter(h for _, h in rows)
    docs = Counter(x for t, h in rows for x in {(h, norm(x)) for x in (t or "").split("\n") if norm(x)})
    out = []
    for t, h in rows:
        base = brute_base(t)
        cut = sum(len(WORD.findall(x)) for x in (t or "").split("\n")
                  if norm(x) and docs[h, norm(x)] > line_docs and docs[h, norm(x)] > line_share * hosts[h])
        failed = base[0] < 10 or 100 * base[4] > 20 * base[0]
        left = base[0] - cut
        out.append((base, failed, left, not failed and left >= 10 and left >= min_left * base[0]))
    return out


def test_base_measures(make_docs, prose, rng):
    texts = ["", None, " \n\t", "a b c d e a b c d e", "x\nx\n x\ny\ny", "a\x1cb c\x85d e\xa0f", "#*$%&|<> é漢🙂",
             "one " * 30, "w " * 5, "w " * 6, prose(40_000), "A\na\nA"]
    texts += [" ".join(rng.choice("abc") for _ in range(rng.randrange(60))) for _ in range(60)]
    for t, r in zip(texts, sorted(Q.judge(make_docs(texts)).collect(), key=lambda r: r.doc_id)):
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute_base(t)


def test_lines_above_the_limit_are_removed(spark, prose, rng):
    common = ["Subscribe to our   NEWS letter today", "all rights reserved by us 2020 and more words here for all of you now"]
    rows = []
    for i in range(120):
        t = prose(rng.randint(8, 30)) + "\n" + rng.choice([common[0], common[0].lower().replace("   ", " "), common[1] * 2, prose(9)])
        rows.append((t, rng.choice(["a", "a", "b", None])))
    rows += [(None, "a"), ("", None)]
    docs = spark.createDataFrame([(i, t, h) for i, (t, h) in enumerate(rows)], "doc_id long, text string, source string")
    expect = brute(rows, 5, 0.05)
    assert len({e[3] for e in expect}) == 2 and any(e[2] < e[0][0] for e in expect)
    got = {r.doc_id: r for r in Q.judge(docs, line_docs=5, line_share=0.05).collect()}
    for i, (base, failed, left, kept) in enumerate(expect):
        assert (got[i].base_failed, got[i].n_left, got[i].kept) == (failed, left, kept)
    cleaned = {r.doc_id: r.text for r in Q.clean(docs, line_docs=5, line_share=0.05).collect()}
    assert set(cleaned) == {i for i, e in enumerate(expect) if e[3]}
    assert all(len(WORD.findall(t)) == expect[i][2] for i, t in cleaned.items())


def test_shuffle_join_gives_the_same(make_docs, prose, monkeypatch):
    docs = make_docs(["one common line of the host\n" + prose(12) for _ in range(40)])
    a = sorted(Q.judge(docs).collect(), key=str)
    monkeypatch.setattr(Q, "MAX_BROADCAST_ROWS", 0)
    assert sorted(Q.judge(docs).collect(), key=str) == a
    assert all(len(r.removed) == 1 for r in a)


def test_edges(make_docs):
    assert Q.query(make_docs([])).count() == 0
    docs = make_docs([(None, "a b"), (1, "a b"), (1, "a b")]).withColumn("host", F.lit(1)).withColumn("lines", F.lit(2))
    assert sorted((r.doc_id or 0, r.n_words) for r in Q.query(docs).collect()) == [(0, 2), (1, 2), (1, 2)]
    assert Q.clean(docs).count() == 0


def test_many_documents_of_a_large_host_are_enough(make_docs, prose):
    """A line in 30 of 400 documents: not the share, but the number of documents."""
    docs = make_docs([prose(12) + ("\none common line of the host" if i < 30 else "") for i in range(400)])
    removed = [len(r.removed) for r in Q.judge(docs, line_share=0.1, line_many=29).collect()]
    assert sum(removed) == 30
    assert not any(len(r.removed) for r in Q.judge(docs, line_share=0.1, line_many=30).collect())
