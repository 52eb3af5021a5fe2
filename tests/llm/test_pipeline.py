"""The corpus pipeline, stage by stage, against brute force."""

import os
import re

import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline as P
from conftest import SF_SMALL
from skyfold.llm import language_id, queries
from skyfold.llm.queries import model_path

from .test_decontaminate import brute as brute_hits
from .test_decontaminate import brute_words
from .test_secrets import KINDS
from .test_simhash import brute_fingerprint, brute_roots

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The rows that go into each stage, and those that come out of the last."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [docs.collect()]
    for i, (_, stage) in enumerate(P.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(i))
        out = stage(spark, docs, SF_SMALL)
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        if i < len(P.STAGES) - 1:
            assert docs.columns == COLUMNS
        rows.append(docs.collect())
    return rows


def test_stages_are_the_dealt_ones():
    assert [n for n, _ in P.STAGES] == ["language ID", "SimHash near-dedup", "benchmark decontamination",
                                        "secret scans", "SentencePiece encoding and decoding"]


def test_language_stage(spark, stages):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    langs, score = language_id.train(docs).predict([r.text for r in stages[0]])
    keep = {r.doc_id for r, lang, s in zip(stages[0], langs, score) if lang != "und" and s >= language_id.MIN_SCORE}
    assert {r.doc_id for r in stages[1]} == keep and len(keep) > 0.95 * len(stages[0])


def test_near_duplicate_stage(stages):
    rows = sorted(stages[1], key=lambda r: r.doc_id)
    root = brute_roots([brute_fingerprint(r.text) for r in rows], 3)
    assert sorted(stages[2]) == [r for i, r in enumerate(rows) if root[i] == i]


def test_decontamination_stage(spark, stages):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    out = {r.doc_id: r for r in stages[3]}
    changed = 0
    for r in stages[2]:
        n, hit, _ = brute_hits(r.text, items)
        if not hit:
            assert out[r.doc_id] == r
        elif len(hit) > 0.5 * n:
            assert r.doc_id not in out
        else:
            changed += 1
            left = [w for i, w in enumerate(brute_words(r.text)) if i not in hit]
            assert brute_words(out[r.doc_id].text) == left
            assert out[r.doc_id].n_chars == len(out[r.doc_id].text)
    assert changed


def test_secret_stage(stages):
    more = [("pem", re.compile(r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----(?s:.*?-----END [A-Z ]{0,40}PRIVATE KEY-----)?"), 0, 1),
            ("jwt", re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"), 0, 1)]
    out = {r.doc_id: r for r in stages[4]}
    assert len(out) == len(stages[3])
    masked = 0
    for r in stages[3]:
        spans = sorted((m.start(), m.end()) for _, p, g, n in KINDS + more
                       for m in p.finditer(r.text) if len(m.group(g)) >= n)
        text, pos = [], 0
        merged = []
        for a, b in spans:
            if merged and a <= merged[-1][1]:
                merged[-1][1] = max(b, merged[-1][1])
            else:
                merged.append([a, b])
        for a, b in merged:
            text += [r.text[pos:a], "[secret]"]
            pos = b
        expect = "".join(text) + r.text[pos:]
        masked += bool(merged)
        assert out[r.doc_id].text == expect and out[r.doc_id].n_chars == len(expect)
    assert masked


def test_token_stage(stages):
    library = sentencepiece.SentencePieceProcessor(model_file=model_path())
    out = {r.doc_id: r for r in stages[5]}
    assert len(out) == len(stages[4])
    for r in stages[4]:
        assert out[r.doc_id].ids == library.encode(r.text)
        assert out[r.doc_id].n_tokens == len(out[r.doc_id].ids)


def test_run_gives_the_last_stage(spark, stages):
    got = {(r.doc_id, r.n_tokens, r.decoded_sha256) for r in P.run(spark, SF_SMALL).collect()}
    assert got == {(r.doc_id, r.n_tokens, r.decoded_sha256) for r in stages[5]}


def test_stages_on_odd_rows(spark, make_docs):
    for docs in (make_docs([]), make_docs([None, "", " \n", "12 !!"]),
                 make_docs([(None, "the house"), (1, "the house"), (1, "the house"), (2, None)], lang="en")):
        docs = docs.withColumn("ids", F.lit("clash")).withColumn("blob", F.lit(1)).withColumn("fp", F.lit(2))
        for _, stage in P.STAGES[:-1]:
            assert stage(spark, docs, SF_SMALL).columns == docs.columns
            assert stage(spark, docs, SF_SMALL).count() <= docs.count()
        assert P.STAGES[-1][1](spark, docs, SF_SMALL).count() == docs.count()


def test_every_operator_has_its_query():
    assert [int(k[2:].split("_")[0]) for k in queries.QUERIES] == list(range(1, 14))
    assert os.path.exists(model_path())


def test_private_keys_of_several_lines_are_masked_whole(spark, make_docs, rng):
    """Header, body and end go, whatever ends the lines; what stands around stays."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    docs, expect = [], {}
    for i, (kind, end) in enumerate([("RSA ", "\n"), ("", "\r\n"), ("EC ", "\\n"), ("OPENSSH ", "\n")]):
        body = end.join("".join(rng.choice(letters) for _ in range(64)) for _ in range(5))
        key = f"-----BEGIN {kind}PRIVATE KEY-----{end}{body}{end}-----END {kind}PRIVATE KEY-----"
        docs += [(2 * i, f"before {key} after"), (2 * i + 1, f"{key}\nand {key}")]
        expect |= {2 * i: "before [secret] after", 2 * i + 1: "[secret]\nand [secret]"}
    stage = dict(P.STAGES)["secret scans"]
    out = {r.doc_id: r for r in stage(spark, make_docs(docs), SF_SMALL).collect()}
    assert {i: r.text for i, r in out.items()} == expect
    assert all(r.n_chars == len(r.text) for r in out.values())
