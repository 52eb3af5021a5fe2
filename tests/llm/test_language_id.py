"""Language identification: held-out accuracy and edge cases."""

import zlib

import numpy as np
import pytest

from conftest import SF_ORACLE, SF_SMALL
from skyfold.llm import language_id as L


def test_held_out_accuracy_on_given_documents(spark):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    rows = L.query(docs).join(docs.select("doc_id", "lang", "n_chars"), "doc_id").collect()
    assert len(rows) == docs.count()
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {r.doc_id for r in rows if zlib.crc32(str(r.doc_id).encode()) % 5 == 0}
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_only_the_text_counts(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    model = L.train(docs)
    from pyspark.sql import functions as F
    other = docs.withColumns({"doc_id": F.col("doc_id") + 7, "lang": F.lit(None).cast("string"), "source": F.lit("z")})
    a = {r.doc_id + 7: (r.lang_pred, r.score) for r in L.predict(docs, model).collect()}
    assert a == {r.doc_id: (r.lang_pred, r.score) for r in L.predict(other, model).collect()}


def test_kernel_scores_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    model = L.train(docs, landmarks=20)
    texts = [r.text for r in docs.limit(15).collect()]
    langs, score = model.predict(texts)
    for t, lang, s in zip(texts, langs, score):
        grams = set(np.flatnonzero(L.presence(t)).tolist())
        kernel = [sum(w for p, w in zip(model.places.tolist(), column) if p in grams) / len(grams) ** 0.5
                  for column in model.landmarks.T.astype(float)]
        values = np.array([*kernel, 1.0]) @ model.weights
        assert lang == model.languages[int(values.argmax())]
        assert s == pytest.approx(np.clip((values.max() + 1) / 2, 0, 1), abs=1e-3)


def test_edges(spark, make_docs):
    from pyspark.sql import functions as F
    assert L.query(make_docs([])).count() == 0
    texts = ["the house of them", None, "", "12 34 ..", "x" * 200_000]
    none = {r.doc_id: r for r in L.query(make_docs(texts)).collect()}
    assert {r.lang_pred for r in none.values()} == {"und"} and {r.score for r in none.values()} == {0.0}
    one = L.query(make_docs([(i, "the house of them") for i in range(20)] + [(None, "the house"), (21, "12")], lang="en"))
    rows = {r.doc_id: r for r in one.withColumn("score2", F.lit(1)).collect()}
    assert rows[None].held_out and rows[None].lang_pred == "en" and rows[21].lang_pred == "und"


def test_only_letters_are_letters(spark, make_docs):
    import unicodedata
    for c in map(chr, range(0x30000)):
        if not 0xD800 <= ord(c) < 0xE000:
            assert L.has_letter(f"1 {c}") == unicodedata.category(c).startswith("L"), c
    docs = make_docs([(i, "the house of them") for i in range(20)] + [(21, "² ½ ①"), (22, "² ª")], lang="en")
    rows = {r.doc_id: r.lang_pred for r in L.query(docs).collect()}
    assert (rows[21], rows[22]) == ("und", "en")


def test_keep_known(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    from pyspark.sql import functions as F
    model = L.train(docs)
    more = docs.limit(3).withColumn("text", F.element_at(F.array(F.lit("12 ## 34"), F.lit(""), F.lit(None)), F.col("doc_id").cast("int") % 3 + 1))
    kept = L.keep_known(docs.union(more).withColumn("score", F.lit("x")), model)
    assert kept.columns[-1] == "score"
    assert kept.count() >= docs.count() - 2
    assert kept.where("text is null or text in ('', '12 ## 34')").count() == 0
