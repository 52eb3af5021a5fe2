"""Quality classifier: held-out accuracy, rounds and edge cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_ORACLE
from skyfold.llm import cotraining as C


@pytest.fixture(scope="module")
def tables(spark):
    return tuple(spark.read.parquet(f"{SF_ORACLE}/{t}.parquet") for t in ("documents", "labels"))


def test_held_out_accuracy(tables):
    docs, labels = tables
    rows = C.query(docs, labels)
    assert rows.count() == docs.count()
    held = rows.where(C.held_out()).join(labels, "doc_id").collect()
    assert len(held) > 50
    assert np.mean([r.kept == (r.quality == 1) for r in held]) > 0.95


def test_labels_are_exchanged(rng):
    """Few labelled rows: the pool's pseudo-labels mend the view that learns little alone."""
    g = np.random.default_rng(3)
    n = 2000
    y = g.integers(0, 2, n)
    strong = np.column_stack((y * 4 + g.normal(size=n), g.normal(size=n)))
    weak = np.column_stack([y * 0.9 + g.normal(size=n) for _ in range(12)] + [g.normal(size=n) for _ in range(40)])
    seed, pool, test = slice(0, 24), slice(24, 1200), slice(1200, n)

    def accuracy(rounds):
        m = C.cotrain((strong[seed], weak[seed]), y[seed].astype(float), (strong[pool], weak[pool]), rounds)
        return np.mean((m.scores(strong[test], weak[test])[:, 1] >= 0.5) == (y[test] == 1))

    assert accuracy(5) > accuracy(0) + 0.03


def test_handed_rows_are_sure_and_free():
    p = np.array([0.99, 0.5, 0.01, 0.97, 0.02, 0.999])
    rows, labels = C._handed(p, np.array([True, True, True, True, True, False]), 4)
    assert set(rows.tolist()) <= {0, 2, 3, 4} and all((p[r] > 0.5) == lab for r, lab in zip(rows, labels))


def test_views_differ_and_ignore_each_other():
    a, b = C.metadata_view("x y", "en", "s"), C.metadata_view("x y", None, "t")
    assert not np.array_equal(a, b)
    assert C.content_view("").sum() == 0 and C.metadata_view("", None, None)[1] > 0
    assert np.isclose((C.content_view("some text") ** 2).sum(), 1)


def test_edges(spark, make_docs, tables):
    labels = spark.createDataFrame([(0, 1), (1, None), (None, 1)], "doc_id long, quality int")
    texts = ["a b c", None, "", "x" * 100_000]
    rows = C.query(make_docs(texts).withColumn("label", F.lit("clash")).withColumn("place", F.lit(1)), labels).collect()
    assert len(rows) == 4 and all(0 <= r.score <= 1 for r in rows)
    assert C.query(make_docs([]), labels).count() == 0
    none = C.query(make_docs(texts), labels.where("quality = 7")).collect()
    assert {r.score for r in none} == {0.5}
    docs, real = tables
    odd = make_docs([(None, "a b"), (5000, None), (5000, None)])
    assert C.score(odd, C.train(docs, real.union(real))).count() == 3
