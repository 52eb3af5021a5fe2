import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def rng():
    return random.Random(7)


@pytest.fixture
def make_docs(spark):
    """Documents from texts (ids 0..) or from (doc_id, text) pairs."""
    def make(texts, lang=None, source=None):
        pairs = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        return spark.createDataFrame(
            [(i, t, lang, source, None if t is None else len(t)) for i, t in pairs], DOCS)

    return make


@pytest.fixture
def prose(rng):
    words = [a + b for a in "ka lo mi nu pe ra".split() for b in "dor fen gul hit jam".split()]

    def make(n):
        return " ".join(rng.choice(words) for _ in range(n))

    return make
