"""Language identification by a string kernel (operator 10).

A text is the set of its character n-grams of all lengths up to ``MAX_GRAM``
(blended spectrum, presence only), each hashed to one of ``BUCKETS`` places.
The kernel of two texts is the number of shared grams over the geometric mean of
their numbers.  A bounded sample of labelled documents trains one-versus-rest
kernel ridge regression on Nystroem features of ``LANDMARKS`` sample texts; a
batch of documents is scored by two matrix products.

Only text and the non-null language of documents outside the held-out fold are
learnt from; a prediction uses the text alone.

Defined results: a null text, or one without a letter, is ``und`` with score 0,
and so is every text when nothing can be learnt (no labelled row); a null id is
held out; repeated rows are judged one by one; of equal scores the language that
sorts first wins; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_GRAM = 3
BUCKETS = 1 << 16
LANDMARKS = 128
#: Labelled rows that are learnt from, all languages together: those with the smallest hashes.
MAX_SAMPLE = 2_000
RIDGE = 1e-2
FOLDS = 5
#: Documents scored together.
BATCH = 512
UNKNOWN = "und"
#: Score below which :func:`keep_known` rejects a document.
MIN_SCORE = 0.3

_NO_SIGN = re.compile(r"[^\W\d_]")


def has_letter(text: str) -> bool:
    """Whether a character is a letter (``str.isalpha``); signs such as ``²`` and ``½`` are
    none."""
    return any(m.group().isalpha() for m in _NO_SIGN.finditer(text))


def held_out(id_col: str = "doc_id") -> Column:
    """The fold that is never learnt from: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % FOLDS == 0, F.lit(True))


def presence(text: str) -> np.ndarray:
    """Which buckets hold a gram of the lower-cased text."""
    c = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    flags = np.zeros(BUCKETS, bool)
    h = np.zeros(len(c), np.uint32)
    for n in range(1, MAX_GRAM + 1):
        if len(c) < n:
            break
        h = h[:len(c) - n + 1] * np.uint32(0x01000193) + c[n - 1:] + np.uint32(n)
        flags[(h * np.uint32(0x9E3779B1)) >> np.uint32(16)] = True
    return flags


@dataclass
class Model:
    """``weights`` maps kernel values with the landmarks (and 1) to a score per language."""

    languages: list[str]
    places: np.ndarray  # buckets with a gram of some landmark
    landmarks: np.ndarray  # places x landmarks, 1 over the root of the landmark's size where present
    weights: np.ndarray

    def scores(self, rows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """rows: presence in ``places``; sizes: all buckets of each text."""
        kernel = rows.astype(np.float32) @ self.landmarks
        kernel /= np.sqrt(np.maximum(sizes, 1))[:, None]
        return np.column_stack((kernel, np.ones(len(kernel), np.float32))) @ self.weights

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        langs, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
        known = [i for i, t in enumerate(texts) if t and has_letter(t)] if self.languages else []
        rows, sizes = np.zeros((len(known), len(self.places)), bool), np.zeros(len(known))
        for k, i in enumerate(known):
            flags = presence(texts[i])
            rows[k], sizes[k] = flags[self.places], np.count_nonzero(flags)
        if known:
            s = self.scores(rows, sizes)
            best = s.argmax(axis=1)
            for i, b in zip(known, best.tolist()):
                langs[i] = self.languages[b]
            score[known] = np.clip((s[np.arange(len(known)), best] + 1) / 2, 0, 1)
        return langs, score


def _sample(docs: DataFrame, max_sample: int, id_col: str, text_col: str, lang_col: str
            ) -> list[tuple[str, bytes]]:
    """Language and presence bits of the sample, at most ``max_sample`` rows.

    The languages share the sample evenly; of each those with the smallest hash of
    the id.  Counts cover all labelled rows; only about twice the sample is read
    with its text.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                       F.col(lang_col).alias("lang")).where(~held_out("id") & F.col("lang").isNotNull())
    counts = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return []
    each = max(1, max_sample // len(counts))
    share = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, 2 * each / n + 64 / n))])
    place = F.pmod(F.xxhash64(F.col("id").cast("string")), F.lit(1 << 40))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = [i for i, t in enumerate(b.column(2).to_pylist()) if t and has_letter(t)]
            part = b.take(pa.array(keep, pa.int32()))
            bits = [np.packbits(presence(t)).tobytes() for t in part.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(bits, pa.binary())],
                                             ["lang", "place", "bits"])

    got = (rows.withColumn("place", place).where(F.col("place") < share[F.col("lang")] * float(1 << 40))
           .select("lang", "place", "text").mapInArrow(run, "lang string, place long, bits binary").collect())
    out: dict[str, list[bytes]] = {}
    for r in sorted(got, key=lambda r: (r.lang, r.place, bytes(r.bits))):
        if len(out.setdefault(r.lang, [])) < each:
            out[r.lang].append(bytes(r.bits))
    return [(lang, b) for lang, rows_ in sorted(out.items()) for b in rows_]


def train(docs: DataFrame, max_sample: int = MAX_SAMPLE, landmarks: int = LANDMARKS,
          ridge: float = RIDGE, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang") -> Model:
    sample = _sample(docs, max_sample, id_col, text_col, lang_col)
    langs = sorted({lang for lang, _ in sample})
    if not langs:
        return Model([], np.zeros(0, np.int64), np.zeros((0, 0), np.float32), np.zeros((1, 0), np.float32))
    x = np.unpackbits(np.frombuffer(b"".join(b for _, b in sample), np.uint8).reshape(len(sample), -1), axis=1)
    y = np.array([langs.index(lang) for lang, _ in sample])
    inner = np.concatenate([np.arange(c) for c in np.bincount(y)])  # n-th of its language
    chosen = np.argsort(inner, kind="stable")[:landmarks]
    places = np.flatnonzero(x[chosen].any(axis=0))
    sizes = x.sum(axis=1, dtype=np.int64)
    marks = (x[chosen][:, places].T / np.sqrt(np.maximum(sizes[chosen], 1))).astype(np.float32)
    kernel = x[:, places].astype(np.float32) @ marks / np.sqrt(np.maximum(sizes, 1))[:, None]
    values, vectors = np.linalg.eigh(kernel[chosen].astype(np.float64))
    usable = values > 1e-8 * max(values.max(), 1e-12)
    nystroem = vectors[:, usable] / np.sqrt(values[usable])
    phi = np.column_stack((kernel @ nystroem, np.ones(len(sample))))
    target = np.where(y[:, None] == np.arange(len(langs)), 1.0, -1.0)
    weight = 1.0 / np.bincount(y)[y]  # every language counts alike
    gram = (phi * weight[:, None]).T @ phi + ridge * np.diag([1.0] * (phi.shape[1] - 1) + [1e-9])
    beta = np.linalg.solve(gram, (phi * weight[:, None]).T @ target)
    weights = np.vstack((nystroem @ beta[:-1], beta[-1:])).astype(np.float32)
    return Model(langs, places, marks, weights)


def _predicted(docs: DataFrame, model: Model, text_at: int, schema, give) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, BATCH):
                part = batch.slice(a, BATCH)
                yield give(part, *shared.value.predict(part.column(text_at).to_pylist()))

    return docs.mapInArrow(run, schema)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every whole text."""
    head = docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"),
                       F.col(text_col).alias("text"))
    id_type = head.schema["doc_id"].dataType.simpleString()

    def give(part: pa.RecordBatch, langs: list[str], score: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(langs), pa.array(score)],
                                          ["doc_id", "held_out", "lang_pred", "score"])

    return _predicted(head, model, 2, f"doc_id {id_type}, held_out boolean, lang_pred string, score double", give)


def keep_known(docs: DataFrame, model: Model, min_score: float = MIN_SCORE,
               text_col: str = "text") -> DataFrame:
    """``docs`` (all columns) without the texts of no known language: ``und``, or a
    score below ``min_score``.  A narrow map."""

    def give(part: pa.RecordBatch, langs: list[str], score: np.ndarray) -> pa.RecordBatch:
        return part.filter(pa.array((np.array(langs, object) != UNKNOWN) & (score >= min_score)))

    return _predicted(docs, model, docs.columns.index(text_col), docs.schema, give)


def query(docs: DataFrame) -> DataFrame:
    return predict(docs, train(docs))
