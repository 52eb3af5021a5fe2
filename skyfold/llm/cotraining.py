"""Quality classifier by co-training (operator 6).

Two classifiers look at different views of a document: one at its text content
(hashed character n-grams), one at its page metadata (source, language, length,
layout and character statistics).  Both start from the same labelled rows; in
each round each hands the unlabelled documents it is most sure of, with its
labels for them, to the other, and both are fitted again.  Then both views are
calibrated on labelled rows that neither has seen, and their calibrated log odds
are combined to score all documents.

Fitted on bounded samples (``MAX_LABELLED`` labelled rows, ``MAX_POOL`` unlabelled
documents, those with the smallest hashes of the id); every document is scored.

Defined results: a null text counts as an empty one, null metadata as a value of
its own; a document with several labels has the larger; without labels of both
classes every score is the share of good labels (0.5 without any); repeated rows
are scored one by one; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_LABELLED, MAX_POOL = 2_500, 3_000
ROUNDS = 4
#: Confidence from which a label is handed on, and the most of a round as a share of the pool.
SURE, PER_ROUND = 0.95, 0.15
GRAM_BITS, MAX_GRAM = 10, 3
SOURCES, LANGS = 64, 16
SYMBOLS = np.array([ord(c) for c in "#*$%&|<>!"], np.uint32)
FOLDS = 5
MIN_SCORE = 0.5
BATCH = 512


def content_view(text: str) -> np.ndarray:
    """Square roots of the shares of hashed character n-grams."""
    c = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    total = np.zeros(1 << GRAM_BITS, np.int64)
    h = np.zeros(len(c), np.uint32)
    for n in range(1, MAX_GRAM + 1):
        if len(c) < n:
            break
        h = h[:len(c) - n + 1] * np.uint32(0x01000193) + c[n - 1:] + np.uint32(n)
        total += np.bincount((h * np.uint32(0x9E3779B1)) >> np.uint32(32 - GRAM_BITS), minlength=len(total))
    return np.sqrt(total / max(1, total.sum())).astype(np.float32)


NUMERIC = 10


def metadata_view(text: str, lang: str | None, source: str | None) -> np.ndarray:
    """Length, layout and character shares, then hashed language and source."""
    c = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    words = text.split()
    n, lines = max(1, len(c)), text.count("\n") + 1
    out = np.zeros(NUMERIC + LANGS + SOURCES, np.float32)
    out[:NUMERIC] = (
        np.log1p(len(c)), np.log1p(lines), np.log1p(len(c) / lines), np.log1p(len(words)),
        len(c) / max(1, len(words)), len(set(words)) / max(1, len(words)),
        np.count_nonzero((c >= 65) & (c <= 90)) / n, np.count_nonzero((c >= 48) & (c <= 57)) / n,
        np.count_nonzero(np.isin(c, SYMBOLS)) / n, max(map(len, words), default=0) / n)
    out[NUMERIC + zlib.crc32((lang or "").encode()) % LANGS] = 1
    out[NUMERIC + LANGS + zlib.crc32((source or "").encode()) % SOURCES] = 1
    return out


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


@dataclass
class Logistic:
    """Ridge logistic regression on standardised features."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 6) -> "Logistic":
        mean, scale = x.mean(axis=0), x.std(axis=0)
        scale[scale < 1e-6] = np.inf  # constant features don't count
        z = np.column_stack(((x - mean) / scale, np.ones(len(x))))
        # both classes weigh alike
        weight = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum())) * len(y)
        w = np.zeros(z.shape[1])
        penalty = np.full(z.shape[1], ridge)
        penalty[-1] = 1e-6
        for _ in range(steps):
            p = _sigmoid(z @ w)
            h = (z * (weight * np.maximum(p * (1 - p), 1e-4))[:, None]).T @ z + np.diag(penalty)
            w -= np.linalg.solve(h, z.T @ (weight * (p - y)) + penalty * w)
        return cls(mean, scale, w)

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.clip(((x - self.mean) / self.scale) @ self.weights[:-1] + self.weights[-1], -30, 30)


@dataclass
class Model:
    """``prior`` alone where nothing can be learnt."""

    prior: float
    views: tuple[Logistic, Logistic] | None = None
    scales: tuple[np.ndarray, np.ndarray] | None = None  # calibration: slope and offset of each view
    joint: np.ndarray | None = None  # weights of the calibrated log odds, offset

    def calibrated(self, content: np.ndarray, metadata: np.ndarray) -> np.ndarray:
        return np.column_stack([s[0] * v.logit(x) + s[1]
                                for v, s, x in zip(self.views, self.scales, (content, metadata))])

    def scores(self, content: np.ndarray, metadata: np.ndarray) -> np.ndarray:
        """Columns: content score, metadata score, combined score."""
        if self.views is None:
            return np.full((len(content), 3), self.prior)
        z = self.calibrated(content, metadata)
        return np.column_stack((_sigmoid(z), _sigmoid(z @ self.joint[:2] + self.joint[2])))


def _platt(z: np.ndarray, y: np.ndarray, ridge: float, start: np.ndarray) -> np.ndarray:
    """Weights and offset of a small logistic fit, drawn to ``start``."""
    x = np.column_stack((z, np.ones(len(z))))
    w = start.astype(float).copy()
    for _ in range(25):
        p = _sigmoid(x @ w)
        h = (x * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ x + ridge * np.eye(x.shape[1])
        step = np.linalg.solve(h, x.T @ (p - y) + ridge * (w - start))
        w -= np.clip(step, -1, 1)
    return w


def _handed(p: np.ndarray, free: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Free pool rows a view is surest of, in the shares of its two classes."""
    good = p >= 0.5
    sure = np.flatnonzero(free & (np.maximum(p, 1 - p) >= SURE))
    picked = []
    for kind in (True, False):
        rows = sure[good[sure] == kind]
        share = max(1, round(most * (good[free] == kind).mean())) if free.any() else 0
        picked.append(rows[np.argsort(-np.abs(p[rows] - 0.5), kind="stable")][:share])
    rows = np.concatenate(picked)
    return rows, good[rows].astype(float)


def cotrain(views: tuple[np.ndarray, np.ndarray], y: np.ndarray, pool: tuple[np.ndarray, np.ndarray],
            rounds: int = ROUNDS) -> Model:
    """``views``: content and metadata of the labelled rows, in the order of their hash."""
    if not len(y) or y.min() == y.max():
        return Model(float(y.mean()) if len(y) else 0.5)
    held = np.arange(len(y)) % 4 == 3  # calibrates, isn't learnt from
    if len(set(y[held])) < 2 or len(set(y[~held])) < 2:
        held = np.zeros(len(y), bool)
    seed = ~held
    given: list[list[tuple[np.ndarray, np.ndarray]]] = [[], []]  # pool rows and labels each view got
    free = [np.ones(len(pool[0]), bool), np.ones(len(pool[0]), bool)]

    def fit(k: int) -> Logistic:
        rows = np.concatenate([r for r, _ in given[k]] or [np.zeros(0, int)]).astype(int)
        labels = np.concatenate([y[seed], *(lab for _, lab in given[k])])
        return Logistic.fit(np.vstack((views[k][seed], pool[k][rows])), labels)

    models = [fit(0), fit(1)]
    for _ in range(rounds if len(pool[0]) else 0):
        for k in (0, 1):
            rows, labels = _handed(_sigmoid(models[k].logit(pool[k])), free[1 - k], int(PER_ROUND * len(pool[0])) or 1)
            free[1 - k][rows] = False
            given[1 - k].append((rows, labels))
        models = [fit(0), fit(1)]
    at = held if held.any() else seed
    scales = tuple(_platt(m.logit(v[at])[:, None], y[at], 1.0, np.array([0.5, 0.0])) for m, v in zip(models, views))
    model = Model(float(y.mean()), tuple(models), scales, None)
    model.joint = _platt(model.calibrated(views[0][at], views[1][at]), y[at], 1.0, np.array([0.5, 0.5, 0.0]))
    return model


def held_out(id_col: str = "doc_id") -> Column:
    """Rows for measuring accuracy: never learnt from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % FOLDS == 0, F.lit(True))


def _views(part: pa.RecordBatch, first: int) -> tuple[np.ndarray, np.ndarray]:
    """Both views of the columns text, lang, source, from column ``first`` on."""
    rows = [(t or "", lang, s) for t, lang, s in zip(*(part.column(first + i).to_pylist() for i in range(3)))]
    content = np.array([content_view(r[0]) for r in rows], np.float32).reshape(len(rows), 1 << GRAM_BITS)
    metadata = np.array([metadata_view(*r) for r in rows], np.float32).reshape(len(rows), NUMERIC + LANGS + SOURCES)
    return content, metadata


def _collected(rows: DataFrame) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray]]:
    """Labels and views of a bounded sample ``place, label, text, lang, source``, by place."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            content, metadata = _views(b, 2)
            both = np.hstack((content, metadata)).astype(np.float32)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([r.tobytes() for r in both], pa.binary())], ["place", "label", "views"])

    got = sorted(((r.place, r.label, bytes(r.views)) for r in
                  rows.mapInArrow(run, "place long, label double, views binary").collect()))
    both = np.frombuffer(b"".join(g[2] for g in got), np.float32).reshape(len(got), -1) if got else np.zeros(
        (0, (1 << GRAM_BITS) + NUMERIC + LANGS + SOURCES), np.float32)
    return np.array([g[1] for g in got], float), (both[:, :1 << GRAM_BITS], both[:, 1 << GRAM_BITS:])


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", max_labelled: int = MAX_LABELLED,
          max_pool: int = MAX_POOL, rounds: int = ROUNDS) -> Model:
    place = F.xxhash64(F.col("doc_id").cast("string"))
    labelled = (labels.where(F.col(label_col).isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
                .groupBy("doc_id").agg(F.max(label_col).cast("double").alias("label")))
    chosen = labelled.withColumn("place", place).orderBy("place", "doc_id").limit(max_labelled)
    head = docs.select("doc_id", "text", "lang", "source").where(~held_out())
    # bounded by the limit
    rows = head.join(F.broadcast(chosen), "doc_id").select("place", "label", "text", "lang", "source")
    y, views = _collected(rows)
    pool = (head.select("doc_id", place.alias("place")).join(labelled.select("doc_id"), "doc_id", "left_anti")
            .orderBy("place", "doc_id").limit(max_pool).distinct())
    free = head.join(F.broadcast(pool), "doc_id").select(
        "place", F.lit(0.0).alias("label"), "text", "lang", "source")
    return cotrain(views, y, _collected(free)[1], rounds)


def score(docs: DataFrame, model: Model, min_score: float = MIN_SCORE) -> DataFrame:
    """``doc_id, content_score, metadata_score, score, kept`` of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    head = docs.select("doc_id", "text", "lang", "source")
    id_type = head.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, BATCH):
                part = batch.slice(a, BATCH)
                s = shared.value.scores(*_views(part, 1)).astype(float)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array(s[:, i]) for i in range(3)), pa.array(s[:, 2] >= min_score)],
                    ["doc_id", "content_score", "metadata_score", "score", "kept"])

    return head.mapInArrow(run, f"doc_id {id_type}, content_score double, metadata_score double, "
                                "score double, kept boolean")


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, train(docs, labels))
