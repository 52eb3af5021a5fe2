r"""Toxicity by a convolutional text classifier (operator 11).

A text is its sequence of words (runs of letters and digits, lower case).  A word and its
stems (its first ``STEMS`` letters) are each hashed to one of ``BUCKETS`` places; places that
enough training texts have (``MIN_DOCS``, ``MIN_SHARE``) have an embedding, all others the zero
vector, and a word's embedding is the sum of its places'.  ``FILTERS`` filters of each width in
``WIDTHS`` run over the embeddings; the greatest response of each filter over the whole text, a
rectifier and one linear layer give the log odds.  One coordinate of the embeddings starts as
the standard score of the place's documents of label 1, the others at random.

Embeddings, filters and layer are trained together on every labelled row.  The rows are dealt
by their ids over pieces of ``PIECE_CHARS`` characters; in each of ``ROUNDS`` rounds a task trains
the common model on each whole piece (backpropagation through the places of the maxima, Adam),
and the pieces' models are averaged by their rows.  The round that fits a part of the rows kept
from the training best is the one used.  The driver holds the model, its counts per place and
the histograms of the calibration, never rows.

Thresholds are calibrated by language.  The language itself is never an input: it is read
from the text by the words' log probabilities per language, learnt from the same rows.  The
part of the rows kept from the training gives each language its threshold (at the edges of
``BINS`` parts of one unit of log odds), shrunk towards the one of all languages; scores are
shifted so that the threshold is 0.5.

Only documents outside the held-out fold are learnt from.

Defined results: a null or empty text has no words, so all its maxima are zero, and gets the
score of the last layer's bias; without any labelled row, or with one label only, every score
is 0; a null id is held out; several labels of one id, or several rows with it, are all learnt
from if their label is not null (ids are not unique); repeated rows are scored one by one; an empty
table gives no rows; further columns are ignored.  Texts of any length are scored whole, in
stretches that overlap by the widest filter.
"""

from __future__ import annotations

import re
import sys
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyfold.llm.common import slices, stored
from skyfold.llm.suffix_dedup import _pair, _release

BUCKETS = 1 << 20
DIMENSIONS = 16
WIDTHS = (1, 2, 3)
FILTERS = 16
STEMS = (4, 6)
#: The rows between texts.
GAP = np.zeros((len(WIDTHS) - 1, 1 + len(STEMS)), np.int32)
MIN_DOCS, MIN_SHARE = 3, 0.002
#: Steps of a piece's training at least, each over ``BATCH`` texts, in all rounds together; each
#: round takes every row of the piece.
STEPS, ROUNDS = 200, 3
BATCH = 64
#: Characters of the rows that one task trains on by itself in a round.
PIECE_CHARS = 9 << 20
RATE = 0.02
#: Shrinking of all parameters with each step, as a share of the rate.
DECAY = 0.02
#: One of so many rows calibrates.
CALIBRATION = 5
#: Parts of one unit of log odds that the calibration tells apart.
BINS = 64
#: Averages and losses are sums of multiples of this share of one, so their order changes nothing.
FIXED = 1 << 24
#: Rows of the pooled threshold that count beside a language's own.
SHRINK = 50.0
FOLDS = 5
#: Words scored at a time, and parameters stepped at a time: they stay in the processor cache.
STRETCH, STEPPED = 1 << 12, 1 << 14
#: Characters of texts whose words are split together.
SPLIT_CHARS = 1 << 20

WORD = re.compile(r"[^\W_]+")


def held_out(id_col: str = "doc_id") -> Column:
    """The fold that is never learnt from: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % FOLDS == 0, F.lit(True))


#: Bytes of a word up to which words' checksums and keys are made together, byte by byte.
TOGETHER = 64
_CRC = np.array([zlib.crc32(bytes([i ^ 0xFF])) ^ 0xFF000000 for i in range(256)], np.uint32)
#: Of eight bytes the first ones; bytes of a letter by its first byte; which ASCII bytes are of words.
_FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_LETTER = np.array([1 if b < 0xC0 else 2 if b < 0xE0 else 3 if b < 0xF0 else 4 for b in range(256)])
_ASCII = bytes(range(128))
_OF_WORD = bytes(b < 128 and bool(WORD.match(chr(b))) for b in range(256))


def _crcs(b: np.ndarray, starts: np.ndarray, sizes: np.ndarray, before: bytes = b"") -> np.ndarray:
    """crc32 of ``before`` and each part of ``b``."""
    # as 16-bit numbers they are sorted by radix
    order = np.argsort(TOGETHER - np.minimum(sizes, TOGETHER + 1).astype(np.int16), kind="stable")
    at, less = starts[order], -sizes[order]
    crc = np.full(len(starts), zlib.crc32(before) ^ 0xFFFFFFFF, np.uint32)
    for k in range(min(TOGETHER, int(sizes.max(initial=0)))):
        n = int(np.searchsorted(less, -k))  # parts that are longer
        crc[:n] = _CRC[(crc[:n] ^ b[at[:n] + k]) & np.uint32(0xFF)] ^ (crc[:n] >> np.uint32(8))
    out = np.empty(len(starts), np.uint32)
    out[order] = ~crc
    for i in np.flatnonzero(sizes > TOGETHER).tolist():
        out[i] = zlib.crc32(b[starts[i]:starts[i] + sizes[i]], zlib.crc32(before))
    return out


def word_places(b: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Places of each word of ``b``, UTF-8 and a zero at least, then of its stems."""
    out = np.empty((len(starts), 1 + len(STEMS)), np.int32)
    out[:, 0] = _crcs(b, starts, ends - starts) % np.uint32(BUCKETS)
    at, letters = starts, 0
    for k, n in sorted(enumerate(STEMS, 1), key=lambda s: s[1]):
        for _ in range(n - letters):
            at = np.minimum(at + _LETTER[b[at]], ends)
        letters = n
        out[:, k] = _crcs(b, starts, at - starts, b"<") % np.uint32(BUCKETS)
    return out


@cache
def _in_words() -> np.ndarray:
    """Which code points are of words."""
    out = np.zeros(sys.maxunicode + 1, bool)
    for m in WORD.finditer("".join(map(chr, range(len(out))))):
        out[m.start():m.end()] = True
    return out


def _keys(b: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A number for each word: words of up to eight bytes are their own, longer ones are hashed.
    Eight zeros follow the last word."""
    eight = np.ndarray(len(b) - 7, "<u8", b, strides=(1,))  # the eight bytes from each byte on
    sizes = ends - starts
    out = eight[starts] & _FIRST[np.minimum(sizes, 8)]
    longer = np.flatnonzero((sizes > 8) & (sizes <= TOGETHER))
    k = 8
    while len(longer):
        left = sizes[longer] - k
        out[longer] = _pair(out[longer], eight[starts[longer] + k] & _FIRST[np.minimum(left, 8)])
        longer = longer[left > 8]
        k += 8
    for i in np.flatnonzero(sizes > TOGETHER).tolist():
        out[i] = xxhash.xxh64_intdigest(b[starts[i]:ends[i]])
    return out


class Words(NamedTuple):
    """The different words of some texts, in the order of their first occurrence, as parts of
    their bytes, which eight zeros follow; their keys; all words of the texts as numbers of
    different ones, text by text, and how many words each text has."""
    b: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    keys: np.ndarray
    number: np.ndarray
    sizes: list[int]


def split(texts: list[str | None]) -> Iterator[Words]:
    """The words of ``SPLIT_CHARS`` of the texts at a time."""
    part, size = [], 0
    for i, text in enumerate(texts, 1):
        part.append((text.lower() if text else "").encode("utf-8", "surrogatepass"))
        size += len(text or "")
        if size < SPLIT_CHARS and i < len(texts):
            continue
        raw = b" ".join((*part, bytes(8)))
        b = np.frombuffer(raw, np.uint8)
        inside = np.zeros(len(b) + 1, bool)  # a text begins and ends outside of words
        inside[1:] = np.frombuffer(raw.translate(_OF_WORD), bool)
        first = np.flatnonzero(b >= 0xC0)  # of letters of several bytes
        if len(first):
            points = np.frombuffer(raw.translate(None, _ASCII).decode("utf-8", "surrogatepass").encode(
                "utf-32-le", "surrogatepass"), np.uint32)
            own = _in_words()[points]
            first, points = first[own], points[own]
            for k, least in enumerate((0, 0, 0x800, 0x10000), 1):
                inside[first[points >= least] + k] = True
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        starts, ends = edges[::2], edges[1::2]
        numbers = pa.array(_keys(b, starts, ends)).dictionary_encode()
        number = numbers.indices.to_numpy()
        one = np.empty(len(numbers.dictionary), np.int64)
        one[number] = np.arange(len(number))
        cuts = np.searchsorted(starts, np.cumsum([0] + [len(t) + 1 for t in part]))
        yield Words(b, starts[one], ends[one], numbers.dictionary.to_numpy(), number, np.diff(cuts).tolist())
        part, size = [], 0


def _each_text(words: np.ndarray, sizes: list[int]) -> list[np.ndarray]:
    ends = np.cumsum([0, *sizes]).tolist()
    return [words[a:b] for a, b in zip(ends[:-1], ends[1:])]


def places_of(texts: list[str | None]) -> list[np.ndarray]:
    """Of each text words x places (the word's, then its stems')."""
    return [p for w in split(texts) for p in _each_text(word_places(w.b, w.starts, w.ends)[w.number], w.sizes)]


def places(text: str | None) -> np.ndarray:
    """Words x places (the word's, then its stems')."""
    return places_of([text])[0]


@dataclass
class Model:
    row_of: np.ndarray  # place -> row of the embeddings, 0: no embedding
    embeddings: np.ndarray  # row 0 is zero
    filters: list[np.ndarray]  # per width: width x dimensions x filters
    offsets: list[np.ndarray]
    weights: np.ndarray
    bias: float
    languages: np.ndarray = field(default_factory=lambda: np.zeros((0, 0), np.float32))  # rows x languages
    thresholds: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def responses(self, rows: np.ndarray, starts: np.ndarray, ends: np.ndarray
                  ) -> tuple[list[np.ndarray], np.ndarray]:
        """Greatest response of each filter that begins at the words ``starts`` to ``ends`` of
        each text (zero rows follow a text), texts x filters, width by width; and the
        embeddings."""
        x = self.embedded(rows)
        return self.greatest(x, starts, ends), x

    def greatest(self, x: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
        """The same of words as embeddings."""
        out = []
        full = ends > starts
        cuts = np.column_stack((starts[full], ends[full])).ravel()
        for z in self.every(x):
            best = np.zeros((len(ends), FILTERS), np.float32)
            if full.any():
                # the last cut may be the end of the array, where nothing begins
                at = cuts if cuts[-1] < len(z) else cuts[:-1]
                best[full] = np.maximum.reduceat(z, at, axis=0)[::2]
            out.append(best)
        return out

    def embedded(self, rows: np.ndarray) -> np.ndarray:
        x = self.embeddings.take(rows[:, 0], axis=0)
        for k in range(1, rows.shape[1]):
            x += self.embeddings.take(rows[:, k], axis=0)
        return x

    def every(self, x: np.ndarray) -> Iterator[np.ndarray]:
        """The responses of each filter that begin at each word, width by width."""
        for w, kernel, offset in zip(WIDTHS, self.filters, self.offsets):
            n = len(x) - w + 1
            z = x[:n] @ kernel[0]
            for i in range(1, w):
                z += x[i:n + i] @ kernel[i]
            z += offset
            yield z

    def odds(self, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Log odds before calibration, and the log probability of each language, of texts as places."""
        return self.odds_of_words(*_numbered(texts))

    def odds_of_words(self, table: np.ndarray, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """The same of texts as numbers of different words, whose places are given: each word's
        embedding is summed once."""
        odds, tongues = np.full(len(texts), self.bias), np.zeros((len(texts), self.languages.shape[1]))
        if not len(self.weights):
            return odds, tongues
        pooled = np.zeros((len(texts), len(WIDTHS) * FILTERS), np.float32)
        rows = self.row_of[np.vstack((table, np.zeros((1, 1 + len(STEMS)), np.int32)))]
        rows[-1] = 0  # the zero rows between texts
        words, tongue = self.embedded(rows), self.languages[rows[:, 0]] if len(self.languages) else None
        gap = np.full(len(WIDTHS) - 1, len(table))
        group, parts, held = [], [], 0

        def flush() -> None:
            numbers, starts, ends = _laid_out(parts, STRETCH, gap)
            best = self.greatest(words.take(numbers, axis=0), starts, ends)
            # no text has two parts in a group, as every part but its last one ends a group
            pooled[group] = np.maximum(pooled[group], np.hstack(best))

        for i, text in enumerate(texts):
            if tongue is not None:
                tongues[i] = tongue.take(text, axis=0).sum(axis=0, dtype=np.float64)
            for a in range(0, len(text), STRETCH):
                group.append(i)
                parts.append(text[a:a + STRETCH + len(gap)])
                held += len(parts[-1])
                if held >= STRETCH:
                    flush()
                    group, parts, held = [], [], 0
        if group:
            flush()
        return odds + pooled @ self.weights, tongues

    def scores(self, texts: list[np.ndarray]) -> np.ndarray:
        return self.scores_of_words(*_numbered(texts))

    def scores_of_words(self, table: np.ndarray, texts: list[np.ndarray]) -> np.ndarray:
        if not len(self.weights):
            return np.zeros(len(texts))
        odds, tongues = self.odds_of_words(table, texts)
        if len(self.thresholds):
            odds = odds - self.thresholds[tongues.argmax(axis=1)]
        return 1 / (1 + np.exp(-np.clip(odds, -40, 40)))


def _numbered(texts: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Texts as places as if all their words were different."""
    table = np.concatenate([np.zeros((0, 1 + len(STEMS)), np.int32), *texts])
    return table, _each_text(np.arange(len(table)), [len(t) for t in texts])


def _laid_out(texts: list[np.ndarray], most: int | None = None, gap: np.ndarray = GAP
              ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The rows of the texts one after the other, each followed by zero rows; where each text
    begins, and where it ends or has had ``most`` words (the next stretch begins there)."""
    rows = np.concatenate([p for t in texts for p in (t, gap)]) if texts else gap
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(np.r_[0, sizes[:-1] + len(gap)])
    return rows, starts, starts + (sizes if most is None else np.minimum(sizes, most))


def _shortened(rows: np.ndarray) -> np.ndarray:
    """A text with as many words without an embedding in a row as the widest filter has:
    more of them change no maximum."""
    known = rows.any(axis=1)
    if known.all():
        return rows
    zeros = np.convolve(~known, np.ones(len(WIDTHS) + 1, np.int64))[:len(rows)]
    return rows[zeros <= len(WIDTHS)]


class _Adam:
    def __init__(self, *params: np.ndarray) -> None:
        self.params, self.t = params, 0
        self.m, self.v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]

    def step(self, grads: list[np.ndarray], rate: float) -> None:
        self.t += 1
        for p, g, m, v in zip(self.params, grads, self.m, self.v):
            whole = [x.reshape(-1) for x in (p, g, m, v)]
            for a in range(0, p.size, STEPPED):
                self._part(*(x[a:a + STEPPED] for x in whole), rate)

    def _part(self, p: np.ndarray, g: np.ndarray, m: np.ndarray, v: np.ndarray, rate: float) -> None:
        m *= 0.9
        m += 0.1 * g
        v *= 0.999
        v += 0.001 * (g * g)
        root = np.sqrt(v)
        root *= (1 - 0.999 ** self.t) ** -0.5
        root += 1e-8
        p *= 1 - rate * DECAY
        p -= rate / (1 - 0.9 ** self.t) * m / root


def _pieces(texts: list[np.ndarray]) -> Iterator[tuple[list[int], list[int], list[np.ndarray]]]:
    """Texts in groups of about ``STRETCH`` words, longer ones in stretches that overlap by the
    widest filter: of each part the text's number, where the part begins, and its rows."""
    group, held = ([], [], []), 0
    for i, rows in enumerate(texts):
        for a in range(0, len(rows), STRETCH):
            part = rows[a:a + STRETCH + len(WIDTHS) - 1]
            for c, v in zip(group, (i, a, part)):
                c.append(v)
            held += len(part)
            if held >= STRETCH:
                yield group
                group, held = ([], [], []), 0
    if group[0]:
        yield group


def _maxima(model: Model, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The greatest response of each filter in each text, 0 at least, and the word it begins at."""
    best = np.zeros((len(texts), len(WIDTHS) * FILTERS), model.embeddings.dtype)
    at = np.zeros(best.shape, np.int64)
    for number, offset, parts in _pieces(texts):
        rows, starts, _ = _laid_out(parts)
        for k, z in enumerate(model.every(model.embedded(rows))):
            cut = slice(k * FILTERS, (k + 1) * FILTERS)
            for i, from_, a, part in zip(number, offset, starts.tolist(), parts):
                own = z[a:a + min(len(part), STRETCH)]
                peak = own.argmax(axis=0)
                value = own[peak, np.arange(FILTERS)]
                above = value > best[i, cut]
                best[i, cut][above], at[i, cut][above] = value[above], peak[above] + from_
    return best, at


def gradients(model: Model, texts: list[np.ndarray], y: np.ndarray, weight: np.ndarray
              ) -> tuple[float, list[np.ndarray]]:
    """Weighted logistic loss of texts (rows of the embeddings) and its gradients by the
    embeddings, filters, offsets, weights and bias."""
    pooled, at = _maxima(model, texts)
    odds = pooled @ model.weights + model.bias
    p = 1 / (1 + np.exp(-np.clip(odds, -40, 40)))
    loss = float(-(weight * np.where(y == 1, np.log(p + 1e-12), np.log(1 - p + 1e-12))).sum())
    error = (weight * (p - y)).astype(np.float32)
    back = error[:, None] * model.weights[None, :] * (pooled > 0)
    d_embeddings = np.zeros_like(model.embeddings)
    places, parts = [], []
    d_filters, d_offsets = [np.zeros_like(k) for k in model.filters], []
    rows, starts, _ = _laid_out(texts)
    for k, (w, kernel) in enumerate(zip(WIDTHS, model.filters)):
        part = back[:, k * FILTERS:(k + 1) * FILTERS]
        d_offsets.append(part.sum(axis=0))
        d, f = np.nonzero(part)
        if not len(d):
            continue
        first, share = starts[d] + at[d, k * FILTERS + f], part[d, f].astype(np.float32)
        by_filter = np.zeros((FILTERS, len(f)), np.float32)
        by_filter[f, np.arange(len(f))] = share
        for i in range(w):
            words = rows[first + i]
            d_filters[k][i] = (by_filter @ model.embedded(words)).T
            by_word = kernel[i].T[f] * share[:, None]
            places.append(words.T)
            parts.append(by_word)
    if parts:
        of_part = np.concatenate([np.tile(np.arange(n - p.shape[1], n), len(p)) for p, n in zip(
            places, np.cumsum([len(v) for v in parts]))])
        # sorted by row, then by their order, which the low bits hold
        key = np.concatenate([p.ravel() for p in places]).astype(np.int64) << 32 | np.arange(len(of_part))
        key.sort()
        row = key >> 32
        cuts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        d_embeddings[row[cuts]] = np.add.reduceat(np.concatenate(parts)[of_part[key & 0xFFFFFFFF]], cuts, axis=0)
    d_embeddings[0] = 0
    return loss, [d_embeddings, *d_filters, *d_offsets, pooled.T @ error, np.array([error.sum()], np.float32)]


def _started(distinct: np.ndarray, docs: np.ndarray, toxic: np.ndarray, prior: float, seed: int) -> Model:
    """The model before the training, from the frequent places' documents and those of label 1."""
    rng = np.random.default_rng(seed)

    def draw(*shape: int, size: float) -> np.ndarray:
        return (rng.standard_normal(shape) * size).astype(np.float32)

    row_of = np.zeros(BUCKETS, np.int32)
    row_of[distinct] = np.arange(1, len(distinct) + 1)
    embeddings = draw(len(distinct) + 1, DIMENSIONS, size=0.05)
    embeddings[1:, 0] = np.clip((toxic - prior * docs) / np.sqrt(prior * (1 - prior) * docs) / 8, -1, 2)
    embeddings[0] = 0
    return Model(row_of, embeddings, [draw(w, DIMENSIONS, FILTERS, size=(1 / (w * DIMENSIONS)) ** 0.5) for w in WIDTHS],
                 [np.zeros(FILTERS, np.float32) for _ in WIDTHS], draw(len(WIDTHS) * FILTERS, size=0.3),
                 float(np.log(prior / (1 - prior))))


def _table(model: Model) -> np.ndarray:
    """All parameters, in rows of ``DIMENSIONS``; the last one holds the bias."""
    parts = [model.embeddings, *model.filters, *model.offsets, model.weights, np.full(DIMENSIONS, model.bias)]
    return np.concatenate([np.asarray(p, np.float64).reshape(-1, DIMENSIONS) for p in parts])


def _with_table(model: Model, table: np.ndarray) -> Model:
    table = table.astype(np.float32)
    cuts = np.cumsum([p.size // DIMENSIONS for p in (model.embeddings, *model.filters, *model.offsets, model.weights)])
    embeddings, *rest, weights, bias = np.split(table, cuts)
    n = len(WIDTHS)
    return Model(model.row_of, embeddings, [k.reshape(f.shape) for k, f in zip(rest[:n], model.filters)],
                 [o.ravel() for o in rest[n:]], weights.ravel(), float(bias[0, 0]), model.languages, model.thresholds)


def _trained(model: Model, texts: list[np.ndarray], y: np.ndarray, steps: int, begun: float, share: float,
             rng: np.random.Generator) -> Model:
    """The model after steps over rows of the embeddings; the training's rate falls from what
    is left of it when a share has ``begun``, over ``share``."""
    model = _with_table(model, _table(model))
    bias = np.array([model.bias], np.float32)
    adam = _Adam(model.embeddings, *model.filters, *model.offsets, model.weights, bias)
    queue = np.zeros(0, np.int64)
    for step in range(steps):
        if len(queue) < BATCH:
            queue = np.r_[queue, rng.permutation(len(texts))]
        chosen, queue = queue[:BATCH], queue[BATCH:]
        _, grads = gradients(model, [texts[i] for i in chosen], y[chosen], np.full(len(chosen), 1 / len(chosen)))
        adam.step(grads, RATE * (1 - begun - share * step / steps))
        model.bias = float(bias[0])
    return model


def _threshold(odds: np.ndarray, y: np.ndarray, n: np.ndarray | None = None) -> float:
    """The middle of the cut with the fewest errors, of equally good cuts the widest; each of
    the odds stands for ``n`` rows (default: 1)."""
    if len(set(y.tolist())) < 2:
        return 0.0
    n = np.ones(len(y), np.int64) if n is None else n
    z, of = np.unique(odds, return_inverse=True)
    clean, toxic = (np.bincount(of, n * (y == v), minlength=len(z)) for v in (0, 1))
    wrong = np.r_[0, np.cumsum(toxic)] + np.r_[np.cumsum(clean[::-1])[::-1], 0]
    edges = np.r_[z[0] - 1, z, z[-1] + 1]
    width = np.diff(edges)
    best = np.flatnonzero(wrong == wrong.min())
    k = best[width[best].argmax()]
    return float((edges[k] + edges[k + 1]) / 2)


def _thresholds(odds: np.ndarray, y: np.ndarray, tongue: np.ndarray, n: np.ndarray, languages: int) -> np.ndarray:
    """The threshold of each language, of odds that stand for ``n`` rows each."""
    pooled = _threshold(odds, y, n)
    out = np.full(languages, pooled)
    for k in range(languages):
        own = tongue == k
        least = float(min((n * own)[y == v].sum() for v in (0, 1)))
        if least:
            out[k] = (least * _threshold(odds[own], y[own], n[own]) + SHRINK * pooled) / (least + SHRINK)
    return out


PACKED = ("apart boolean, shard int, piece int, words array<string>, numbers array<int>, sizes array<int>, "
          "labels array<int>, langs array<string>")


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task: rows sorted by piece become one row for each piece, or several where it is large: its
    different words, and the texts as their numbers.  No later pass splits the texts again."""
    key, piece, size, held = None, 0, 0, []

    def row() -> pa.RecordBatch:
        texts, labels, langs = zip(*held)
        parts = list(split(texts))
        number = pa.array(np.concatenate([p.keys for p in parts])).dictionary_encode().indices.to_numpy()
        # a word that is new has the number after all numbers before
        new = np.diff(np.maximum.accumulate(number), prepend=-1) > 0
        words, numbers, sizes, a = [], [], [], 0
        for p in parts:
            at = slice(a, a := a + len(p.keys))
            raw = p.b.tobytes()
            words += [raw[x:y] for x, y in zip(p.starts[new[at]].tolist(), p.ends[new[at]].tolist())]
            numbers.append(number[at][p.number])
            sizes += p.sizes
        lists = ((pa.array(words, pa.binary()).cast(pa.string()), pa.string()), (np.concatenate(numbers), pa.int32()),
                 (sizes, pa.int32()), (labels, pa.int32()), (langs, pa.string()))
        return pa.RecordBatch.from_arrays(
            [pa.array([key[0]]), pa.array([key[1]], pa.int32()), pa.array([piece], pa.int32()),
             *(pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), pa.array(v, t)) for v, t in lists)],
            ["apart", "shard", "piece", "words", "numbers", "sizes", "labels", "langs"])

    for batch in batches:
        for apart, shard, text, y, lang in zip(*(c.to_pylist() for c in batch.columns)):
            if held and (key != (apart, shard) or size + len(text or "") > 2 * PIECE_CHARS):
                yield row()
                piece, size, held = piece + 1 if key == (apart, shard) else 0, 0, []
            key = apart, shard
            held.append((text, y, lang))
            size += len(text or "")
    if held:
        yield row()


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, list[int], np.ndarray, list]]:
    """Of each packed row its shard and piece, the places of its different words, its words as their
    numbers, and of each text how many they are, the label and the language."""
    for batch in batches:
        for i in range(batch.num_rows):
            _, shard, piece, words, numbers, sizes, labels, langs = (batch.column(c)[i] for c in range(8))
            raw = pc.binary_join(batch.column(3).slice(i, 1), "")[0].as_buffer().to_pybytes()
            ends = np.cumsum(pc.binary_length(words.values).to_numpy(), dtype=np.int64)
            table = word_places(np.frombuffer(raw + bytes(1), np.uint8), np.r_[0, ends][:-1], ends)
            yield (shard.as_py(), piece.as_py(), table, numbers.values.to_numpy(), sizes.as_py(),
                   labels.values.to_numpy().astype(np.int64), langs.as_py())


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task: of each place and language the documents, those of label 1 and the words."""
    for _, _, table, numbers, sizes, labels, langs in _each(batches):
        texts = _each_text(numbers, sizes)
        place, of = np.unique(table, return_inverse=True)
        of, last = of.reshape(table.shape), np.zeros(len(place), np.int64)
        for lang in sorted(set(langs)):
            own = [i for i, v in enumerate(langs) if v == lang]
            docs, toxic = np.zeros((2, len(place)), np.int64)
            for i in own:
                found = of[texts[i]].ravel()
                at = np.arange(len(found))
                last[found] = at
                present = found[last[found] == at]  # each place once
                docs[present] += 1
                toxic[present] += labels[i]
            there = np.flatnonzero(docs)
            words = np.bincount(np.concatenate([texts[i] for i in own]), minlength=len(table))
            words = np.bincount(of[:, 0], words, minlength=len(place))
            yield pa.RecordBatch.from_arrays(
                [pa.array(place[there], pa.int32()), pa.array([lang] * len(there), pa.string()),
                 *(pa.array(c[there].astype(np.int64)) for c in (docs, toxic, words))], ["place", "lang", "docs", "toxic", "words"])


def train(docs: DataFrame, labels: DataFrame, max_labelled: int | None = None, steps: int = STEPS,
          id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", label_col: str = "toxic",
          seed: int = 11) -> Model:
    """The model of all labelled rows, or, if a bound is given, of so many: those with the
    smallest hashes of id and text.

    Rows are dealt by id, sorted and split by hash, and averages are exact sums, so that neither
    the input's partitions nor their order change the model.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                       F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("lang")).where(~held_out("id"))
    marks = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).where(
        F.col("y").isin(0, 1) & ~held_out("id"))
    chars = rows.select("id", F.length("text").alias("n")).join(marks.select("id"), "id").agg(F.sum("n")).first()[0]
    shards = 1 + int(chars or 0) // PIECE_CHARS
    known = (rows.repartition(shards, "id").join(marks.repartition(shards, "id"), "id")
             .withColumn("place", F.xxhash64(F.col("id").cast("string"), "text")))
    if max_labelled is not None:
        known = known.orderBy("place", "y", "lang").limit(max_labelled).repartition(shards, "id")
    packed = stored(
        known.withColumns({"apart": F.pmod("place", F.lit(CALIBRATION)) == 0, "shard": F.spark_partition_id()})
        .sortWithinPartitions("apart", "shard", "place", "y", "lang")
        .select("apart", "shard", "text", "y", "lang").mapInArrow(_pack, PACKED), "toxicity-rows")
    _release(spark)  # the texts' shuffle files
    toxic_of = F.aggregate("labels", F.lit(0).cast("long"), lambda s, v: s + v)
    sizes = {r.apart: (int(r.n), int(r.y)) for r in packed.groupBy("apart").agg(
        F.sum(F.size("labels")).alias("n"), F.sum(toxic_of).alias("y")).collect()}
    n, y = (sum(v) for v in zip(*sizes.values())) if sizes else (0, 0)
    if not 0 < y < n:
        return Model(np.zeros(0, np.int32), np.zeros((1, DIMENSIONS), np.float32), [], [], np.zeros(0), 0.0)
    learn, apart = packed.where("not apart"), packed.where("apart")
    if 0 < sizes.get(False, (0, 0))[1] < sizes.get(False, (0, 0))[0]:
        n, y = sizes[False]
    else:
        learn = packed

    counts = learn.mapInArrow(_counted, "place int, lang string, docs long, toxic long, words long")
    counts = counts.groupBy("place", "lang").agg(*(F.sum(c).alias(c) for c in ("docs", "toxic", "words")))
    least = min(max(MIN_DOCS, MIN_SHARE * n), n)
    got = (counts.groupBy("place").agg(F.sum("docs").alias("docs"), F.sum("toxic").alias("toxic"), F.map_from_entries(
        F.collect_list(F.struct("lang", "words"))).alias("words")).where(F.col("docs") >= least).orderBy("place").collect())
    distinct, docs_of, toxic = (np.array([r[c] for r in got], np.int64) for c in ("place", "docs", "toxic"))
    model = _started(distinct, docs_of, toxic, y / n, seed)
    names = sorted({r.lang for r in learn.select(F.explode("langs").alias("lang")).distinct().collect()})
    by_language = np.array([[0] * len(names)] + [[r.words.get(v, 0) for v in names] for r in got], np.float64)
    model.languages = _language_table(by_language)

    rounds = max(1, min(ROUNDS, steps))
    best, kept = np.inf, model
    for k in range(rounds):
        model = _averaged(learn, model, rounds, k, -(-steps // rounds), seed)
        loss, thresholds = _judged(apart, model)
        if loss <= best:
            best, kept = loss, replace(model, thresholds=thresholds)
    return kept


def _averaged(learn: DataFrame, model: Model, rounds: int, k: int, steps: int, seed: int) -> Model:
    """The model after one round over all pieces."""
    shared = learn.sparkSession.sparkContext.broadcast(model)
    columns = [f"p{i}" for i in range(DIMENSIONS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, total, n = shared.value, 0, 0
        for shard, piece, table, numbers, sizes, labels, _ in _each(batches):
            rows = start.row_of[table]
            short = [_shortened(rows[t]) for t in _each_text(numbers, sizes)]
            after = _trained(start, short, labels, max(steps, -(-len(short) // BATCH)), k / rounds, 1 / rounds,
                             np.random.default_rng((seed, k, shard, piece)))
            total = total + np.rint(_table(after) * FIXED).astype(np.int64) * len(labels)
            n += len(labels)
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(total)), pa.int32()), pa.array(np.full(len(total), n, np.int64)),
                 *(pa.array(c) for c in np.ascontiguousarray(total.T))], ["at", "n", *columns])

    total = (learn.mapInArrow(run, "at int, n long, " + ", ".join(f"{c} long" for c in columns))
             .groupBy("at").agg(*(F.sum(c).alias(c) for c in ("n", *columns))).orderBy("at").toArrow())
    table = np.stack([total.column(c).to_numpy() for c in columns], axis=1).astype(np.float64)
    shared.unpersist()
    _release(learn.sparkSession)  # the round's shuffle files
    return _with_table(model, table / FIXED / total.column("n").to_numpy()[:, None])


def _judged(apart: DataFrame, model: Model) -> tuple[float, np.ndarray]:
    """The mean loss of the rows kept from the training, and each language's threshold by them."""
    shared = apart.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, table, numbers, sizes, labels, _ in _each(batches):
            odds, tongues = shared.value.odds_of_words(table, _each_text(numbers, sizes))
            z = np.clip(odds, -40, 40)
            loss = np.rint(np.log1p(np.exp(np.where(labels == 1, -z, z))) * FIXED).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(tongues.argmax(axis=1), pa.int32()), pa.array(labels, pa.int32()),
                 pa.array(np.floor(z * BINS).astype(np.int32)), pa.array(loss)], ["tongue", "y", "bin", "loss"])

    bins = (apart.mapInArrow(run, "tongue int, y int, bin int, loss long").groupBy("tongue", "y", "bin")
            .agg(F.count("*").alias("n"), F.sum("loss").alias("loss")).collect())
    tongue, y, z, n, loss = (np.array([r[c] for r in bins], np.int64) for c in range(5))
    # a bin's rows count at its middle
    thresholds = _thresholds((z + 0.5) / BINS, y, tongue, n, model.languages.shape[1])
    return sum(loss.tolist()) / FIXED / int(n.sum()) if len(n) else 0.0, thresholds


def _language_table(counts: np.ndarray) -> np.ndarray:
    """Log probability of each embedded word by language; other words tell nothing."""
    counts = counts + 0.5
    table = np.log(counts / counts[1:].sum(axis=0, keepdims=True)) if len(counts) > 1 else np.zeros_like(counts)
    table[0] = 0
    return table.astype(np.float32)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every whole text.  A narrow map."""
    head = docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"),
                       F.col(text_col).alias("text"))
    id_type = head.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 2):
            model = shared.value
            s = np.concatenate([model.scores_of_words(word_places(w.b, w.starts, w.ends), _each_text(w.number, w.sizes))
                                for w in split(part.column(2).to_pylist())])
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(s, pa.float64()), pa.array((s >= 0.5).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"])

    return head.mapInArrow(run, f"doc_id {id_type}, held_out boolean, score double, predicted int")


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, train(docs, labels))
