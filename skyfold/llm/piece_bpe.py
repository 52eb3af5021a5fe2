"""SentencePiece encoding and decoding for merge-type vocabularies (operator 3).

Encoding starts from single characters and keeps an agenda of adjacent symbol
pairs that form a piece, ordered by the piece's score, then by place; the best
pair is merged and its new neighbours join the agenda.  Characters without a
piece become byte pieces.

Two characters that stand side by side in no piece can never be merged, so a
text is cut at such places (before each blank that follows something else, and
before line ends) and each distinct chunk is encoded once per worker.  The new
chunks of an Arrow batch share one agenda: each round takes the best pair of
every chunk that has one, in array operations (a chunk of more than ``LONGEST``
characters has an agenda of its own, a heap).  Every new chunk is checked against
the sentencepiece library; a difference ends the job.

Defined results: a null or empty text has no ids and decodes to the empty text;
rows are encoded one by one, whatever their id; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import re
import struct
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLANK = "▁"
#: Piece types of the model file.
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
MERGE_MODEL = 2
#: Characters of text worked on together, and of chunks remembered by a worker.
BATCH_CHARS, CACHE_CHARS, CACHE_CHUNKS = 4 << 20, 16 << 20, 600_000
#: Characters of the chunks whose agenda is shared.
LONGEST = 64
#: Never in the texts that take the fast way of cutting.
CUT = "\x00"


def _fields(data: bytes) -> Iterator[tuple[int, bytes | int]]:
    """Fields of one protocol buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(data):
        tag = number()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, number()
            continue
        size = number() if kind == 2 else {1: 8, 5: 4}[kind]
        yield tag >> 3, data[at:at + size]
        at += size


class Model:
    """The vocabulary of a merge-type model file with its agenda."""

    def __init__(self, proto: bytes):
        self.pieces: dict[str, tuple[float, int]] = {}
        self.byte_ids, self.texts = {}, []
        kind, fallback, dummy, extra, charsmap = None, 0, 1, 1, b""
        for field, value in _fields(proto):
            if field == 1:
                self._piece({1: b"", 2: b"\0\0\0\0", 3: NORMAL} | dict(_fields(value)))
            elif field == 2:
                spec = dict(_fields(value))
                kind, fallback = spec.get(3), spec.get(35, 0)
            elif field == 3:
                spec = dict(_fields(value))
                dummy, extra, charsmap = spec.get(3, 1), spec.get(4, 1), spec.get(2, b"")
        if kind != MERGE_MODEL or not fallback or len(self.byte_ids) != 256:
            raise ValueError("a merge-type model with byte fallback is needed")
        if not dummy or extra or charsmap:
            raise ValueError("a model with identity normalisation and a dummy prefix is needed")
        inner = "".join(f"{p}\n" for p in self.pieces if len(p) > 1)
        #: no merge goes from another character into a blank / over a line end
        self.cuts_at_blank = not re.search(f"[^{BLANK}\n]{BLANK}", inner)
        self.cuts_at_line = not any("\n" in p for p in self.pieces if len(p) > 1)
        parts = "\n" if self.cuts_at_line else ""
        self.pair_keys: np.ndarray | None = None  # built when first needed
        self.chunk = re.compile(f"{BLANK}*[^{BLANK}{parts}]+|{BLANK}+" + f"|\n[^{BLANK}\n]*" * self.cuts_at_line)

    def _piece(self, fields: dict) -> None:
        text, (score,), kind = fields[1].decode(), struct.unpack("<f", fields[2]), fields[3]
        number = len(self.texts)
        self.texts.append({UNKNOWN: " ⁇ ", CONTROL: ""}.get(kind, text.replace(BLANK, " ")))
        if kind == NORMAL:
            self.pieces[text] = (-score, number)
        elif kind == BYTE:
            self.byte_ids[int(text[1:-1], 16)] = number
        elif kind not in (UNKNOWN, CONTROL):
            raise ValueError(f"pieces of type {kind} are not supported")

    def _tables(self) -> None:
        """The pairs of symbols that form a piece: sorted keys, and of each the rank of its
        score (equal scores have one rank) and the symbol it becomes.  A symbol is a piece's
        number, or beyond them a character of pieces that is none itself."""
        symbols = {p: number for p, (_, number) in self.pieces.items()}
        self.no_piece = len(self.texts)  # symbols from here on are characters without a piece
        for c in sorted({c for p in self.pieces for c in p} - symbols.keys()):
            symbols[c] = self.no_piece + len(symbols)
        self.of_char = np.full(0x110000, -1, np.int64)
        for p, number in symbols.items():
            if len(p) == 1:
                self.of_char[ord(p)] = number
        ranks = {score: i for i, score in enumerate(sorted({score for score, _ in self.pieces.values()}))}
        self.width = max(symbols.values(), default=0) + 2
        found = sorted((symbols[p[:k]] * self.width + symbols[p[k:]], ranks[score], number)
                       for p, (score, number) in self.pieces.items() for k in range(1, len(p))
                       if p[:k] in symbols and p[k:] in symbols)
        self.pair_keys, self.pair_ranks, self.pair_symbols = np.array(
            [*found, (np.iinfo(np.int64).max, 0, 0)], np.int64).T.copy()

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (``NONE``: no piece) and symbol of pairs."""
        key = left * self.width + right
        at = np.searchsorted(self.pair_keys, key)
        hit = (self.pair_keys[at] == key) & (left >= 0) & (right >= 0)
        return np.where(hit, self.pair_ranks[at], NONE), self.pair_symbols[at]

    def encode_chunks(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all chunks one after the other, and the number of ids of each."""
        if self.pair_keys is None:
            self._tables()
        sizes = np.fromiter(map(len, chunks), np.int64, len(chunks))
        short = np.flatnonzero(sizes <= LONGEST)
        codes = np.frombuffer("".join([chunks[i] for i in short.tolist()]).encode("utf-32-le", "surrogatepass"), "<u4")
        symbol = self.of_char[codes]
        n = len(symbol)
        bounds = np.concatenate(([0], np.cumsum(sizes[short])))
        owner = np.repeat(np.arange(len(short)), sizes[short])
        after = np.arange(1, n + 1)
        after[bounds[1:][sizes[short] > 0] - 1] = -1
        before = np.arange(-1, n - 1)
        before[bounds[:-1][sizes[short] > 0]] = -1
        rank, becomes = np.full(n, NONE), np.zeros(n, np.int64)
        there = np.ones(n, bool)
        inner = np.flatnonzero(after >= 0)
        rank[inner], becomes[inner] = self._pairs(symbol[inner], symbol[inner + 1])
        live = np.flatnonzero(np.isin(owner, owner[rank < NONE])) if n else inner
        while len(live):
            heads = np.flatnonzero(np.concatenate(([True], owner[live[1:]] != owner[live[:-1]])))
            best = np.minimum.reduceat((rank[live] << 32) | live, heads)  # the score first, then the place
            going = (best >> 32) < NONE
            left = best[going] & 0xFFFFFFFF
            right = after[left]
            symbol[left] = becomes[left]
            there[right] = False
            follow = after[right]
            after[left] = follow
            before[follow[follow >= 0]] = left[follow >= 0]
            changed = np.concatenate((left, before[left]))
            changed = changed[changed >= 0]
            rank[changed] = NONE
            changed = changed[after[changed] >= 0]
            rank[changed], becomes[changed] = self._pairs(symbol[changed], symbol[after[changed]])
            live = live[there[live] & np.repeat(going, np.diff(np.append(heads, len(live))))]
        counts = np.bincount(owner[there], minlength=len(short))
        ids = symbol[there]
        # chunks with characters that have no piece, and the long ones, by themselves
        alone = np.unique(owner[there][(ids < 0) | (ids >= self.no_piece)])
        if not len(alone) and len(short) == len(chunks):
            return ids, counts
        out: list = [None] * len(chunks)
        ends = np.concatenate(([0], np.cumsum(counts)))
        for i, a, b in zip(short.tolist(), ends[:-1].tolist(), ends[1:].tolist()):
            out[i] = ids[a:b]
        for i in [*short[alone].tolist(), *np.flatnonzero(sizes > LONGEST).tolist()]:
            out[i] = np.array(self.encode_chunk(chunks[i]), np.int64)
        return np.concatenate(out), np.fromiter(map(len, out), np.int64, len(out))

    def chunks(self, text: str) -> list[str]:
        """The parts of a text, blanks marked and the dummy prefix added, between
        which nothing can be merged."""
        if not text:
            return []
        if not self.cuts_at_blank:
            return [BLANK + text.replace(" ", BLANK)]
        if text[0] == " " or "  " in text or BLANK in text or CUT in text or not self.cuts_at_line:
            return self.chunk.findall(BLANK + text.replace(" ", BLANK))
        return (BLANK + text.replace("\n", CUT + "\n").replace(" ", CUT + BLANK)).split(CUT)

    def encode_chunk(self, chunk: str) -> list[int]:
        pieces = self.pieces
        symbols: list[str] = list(chunk)
        n = len(symbols)
        agenda = []
        for i in range(n - 1):
            found = pieces.get(symbols[i] + symbols[i + 1])
            if found:
                agenda.append((found[0], i, i + 1, 2))
        if agenda:
            heapq.heapify(agenda)
            after, before = list(range(1, n + 1)), list(range(-1, n - 1))
            while agenda:
                _, left, right, size = heapq.heappop(agenda)
                a, b = symbols[left], symbols[right]
                if not a or not b or len(a) + len(b) != size:
                    continue  # one of the two has been merged meanwhile
                symbols[left], symbols[right] = a + b, ""
                after[left] = nxt = after[right]
                if nxt < n:
                    before[nxt] = left
                    found = pieces.get(a + b + symbols[nxt])
                    if found:
                        heapq.heappush(agenda, (found[0], left, nxt, size + len(symbols[nxt])))
                prev = before[left]
                if prev >= 0:
                    found = pieces.get(symbols[prev] + a + b)
                    if found:
                        heapq.heappush(agenda, (found[0], prev, left, size + len(symbols[prev])))
        ids: list[int] = []
        for s in symbols:
            if s:
                found = pieces.get(s)
                if found:
                    ids.append(found[1])
                else:
                    ids.extend(self.byte_ids[b] for b in s.encode())
        return ids

    def decode_ids(self, ids: list[int]) -> str:
        """Text of a chunk's ids; runs of byte pieces are UTF-8."""
        if not hasattr(self, "id_bytes"):
            self.id_bytes = {i: b for b, i in self.byte_ids.items()}
        out, run = [], bytearray()
        for i in ids:
            b = self.id_bytes.get(i)
            if b is not None:
                run.append(b)
                continue
            if run:
                out.append(run.decode("utf-8", "replace"))
                run = bytearray()
            out.append(self.texts[i])
        if run:
            out.append(run.decode("utf-8", "replace"))
        return "".join(out)

    def encode(self, text: str | None) -> list[int]:
        return [i for c in self.chunks(text or "") for i in self.encode_chunk(c)]

    def decode(self, ids: list[int]) -> str:
        return self.decode_ids(ids).removeprefix(" ")


#: Rank of a pair that forms no piece.
NONE = 1 << 30


class Encoder(dict):
    """Numbers of the chunks met so far; ids and decoded texts by that number."""

    def __init__(self, proto: bytes):
        super().__init__()
        self.model = Model(proto)
        self.library = sentencepiece.SentencePieceProcessor(model_proto=proto)
        self._forget()

    def _forget(self) -> None:
        self.clear()
        self.ids, self.starts, self.counts = array("i"), array("q"), array("q")
        self.decoded: list[str] = []
        self.fresh: list[str] = []
        self.chars = 0

    def __missing__(self, chunk: str) -> int:
        self.fresh.append(chunk)
        number = self[chunk] = len(self)
        return number

    def _encode_fresh(self) -> None:
        """Encode the new chunks, and compare ids and decoded texts with the library, which
        puts a blank before each text."""
        chunks, self.fresh = self.fresh, []
        if not chunks:
            return
        ids, counts = self.model.encode_chunks(chunks)
        ends = np.cumsum(counts)
        starts = ends - counts
        byte = np.isin(ids, list(self.model.byte_ids.values()))
        with_bytes = np.zeros(len(chunks), bool)
        with_bytes[np.repeat(np.arange(len(chunks)), counts)[byte]] = True
        texts = [c.replace(BLANK, " ") for c in chunks]
        decoded = texts[:]
        for i in np.flatnonzero(with_bytes).tolist():
            decoded[i] = self.model.decode_ids(ids[starts[i]:ends[i]].tolist())
        expected = self.library.encode([t.removeprefix(" ") for t in texts], num_threads=1)
        back = self.library.decode(expected, num_threads=1)
        plain = np.array([t[0] == " " and t != " " for t in texts])
        flat = np.fromiter((x for k in np.flatnonzero(plain).tolist() for x in expected[k]), np.int64)
        if not (np.array_equal(flat, ids[np.repeat(plain, counts)])
                and np.array_equal(np.fromiter(map(len, expected), np.int64, len(expected))[plain], counts[plain])):
            plain[:] = False  # find the one that differs
        blank = self.model.pieces[BLANK][1]
        for i, same in enumerate(plain.tolist()):
            if not same:
                own, given, text = ids[starts[i]:ends[i]].tolist(), expected[i], texts[i]
                if text == " ":  # the library gives nothing for an empty text
                    given, back[i] = [blank], ""
                elif text[0] != " ":
                    own = [blank, *own]
                if own != given:
                    raise ValueError(f"{text!r} has ids {own}, the library gives {given}")
            if decoded[i].removeprefix(" ") != back[i]:
                raise ValueError(f"{texts[i]!r} decodes to {decoded[i]!r}, with the library to {back[i]!r}")
        base = len(self.ids)
        self.starts.extend((starts + base).tolist())
        self.counts.extend(counts.tolist())
        self.ids.frombytes(ids.astype(np.int32).tobytes())
        self.decoded.extend(decoded)
        self.chars += sum(map(len, chunks))

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """All ids in one array, the texts' ends in it, and the decoded texts."""
        if self.chars > CACHE_CHARS or len(self) > CACHE_CHUNKS:
            self._forget()
        rows = [list(map(self.__getitem__, self.model.chunks(text or ""))) for text in texts]
        self._encode_fresh()
        decoded = ["".join(map(self.decoded.__getitem__, row)).removeprefix(" ") for row in rows]
        numbers = [np.array(row, np.int64) for row in rows]
        starts, counts = np.array(self.starts), np.array(self.counts)
        every = np.concatenate(numbers) if numbers else np.zeros(0, np.int64)
        n = counts[every] if len(every) else every
        total = np.concatenate(([0], np.cumsum(n)))
        place = np.arange(total[-1]) + np.repeat(starts[every] - total[:-1] if len(every) else every, n)
        ends = total[np.cumsum([0, *map(len, numbers)])]
        return np.array(self.ids, np.int32)[place], ends, decoded


_ENCODERS: dict[bytes, Encoder] = {}


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
           others: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, ids, decoded`` (and the columns ``others``) of every whole text.

    The model file is read once, by the driver; its bytes are sent along.
    """
    with open(model_path, "rb") as f:
        proto = f.read()
    shared = docs.sparkSession.sparkContext.broadcast(proto)
    Model(proto)  # an unfit model fails here
    head = docs.select(F.col(id_col).alias("doc_id"), *others, F.col(text_col).alias("__text"))
    names = [*head.columns[:-1], "ids", "decoded"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _ENCODERS.get(shared.value)
        if encoder is None:  # stays for the worker's further tasks
            encoder = _ENCODERS[shared.value] = Encoder(shared.value)
        for batch in batches:
            sizes = np.array([len(t or "") for t in batch.column(batch.num_columns - 1).to_pylist()])
            cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // BATCH_CHARS)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                part = batch.slice(a, b - a)
                ids, ends, decoded = encoder.encode(part.column(part.num_columns - 1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids)),
                     pa.array(decoded, pa.string())], names)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in head.schema.fields[:-1])
    return head.mapInArrow(run, f"{fields}, ids array<int>, decoded string")


def query(docs: DataFrame, model_path: str) -> DataFrame:
    return encode(docs, model_path).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
