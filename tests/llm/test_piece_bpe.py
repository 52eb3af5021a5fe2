"""Encoding and decoding against the sentencepiece library."""

import hashlib

import public_tokenizers
import pytest
import sentencepiece

from skyfold.llm import piece_bpe as B

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def proto():
    with open(PATH, "rb") as f:
        return f.read()


TEXTS = ["", None, " ", "  ", "\n", " a", "a  b\n\n c ", "▁", "a▁ ▁b", "Zürich 漢字 🙂\x00́", "<s> </s> <0x41> <unk>",
         "x" * 5000, "the " * 3000, "\r\n\ttab", "1234567890 password=abc", "a b c", "\n \n  \n▁\n"]


def test_encoder_equals_library(proto, library, rng):
    letters = " \n▁aéthe漢🙂\x00\t.,  in"
    texts = TEXTS + ["".join(rng.choice(letters) for _ in range(rng.randrange(40))) for _ in range(2000)]
    ids, ends, decoded = B.Encoder(proto).encode(texts)
    model = B.Model(proto)
    for i, t in enumerate(texts):
        expected = library.encode(t or "")
        assert ids[ends[i]:ends[i + 1]].tolist() == expected
        assert decoded[i] == library.decode(expected) == model.decode(expected)
        if i < 200:
            assert model.encode(t) == expected


def test_small_cache_gives_the_same(proto, library, monkeypatch, prose):
    monkeypatch.setattr(B, "CACHE_CHUNKS", 3)
    encoder = B.Encoder(proto)
    for _ in range(5):
        t = prose(20)
        assert encoder.encode([t])[0].tolist() == library.encode(t)


def test_wrong_ids_are_found(proto):
    encoder = B.Encoder(proto)
    encoder.model.pieces.pop("▁the")
    with pytest.raises(ValueError, match="library"):
        encoder.encode(["in the"])


def test_decode_of_any_ids(proto, library):
    model = B.Model(proto)
    for ids in ([4, 200, 300], [3 + 0xE2, 3 + 0x96], [1, 300, 2], [28705, 300]):
        assert model.decode(ids).replace("�", "") == library.decode(ids).replace("�", "")


def test_query(make_docs, library):
    from pyspark.sql import functions as F
    docs = make_docs(TEXTS + ["again", "again"]).withColumn("ids", F.lit("clash")).withColumn("decoded", F.lit(1))
    rows = {r.doc_id: r for r in B.query(docs, PATH).collect()}
    assert len(rows) == len(TEXTS) + 2
    for i, t in enumerate(TEXTS):
        ids = library.encode(t or "")
        assert rows[i].n_tokens == len(ids)
        assert rows[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert rows[i].decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
    assert B.query(make_docs([]), PATH).count() == 0


def test_unfit_model_is_refused():
    with pytest.raises(ValueError):
        B.Model(b"")


def test_shared_agenda_equals_the_agenda_of_one_chunk(proto, rng):
    """All chunks of a batch at once against each by its own heap: ties, repeated characters,
    characters without a piece, line ends, chunks at and over the limit."""
    model = B.Model(proto)
    chars = "aaabbtheing▁\n é漢🙂\t\x00#=.0"
    chunks = ["".join(rng.choice(chars) for _ in range(rng.randint(1, 12))) for _ in range(3000)]
    chunks += ["a" * n for n in (1, 2, 3, 7, 63, 64, 65, 66, 300)] + ["▁the", "▁", "the" * 21 + "t", "é" * 64]
    ids, counts = model.encode_chunks(chunks)
    ends = counts.cumsum()
    for chunk, a, b in zip(chunks, (ends - counts).tolist(), ends.tolist()):
        assert ids[a:b].tolist() == model.encode_chunk(chunk), chunk
    assert model.encode_chunks([])[0].size == 0
