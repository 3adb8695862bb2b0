import hashlib
import struct

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece

from tabwright.llm import sentencepiece_codec as C
from tests.llm.fixtures import awkward, frame, repeated, sample

ODD = ["", " ", "  a  b ", "\n\n a", "a\tb", "é😀漢字\x00", "<s> </s> <unk>", "▁▁x", "   ", "a" * 3000, "ﬁ①", "<0x41>", "x  ", " y", "\r\n"]


@pytest.fixture(scope="module")
def texts(spark):
    return [t for _, t, _ in sample(spark, 200) + awkward()] + ODD


def encoded(codec, texts):
    out = []
    for _, _, offsets, ids, _ in codec.encode(pa.array(texts, pa.string())):
        out += [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])]
    return out


def test_parity_with_the_reference_library_and_round_trip(texts):
    there = sentencepiece.SentencePieceProcessor(model_file=C.MODEL)
    codec = C.Codec(C.model_bytes(C.MODEL))
    want = [there.encode(t or "") for t in texts]
    assert codec.parts is not None and encoded(codec, texts) == want
    assert [codec.whole.encode(t or "", add_special_tokens=False).ids for t in texts] == want
    assert codec.whole.decode_batch(want, skip_special_tokens=False) == [(t or "").replace("▁", " ") for t in texts]


def _field(number, kind, body):
    tag = _number(number << 3 | kind)
    return tag + (_number(len(body)) + body if kind == 2 else body)


def _number(n):
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def model_file(pieces, kind, squeeze, fallback=True):
    """A model file written by hand."""
    out = b"".join(_field(1, 2, _field(1, 2, p.encode()) + _field(2, 5, struct.pack("<f", s)) + _field(3, 0, _number(k))) for p, s, k in pieces)
    spec = _field(3, 0, _number(kind)) + _field(35, 0, _number(int(fallback))) + _field(40, 0, _number(0)) + _field(41, 0, _number(1)) + _field(42, 0, _number(2))
    return out + _field(2, 2, spec) + _field(3, 2, _field(1, 2, b"identity") + _field(3, 0, _number(1)) + _field(4, 0, _number(int(squeeze))) + _field(5, 0, _number(1)))


@pytest.mark.parametrize("squeeze", [False, True])
def test_unigram_scores_match_the_reference_library(squeeze):
    pieces = [("<unk>", 0.0, C.UNKNOWN), ("<s>", 0.0, C.CONTROL), ("</s>", 0.0, C.CONTROL)] + [(f"<0x{i:02X}>", -30.0 - i / 997, C.BYTE) for i in range(256)]
    words = ["▁", "▁the", "the", "▁th", "he", "in", "ing", "▁of", "er", "ter", "st", "▁and", "é", "▁le", "ment", *"abcdefghijklmnopqrstuvwxyz"]
    data = model_file(pieces + [(w, -2.0 - 0.37 * i - 0.011 * i * i, C.NORMAL) for i, w in enumerate(words)], C.UNIGRAM, squeeze)
    there = sentencepiece.SentencePieceProcessor(model_proto=data)
    texts = ["the string of the others", "lément and intering", "x", "", "  the  of ", "THE 漢", "thethe\nthe", "a  b   c"]
    assert encoded(C.Codec(data), texts) == [there.encode(t) for t in texts]


def test_pieces_across_words_take_the_plain_way():
    pieces = [("<unk>", 0.0, C.UNKNOWN)] + [(f"<0x{i:02X}>", -30.0, C.BYTE) for i in range(256)] + [("▁", -2.0, C.NORMAL), ("a", -3.0, C.NORMAL), ("a▁a", -1.0, C.NORMAL)]
    codec = C.Codec(model_file(pieces, C.UNIGRAM, False))
    assert codec.parts is None and encoded(codec, ["a a a", None, ""])[1:] == [[], []]


def test_encode_and_decode_tables(spark):
    rows = repeated(sample(spark, 30) + awkward())
    df = frame(spark, rows)
    out = C.encode(df)
    assert out.columns == [*df.columns, "token_ids"]
    back = C.decode(out).select("text", "decoded").collect()
    assert len(back) == len(rows) and all(r.decoded == (r.text or "").replace("▁", " ") for r in back)
    there = sentencepiece.SentencePieceProcessor(model_file=C.MODEL)
    for r in C.digests(df, ["doc_id", "text"]).collect():
        ids = there.encode(r.text or "")
        assert (r.n_tokens, r.ids_sha256, r.round_trip) == (len(ids), hashlib.sha256(np.array(ids, "<i4").tobytes()).hexdigest(), "▁" not in (r.text or ""))
    assert C.encode(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        C.encode(out)


class Counted:
    """A tokenizer that counts the words it encodes and decodes."""

    def __init__(self, inner):
        self.inner, self.encoded, self.decoded = inner, 0, 0

    def encode_batch_fast(self, words, **more):
        self.encoded += len(words)
        return self.inner.encode_batch_fast(words, **more)

    def decode_batch(self, ids, **more):
        self.decoded += len(ids)
        return self.inner.decode_batch(ids, **more)


def test_words_are_encoded_once_and_only_odd_ones_decoded():
    codec = C.Codec(C.model_bytes(C.MODEL))
    codec.parts = counted = Counted(codec.parts)
    texts = [" ".join(f"w{i}x" for i in range(a, a + 30_000)) for a in (0, 30_000, 60_000, 90_000, 0, 30_000)] + ["▁ and <0x41>"]
    for t in texts:
        encoded(codec, [t])
    assert counted.encoded == 120_003 and counted.decoded == 2


def test_a_full_cache_changes_nothing(texts, monkeypatch):
    data = C.model_bytes(C.MODEL)
    plain = [list(x) for x in zip(*((o.tolist(), i.tolist(), s.tolist()) for _, _, o, i, s in C.Codec(data).encode(pa.array(texts * 3, pa.string()))))]
    monkeypatch.setattr(C, "CHUNK", 2000)
    for size in (0, 50, 400):
        monkeypatch.setattr(C, "CACHED", size)
        codec = C.Codec(data)
        assert encoded(codec, texts * 3) == encoded(C.Codec(data), texts) * 3
        same = np.concatenate([s for *_, s in codec.encode(pa.array(texts * 3, pa.string()))])
        assert same.tolist() == sum(plain[2], []) and same.tolist() == ["▁" not in (t or "") for t in texts] * 3
