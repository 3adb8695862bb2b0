"""SentencePiece encoding and decoding on the tokenizers library.

The model file (a protobuf) is parsed here: pieces with scores and kinds, the normaliser, the blank marker, byte fallback. From these the
tokenizer is rebuilt, with unigram scores or, for merge models, with the merges their scores imply. No piece may continue past a blank into the next
word; where the vocabulary has none that does, texts are split there first, which changes no result and lets words be cached.
Model bytes travel with the tasks, so the path only has to exist where the query is built.
"""

from __future__ import annotations

import hashlib
import os
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.llm.bytesvec import Chunk, chunks, cut, prefix_hash, segment_hash
from tabwright.llm.documents import quoted

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MODEL_LIMIT = 64 << 20
CHUNK = 1 << 20
CACHED = 1_000_000   # words; a hash, two places, two flags and on average some four ids each
IDS_PER_WORD = 16
BLANK = "▁"
# Fixed values of the model format.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = range(1, 7)
UNIGRAM, BPE = 1, 2


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        value, shift, at = value | (byte & 127) << shift, shift + 7, at + 1
        if byte < 128:
            return value, at


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and raw value of every field of a protobuf message."""
    at = 0
    while at < len(data):
        tag, at = _varint(data, at)
        kind = tag & 7
        if kind == 0:
            value, at = _varint(data, at)
        else:
            size, at = _varint(data, at) if kind == 2 else ({1: 8, 5: 4}[kind], at)
            value, at = data[at:at + size], at + size
        yield tag >> 3, value


@dataclass
class Model:
    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    squeeze: bool = True
    escape: bool = True
    suffix: bool = False

    @property
    def unknown(self) -> int:
        return next(i for i, p in enumerate(self.pieces) if p[2] == UNKNOWN)


def parse(data: bytes) -> Model:
    """The parts of a model file that encoding and decoding need."""
    model = Model()
    for number, value in fields(data):
        if number == 1:
            piece = {1: b"", 2: struct.pack("<f", 0.0), 3: NORMAL} | dict(fields(value))
            model.pieces.append((piece[1].decode(), struct.unpack("<f", piece[2])[0], piece[3]))
        elif number == 2:
            spec = dict(fields(value))
            model.kind, model.byte_fallback, model.suffix = spec.get(3, UNIGRAM), bool(spec.get(35, 0)), bool(spec.get(24, 0))
        elif number == 3:
            spec = dict(fields(value))
            model.charsmap = spec.get(2, b"")
            model.dummy_prefix, model.squeeze, model.escape = (bool(spec.get(i, 1)) for i in (3, 4, 5))
    if model.kind not in (UNIGRAM, BPE) or model.suffix or not model.escape:
        raise ValueError("unigram and merge models with blanks before words are supported")
    return model


def _merges(pieces: list[tuple[str, float, int]]) -> list[tuple[str, str]]:
    """All ways to form a piece from two, best score first."""
    usable = {p: i for i, (p, _, kind) in enumerate(pieces) if kind in (NORMAL, USER_DEFINED)}
    found = [(-pieces[i][1], i, usable[p[:k]], usable[p[k:]]) for p, i in usable.items() for k in range(1, len(p)) if p[:k] in usable and p[k:] in usable]
    return [(pieces[a][0], pieces[b][0]) for _, _, a, b in sorted(found)]


def splits(model: Model) -> bool:
    """No piece goes on after a blank that follows something else."""
    return not any(BLANK in p.lstrip(BLANK) for p, _, _ in model.pieces)


def build(model: Model, parts: bool = False):
    """The tokenizer of a parsed model; parts: for words with the blanks before them, already normalised."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

    unknown = model.pieces[model.unknown][0]
    if model.kind == UNIGRAM:
        core = models.Unigram([(p, s) for p, s, _ in model.pieces], unk_id=model.unknown, byte_fallback=model.byte_fallback)
    else:
        core = models.BPE({p: i for i, (p, _, _) in enumerate(model.pieces)}, _merges(model.pieces), unk_token=unknown, fuse_unk=True, byte_fallback=model.byte_fallback)
    out = Tokenizer(core)
    steps = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
    if model.squeeze:
        steps += [normalizers.Replace(Regex(" {2,}"), " "), normalizers.Replace(Regex("^ +| +$"), "")]
    prefix = [normalizers.Prepend(BLANK)] if model.dummy_prefix and not parts else []
    out.normalizer = normalizers.Sequence([*([] if parts else steps), *prefix, normalizers.Replace(" ", BLANK)])
    if splits(model) and not parts:
        out.pre_tokenizer = pre_tokenizers.Split(Regex(f"{BLANK}*[^{BLANK}]+|{BLANK}+"), "isolated")
    strip = [decoders.Strip(" ", 1, 0)] if model.dummy_prefix and not parts else []
    out.decoder = decoders.Sequence([decoders.Replace(BLANK, " "), decoders.ByteFallback(), decoders.Fuse(), *strip])
    return out


class Codec:
    """Encodes the texts of a worker process. Words are encoded once, as long as the cache holds them."""

    def __init__(self, data: bytes):
        self.model = parse(data)
        self.parts = build(self.model, parts=True) if splits(self.model) else None
        self.plain = not self.model.charsmap and not self.model.squeeze
        # the cache: sorted hashes of words and their places; by place, where the ids begin, whether they decode to the word, whether it came again
        self.codes, self.place, self.begin = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(1, np.int64)
        self.ids, self.same, self.again = np.zeros(0, np.int32), np.zeros(0, bool), np.zeros(0, bool)

    @cached_property
    def whole(self):
        """The tokenizer of whole texts, which encoding by words has no use for."""
        return build(self.model)

    def encode(self, texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
        """First and last row, offsets and ids of their tokens, and whether decoding gives the normalised text."""
        if not self.plain and len(texts):
            tidy = self._tidy()
            texts = pa.array([tidy.normalize_str(x.as_py() or "") for x in texts], pa.string())
        for chunk in chunks(texts, CHUNK):
            yield chunk.first, chunk.last, *(self._by_words(chunk) if self.parts else self._by_texts(chunk))

    def _tidy(self):
        from tokenizers import Regex, normalizers

        steps = [normalizers.Precompiled(self.model.charsmap)] if self.model.charsmap else []
        if self.model.squeeze:
            steps += [normalizers.Replace(Regex(" {2,}"), " "), normalizers.Replace(Regex("^ +| +$"), "")]
        return normalizers.Sequence(steps)

    def _by_texts(self, chunk: Chunk):
        texts = [bytes(chunk.buf[a:b]).decode() for a, b in zip(chunk.offsets, chunk.offsets[1:])]
        ids = [e.ids for e in self.whole.encode_batch_fast(texts, add_special_tokens=False)]
        back = self.whole.decode_batch(ids, skip_special_tokens=False)
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])])
        return offsets, np.fromiter((i for x in ids for i in x), np.int32), np.array([x == y for x, y in zip(back, texts, strict=True)])

    def _by_words(self, chunk: Chunk):
        sizes = np.diff(chunk.offsets)
        add = (sizes > 0) & self.model.dummy_prefix
        offsets = chunk.offsets + np.concatenate([[0], np.cumsum(add)])
        buf = np.full(offsets[-1], 32, np.uint8)
        buf[np.arange(len(chunk.buf)) + np.repeat(np.cumsum(add), sizes)] = chunk.buf
        blank = buf == 32
        start = blank.copy()
        start[1:] &= ~blank[:-1]
        start[offsets[:-1][sizes > 0]] = True
        at = np.flatnonzero(start)
        ends = np.append(at[1:], len(buf))
        codes, first, back = np.unique(segment_hash(prefix_hash(buf), at, ends, buf), return_index=True, return_inverse=True)
        held = self._held(codes, lambda i: cut(buf, at[first[i]], ends[first[i]]).cast(pa.string()).to_pylist())
        begin, count = self.begin[held], (self.begin[held + 1] - self.begin[held])[back]
        total = np.concatenate([[0], np.cumsum(count)])
        ids = self.ids[np.arange(total[-1]) + np.repeat(begin[back] - total[:-1], count)]
        same = np.concatenate([[0], np.cumsum(~self.same[held][back])])
        edge = np.searchsorted(at, offsets)
        return total[edge], ids, same[edge[1:]] == same[edge[:-1]]

    def _held(self, codes: np.ndarray, words) -> np.ndarray:
        """Places of words, given by their sorted hashes, in the cache; words(i): those at i of them, asked for what has to be encoded."""
        if len(self.codes) > CACHED or len(self.ids) > IDS_PER_WORD * CACHED:
            self._forget()
        at = np.searchsorted(self.codes, codes)
        has = at < len(self.codes)
        has[has] = self.codes[at[has]] == codes[has]
        self.again[self.place[at[has]]] = True
        if len(new := np.flatnonzero(~has)):
            ids, n, same = self._encoded(words(new))
            place = np.arange(len(self.same), len(self.same) + len(new))
            self.codes, self.place = np.insert(self.codes, at[new], codes[new]), np.insert(self.place, at[new], place)
            self.begin = np.concatenate([self.begin, self.begin[-1] + np.cumsum(n)])
            self.ids, self.same = np.concatenate([self.ids, ids]), np.concatenate([self.same, same])
            self.again = np.concatenate([self.again, np.zeros(len(new), bool)])
        return self.place[np.searchsorted(self.codes, codes)]

    def _forget(self) -> None:
        """Keep the words that came again since the last time, if they are at most half of what is held."""
        n = np.diff(self.begin)
        if 2 * self.again.sum() > CACHED or 2 * n[self.again].sum() > IDS_PER_WORD * CACHED:
            self.again[:] = False
        stay = self.again[self.place]
        self.codes, self.place = self.codes[stay], (np.cumsum(self.again) - 1)[self.place[stay]]
        self.ids, self.same = self.ids[np.repeat(self.again, n)], self.same[self.again]
        self.begin = np.concatenate([[0], np.cumsum(n[self.again])])
        self.again = np.zeros(len(self.same), bool)

    def _encoded(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids of words, how many each has, and whether they decode to it. Pieces spell the word, save for unknown ones, signs that stand for
        blanks, and pieces that look like bytes; only words with these are decoded."""
        found = []
        for i in range(0, len(words), 1 << 16):
            part = words[i:i + (1 << 16)]
            lists = [e.ids for e in self.parts.encode_batch_fast(part, add_special_tokens=False)]
            n = np.fromiter(map(len, lists), np.int64, len(lists))
            ids = np.fromiter(chain.from_iterable(lists), np.int32, n.sum())
            odd = np.fromiter((BLANK in w or "<0x" in w for w in part), bool, len(part))
            odd[np.repeat(np.arange(len(part)), n)[ids == self.model.unknown]] = True
            at, same = np.flatnonzero(odd), ~odd
            same[at] = [part[j] == t for j, t in zip(at, self.parts.decode_batch([lists[j] for j in at], skip_special_tokens=False), strict=True)]
            found.append((ids, n, same))
        return tuple(map(np.concatenate, zip(*found)))


_built: dict[bytes, Codec] = {}


def _codec(data: bytes, threads: int) -> Codec:
    """One codec per worker process and model."""
    key = hashlib.sha256(data).digest()
    if key not in _built:
        os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        _built[key] = Codec(data)
    return _built[key]


def model_bytes(path: str) -> bytes:
    """A model file; it goes to every task, so its size is checked."""
    if os.path.getsize(path) > MODEL_LIMIT:
        raise ValueError(f"the model has more than {MODEL_LIMIT} bytes")
    with open(path, "rb") as f:
        return f.read()


def _encode_batches(data: bytes, threads: int, digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(data, threads)
        for batch in batches:
            names = [f"_{i}" for i in range(batch.num_columns - 1)]
            for first, last, offsets, ids, same in codec.encode(batch.column(0)):
                if digest:
                    raw = [hashlib.sha256(ids[a:b].tobytes()).hexdigest() for a, b in zip(offsets, offsets[1:])]
                    out = {"n_tokens": pa.array(np.diff(offsets)), "ids_sha256": pa.array(raw, pa.string()), "round_trip": pa.array(same)}
                else:
                    out = {"token_ids": pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids))}
                yield pa.RecordBatch.from_pydict({n: c.slice(first, last - first) for n, c in zip(names, batch.columns[1:], strict=True)} | out)
    return run


def _with(docs: DataFrame, first: str, keep: list[str], run, added: str) -> DataFrame:
    rows = docs.select(quoted(first).alias("first"), *(quoted(c).alias(f"_{i}") for i, c in enumerate(keep)))
    kinds = "".join(f"_{i} {docs.schema[c].dataType.simpleString()}, " for i, c in enumerate(keep))
    out = rows.mapInArrow(run, kinds + added)
    return out.select(*(F.col(f"_{i}").alias(c) for i, c in enumerate(keep)), *(x.split()[0] for x in added.split(", ")))


def encode(docs: DataFrame, model: str = MODEL, text: str = "text", keep: list[str] | None = None, threads: int = 2) -> DataFrame:
    """The columns `keep` (default: all) with token_ids, the ids of each whole text without any added ones.

    A null or empty text has no tokens. Rows are independent: repeated rows give repeated results, an empty table an empty one. A column
    that is called token_ids already must not be kept.
    """
    keep = docs.columns if keep is None else keep
    if "token_ids" in keep:
        raise ValueError("there is a column token_ids already")
    return _with(docs, text, keep, _encode_batches(model_bytes(model), threads, False), "token_ids array<int>")


def digests(docs: DataFrame, keep: list[str], model: str = MODEL, text: str = "text", threads: int = 2) -> DataFrame:
    """`keep` with n_tokens, ids_sha256 (of the ids as 32-bit little-endian integers) and round_trip (decoding gives the text)."""
    return _with(docs, text, keep, _encode_batches(model_bytes(model), threads, True), "n_tokens long, ids_sha256 string, round_trip boolean")


def decode(encoded: DataFrame, model: str = MODEL, ids: str = "token_ids", keep: list[str] | None = None, threads: int = 2) -> DataFrame:
    """The columns `keep` (default: all but the ids) with decoded, the text of each list of ids. A null list gives an empty text."""
    data = model_bytes(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = _codec(data, threads).whole
        for batch in batches:
            texts = tool.decode_batch([x.as_py() or [] for x in batch.column(0)], skip_special_tokens=False)
            names = [f"_{i}" for i in range(batch.num_columns - 1)] + ["decoded"]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(texts, pa.string())], names=names)

    return _with(encoded, ids, [c for c in encoded.columns if c != ids] if keep is None else keep, run, "decoded string")
