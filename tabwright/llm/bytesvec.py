"""Vectorised work on the bytes of many texts at once: words, hashes of substrings, sliding minima.

Texts of an Arrow batch are cut into chunks of whole documents, so that memory follows the chunk (or one very long text),
not the batch. All hashes are 64 bits, equal on every machine and in every run.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from xxhash import xxh3_64_intdigest

CHUNK_BYTES = 1 << 20
LONG = 256  # bytes beyond which a string is hashed as a whole
_MULTIPLIER = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
_BYTE_CODES = np.random.Generator(np.random.PCG64(20260101)).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        for i, base in enumerate((_MULTIPLIER, _INVERSE)):
            table = np.full(max(n, CHUNK_BYTES + 4096), base, np.uint64)
            table[0] = 1
            _powers[i] = np.multiply.accumulate(table)
    return _powers


def give_back() -> None:
    """Return free memory to the system: a worker process is used again, and should not hold what its largest batch took."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit over all others."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def lower(buf: np.ndarray) -> np.ndarray:
    return _LOWER[buf]


class Chunk:
    """Whole documents: rows first..last of the batch; bytes in buf, document i in offsets[i]:offsets[i + 1]."""

    def __init__(self, first: int, last: int, buf: np.ndarray, offsets: np.ndarray):
        self.first, self.last, self.buf, self.offsets = first, last, buf, offsets

    def __len__(self) -> int:
        return self.last - self.first


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Cut an Arrow array of texts (null: empty) into chunks of about `limit` bytes, never inside a document."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    if not len(texts):
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        last = min(last, len(texts))
        yield Chunk(first, last, buf[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first])
        first = last
    give_back()


def spans(chunk: Chunk, gap: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of bytes that `gap`, a flag per byte, leaves; and the first run of each document."""
    buf, offsets = chunk.buf, chunk.offsets
    if not len(buf):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    between = gap[buf]
    starts, ends = ~between, ~between
    before, after = np.ones(len(buf), bool), np.ones(len(buf), bool)
    before[1:], after[:-1] = between[:-1], between[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(buf))]
    before[edges], after[edges - 1] = True, True
    at, to = np.flatnonzero(starts & before), np.flatnonzero(ends & after) + 1
    return at, to, np.searchsorted(at, offsets)


def words(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of bytes that are no ASCII white space, and the first word of each document."""
    return spans(chunk, _SPACE)


def prefix_hash(buf: np.ndarray) -> np.ndarray:
    """h with h[i + 1] - h[i] the code of byte i times a power of the multiplier; see segment_hash."""
    out = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_BYTE_CODES[buf] * _power_tables(len(buf) + 1)[0][:len(buf)], out=out[1:])
    return out


def segment_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray, buf: np.ndarray) -> np.ndarray:
    """One hash per byte string buf[starts[i]:ends[i]]; equal strings have equal hashes wherever they stand.

    Prefix sums modulo 2^64 have strings of structure (Thue-Morse, from about 1,000 bytes) that collide under every multiplier, so
    strings of more than LONG bytes are hashed by XXH3 instead.
    """
    raw = (prefix[ends] - prefix[starts]) * _power_tables(len(prefix))[1][starts]
    return _hash_long(mix(raw + (ends - starts).astype(np.uint64)), buf, starts, ends)


def run_hash(keys: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One hash per run of keys starts[i]:ends[i]; equal runs have equal hashes wherever they stand. Long ones as in segment_hash."""
    powers, inverse = _power_tables(len(keys) + 1)
    prefix = np.zeros(len(keys) + 1, np.uint64)
    np.cumsum(keys * powers[:len(keys)], out=prefix[1:])
    out = mix((prefix[ends] - prefix[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
    return _hash_long(out, np.ascontiguousarray(keys).view(np.uint8), starts * 8, ends * 8)


def _hash_long(out: np.ndarray, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    at = np.flatnonzero(ends - starts > LONG)
    if len(at):
        data = memoryview(np.ascontiguousarray(buf))
        out[at] = [xxh3_64_intdigest(data[a:b]) for a, b in zip(starts[at].tolist(), ends[at].tolist())]
    return out


def gram_hash(prefix: np.ndarray, size: int) -> np.ndarray:
    """The hash of every byte string of one size, by start."""
    n = len(prefix) - size
    return mix((prefix[size:] - prefix[:n]) * _power_tables(len(prefix))[1][:n] + np.uint64(size))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each `width` neighbours: log2(width) passes."""
    done = 1
    while done < width:
        step = min(done, width - done)
        x = np.minimum(x[:len(x) - step], x[step:])
        done += step
    return x


def cut(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The byte strings starts[i]:ends[i] as an Arrow binary array."""
    lengths = ends - starts
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(lengths, out=offsets[1:])
    at = np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], lengths)
    return pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(buf[at]))]).cast(pa.binary())


def signed(x: np.ndarray) -> np.ndarray:
    """Hashes as Spark's long."""
    return x.view(np.int64)
