"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming search, exact verification.

Words are runs of letters and digits in lower case. An item and each window of a document with as many words have a weighted set of five-word
shingles (an item with fewer words is one shingle); weights are counts. Two are similar if the sum of the smaller weights is at least
`percent` of the sum of the larger ones.

A similar window holds at least 2p / (1 + p) of its shingles in common with the item, so windows with fewer shingles that any
item has are not fingerprinted; this rules out nothing similar. The fingerprints of the others are looked up among the items of
their size: 64 bits in four blocks, and of two fingerprints within the radius at least one block differs in a quarter of it
at most, so the blocks' tables find every item within the radius. Those are verified on the weighted shingles.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.llm.bytesvec import Chunk, chunks, mix, prefix_hash, segment_hash
from tabwright.llm.documents import quoted

SHINGLE = 5
PERCENT = 80
RADIUS = 23
ITEMS_BYTES = 32 << 20
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True
_FACTORS = np.array([pow(0xD6E8FEB86659FD93, j, 1 << 64) for j in range(SHINGLE)], np.uint64)
_BLOCKS = 4


def _words(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and the first word of each document; the text is in lower case."""
    inside = np.concatenate([[False], _WORD[chunk.buf], [False]])
    edge = np.zeros(len(inside), bool)
    edge[chunk.offsets + 1] = True  # words end with their document
    here, before = inside[1:], inside[:-1]
    starts = np.flatnonzero(here & (~before | edge[1:]))
    ends = np.flatnonzero(before & (~here | edge[1:]))
    return segment_hash(prefix_hash(chunk.buf), starts, ends, chunk.buf), np.searchsorted(starts, chunk.offsets)


def _shingles(words: np.ndarray, size: int) -> np.ndarray:
    if len(words) < size:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(words) - size + 1, np.uint64)
    for j in range(size):
        out += words[j:len(out) + j] * _FACTORS[j]
    return mix(out + np.uint64(size))


def _bits(shingles: np.ndarray) -> np.ndarray:
    """A row of 64 signs per shingle."""
    return np.unpackbits(shingles.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.int16) * 2 - 1


def _packed(sums: np.ndarray) -> np.ndarray:
    return np.packbits(sums > 0, axis=1, bitorder="little").view("<u8").reshape(-1)


def _similar(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """Sum of the smaller and of the larger weights of two shingle lists."""
    keys, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = np.bincount(at[:len(a)], minlength=len(keys)), np.bincount(at[len(a):], minlength=len(keys))
    return int(np.minimum(x, y).sum()), int(np.maximum(x, y).sum())


_COUNTS = np.array([bin(i).count("1") for i in range(1 << 16)], np.uint8)


class _OfSize:
    """The items with one number of words."""

    def __init__(self, size: int, ids: list[int], shingles: list[np.ndarray], radius: int):
        self.words, self.size, self.ids, self.shingles, self.radius = size, min(size, SHINGLE), ids, shingles, radius
        self.prints = np.concatenate([_packed(_bits(s).sum(0, keepdims=True)) for s in shingles])
        # the distinct values of every block, and which of them each item has
        blocks = [((self.prints >> np.uint64(16 * b)) & np.uint64(0xFFFF)).astype(np.uint16) for b in range(_BLOCKS)]
        self.values = [np.unique(x, return_inverse=True) for x in blocks]

    def within(self, print_: int) -> np.ndarray:
        """All items within the radius of a fingerprint: in some block they are near it, and then they are compared as a whole."""
        some = np.zeros(len(self.prints), bool)
        for b, (values, of) in enumerate(self.values):
            some |= (_COUNTS[values ^ np.uint16(print_ >> 16 * b & 0xFFFF)] <= self.radius // _BLOCKS)[of]
        at = np.flatnonzero(some)
        apart = (self.prints[at] ^ np.uint64(print_)).view(np.uint16).reshape(-1, _BLOCKS)
        return at[_COUNTS[apart].sum(1) <= self.radius]


class Items:
    """Benchmark items, prepared for the search."""

    def __init__(self, ids: list[int], texts: pa.Array, percent: int, radius: int):
        self.percent = percent
        by_size = defaultdict(lambda: ([], []))
        for chunk in chunks(texts):
            words, first = _words(chunk)
            for i in range(len(chunk)):
                own = words[first[i]:first[i + 1]]
                if len(own):
                    group = by_size[len(own)]
                    group[0].append(ids[chunk.first + i])
                    group[1].append(_shingles(own, min(len(own), SHINGLE)))
        self.sizes = [_OfSize(n, *group, radius) for n, group in sorted(by_size.items())]
        self.gates = {k: np.unique(np.concatenate([s for g in self.sizes if g.size == k for s in g.shingles])) for k in {g.size for g in self.sizes}}

    def find(self, chunk: Chunk) -> Iterator[tuple[int, int, int, int, float]]:
        """Document of the chunk, item, number of similar windows, first word and similarity of the best one."""
        words, first = _words(chunk)
        for k, gate in self.gates.items():
            shingles = _shingles(words, k)
            at = np.minimum(np.searchsorted(gate, shingles), len(gate) - 1)
            hit = gate[at] == shingles
            places = np.flatnonzero(hit)
            if not len(places):
                continue
            docs = np.unique(np.searchsorted(first, places, "right") - 1)
            for i in docs.tolist():
                lo, hi = int(first[i]), int(first[i + 1]) - k + 1
                if hi > lo and hit[lo:hi].any():
                    yield from ((i, *row) for row in self._in_document(shingles[lo:hi], hit[lo:hi], k))

    def _in_document(self, shingles: np.ndarray, hit: np.ndarray, k: int):
        best: dict[int, list] = {}
        hits = np.concatenate([[0], np.cumsum(hit)])
        p = self.percent / 100
        for group in self.sizes:
            m = group.words - k + 1
            if group.size != k or len(shingles) < m:
                continue
            starts = np.flatnonzero(hits[m:] - hits[:-m] >= math.ceil(2 * p / (1 + p) * m - 1e-9))
            for part in np.split(starts, np.flatnonzero(np.diff(starts) > m) + 1) if len(starts) else []:
                for lo in range(0, len(part), 4096):  # the signs of a stretch of windows at a time
                    some = part[lo:lo + 4096]
                    base, end = some[0], some[-1] + m
                    sums = np.concatenate([np.zeros((1, 64), np.int32), np.cumsum(_bits(shingles[base:end]), 0, dtype=np.int32)])
                    prints = _packed(sums[some - base + m] - sums[some - base])
                    for s, x in zip(some.tolist(), prints.tolist()):
                        for j in group.within(x).tolist():
                            low, high = _similar(shingles[s:s + m], group.shingles[j])
                            if 100 * low >= self.percent * high:
                                row = best.setdefault(group.ids[j], [0, s, -1.0])
                                row[0] += 1
                                if low / high > row[2]:
                                    row[1:] = s, low / high
        return [(item, *row) for item, row in sorted(best.items())]


def load_items(benchmark: DataFrame, id: str = "item_id", text: str = "text", percent: int = PERCENT, radius: int = RADIUS, limit: int = ITEMS_BYTES) -> list[Items]:
    """The benchmark in slices of about `limit` bytes; each goes to all tasks, so a benchmark of any size is searched, slice by slice.

    Items without id or words match nothing.
    """
    rows = benchmark.select(quoted(id).cast("long").alias("item_id"), F.lower(quoted(text)).alias("text")).where("item_id is not null and text is not null")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    slices = -(-size // limit) or 1
    out = []
    for i in range(slices):
        table = rows.where(F.expr(f"pmod(xxhash64(item_id, text), {slices}) = {i}")).orderBy("item_id", "text").toArrow()
        out.append(Items(table["item_id"].to_pylist(), table["text"].combine_chunks(), percent, radius))
    return out


def _pair_batches(items: Items):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                rows = list(items.find(chunk))
                if rows:
                    at, item, n, start, similarity = zip(*rows)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array([chunk.first + i for i in at])), pa.array(item, pa.int64()), pa.array(n, pa.int64()), pa.array(start, pa.int64()), pa.array(similarity, pa.float64())],
                        names=["doc_id", "item_id", "n_windows", "first_word", "similarity"])
    return run


def contaminated(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """(doc_id, item_id, n_windows, first_word, similarity) for each document with a window similar to an item; the best window's first word.

    Null, empty and wordless texts match nothing; so does everything if the benchmark is empty. Of equally similar windows the first counts. Rows are
    searched each for itself: repeated documents give repeated results, and equal items one result each. Other columns are ignored.
    """
    rows = docs.select(quoted(id).alias("doc_id"), F.lower(quoted(text)).alias("text"))
    kind = f"doc_id {docs.schema[id].dataType.simpleString()}, item_id long, n_windows long, first_word long, similarity double"
    parts = [rows.mapInArrow(_pair_batches(items), kind) for items in load_items(benchmark, **options)]
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


def _clean_batches(items: Items):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.ones(batch.num_rows, bool)
            for chunk in chunks(batch.column(0)):
                keep[[chunk.first + row[0] for row in items.find(chunk)]] = False
            yield pa.RecordBatch.from_arrays(batch.columns[1:], names=batch.schema.names[1:]).filter(pa.array(keep))
    return run


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """The documents, all columns as they are, without those that have a window similar to a benchmark item."""
    names = docs.columns
    kinds = ", ".join(f"_{i} {f.dataType.simpleString()}" for i, f in enumerate(docs.schema))
    for items in load_items(benchmark, **options):
        rows = docs.select(F.lower(quoted(text)).alias("lowered"), *(quoted(c).alias(f"_{i}") for i, c in enumerate(names)))
        docs = rows.mapInArrow(_clean_batches(items), kinds).select(*(F.col(f"_{i}").alias(c) for i, c in enumerate(names)))
    return docs
