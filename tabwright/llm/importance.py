"""Importance resampling towards a target distribution, over hashed word runs with a head-tail vocabulary.

A feature is a run of consecutive words; its bucket is the CRC-32 of its bytes modulo the number of buckets. The head of the vocabulary, the
words that make up at least 1/HEAD of what a batch holds and of all together, travels to every task with the CRC state after each word;
frequent pairs travel with their finished buckets. Words of the head are found by one dictionary lookup and cost no CRC. The tail, whatever
is not found, takes its CRC byte by byte. Both add up to the same exact bucket totals: the head only decides how a bucket is worked out.

The totals, one row per task and bucket, give a gain per bucket. A second pass averages gains per document, and the draw with
Gumbel noise (a hash of the id) is the global order by score: one range shuffle, whose partitions number their own rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.llm.bytesvec import chunks, cut, lower, spans
from tabwright.llm.documents import quoted
from tabwright.operators.ordered import numbered
from tabwright.sources.shared import durable

HEAD = 32_768  # most words, and most pairs, that travel to every task
LONG_WORD = 64  # bytes beyond which a word's CRC is worked out by itself
_GAP = np.ones(256, bool)
_GAP[48:58] = _GAP[65:91] = _GAP[97:123] = _GAP[128:] = False
_TABLE = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _TABLE = np.where(_TABLE & 1, np.uint32(0xEDB88320) ^ (_TABLE >> 1), _TABLE >> 1)


def extend(state: np.ndarray, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of a text followed by buf[starts[i]:ends[i]], from the CRC-32 of the text (0: nothing before)."""
    state, length = ~state, ends - starts
    order = np.argsort(-length, kind="stable")
    sorted_lengths = -length[order]
    for j in range(int(min(length.max(initial=0), LONG_WORD))):
        at = order[:np.searchsorted(sorted_lengths, -j, "left")]  # those with a byte j
        state[at] = _TABLE[(state[at] ^ buf[starts[at] + j]) & 0xFF] ^ (state[at] >> np.uint32(8))
    for i in order[:np.searchsorted(sorted_lengths, -LONG_WORD, "left")]:
        state[i] = ~np.uint32(zlib.crc32(buf[starts[i] + LONG_WORD:ends[i]].tobytes(), int(~state[i])))
    return ~state


@dataclass
class Head:
    """Frequent words with the CRC-32 after each, and frequent pairs (first place * words + second place, sorted) with the CRC-32 of each."""

    words: pa.Array
    states: np.ndarray
    pairs: np.ndarray
    pair_states: np.ndarray


def _features(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, doc: np.ndarray, longest: int, head: Head) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For runs of 1, 2, ... words: the word each starts at, and its CRC-32."""
    n = len(starts)
    place = np.full(n, -1, np.int64)
    if len(head.words) and n:
        place = pc.fill_null(pc.index_in(cut(buf, starts, ends), head.words), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    tail = np.flatnonzero(place < 0)
    state = np.zeros(n, np.uint32)
    state[place >= 0] = head.states[place[place >= 0]]
    state[tail] = extend(np.zeros(len(tail), np.uint32), buf, starts[tail], ends[tail])
    at = np.arange(n)
    yield at, state
    for size in range(2, longest + 1):
        whole = np.flatnonzero(doc[at[:n - size + 1]] == doc[at[:n - size + 1] + size - 1]) if n >= size else at[:0]
        before, last = state[whole], whole + size - 1
        after = np.zeros(len(whole), np.uint32)
        open_ = np.ones(len(whole), bool)
        if size == 2 and len(head.pairs):
            key = place[whole] * len(head.words) + place[last]
            slot = np.minimum(np.searchsorted(head.pairs, key), len(head.pairs) - 1)
            known = (head.pairs[slot] == key) & (place[whole] >= 0) & (place[last] >= 0)
            after[known], open_ = head.pair_states[slot[known]], ~known
        rest = np.flatnonzero(open_)
        spaced = ~before[rest]
        spaced = ~(_TABLE[(spaced ^ np.uint32(32)) & 0xFF] ^ (spaced >> np.uint32(8)))
        after[rest] = extend(spaced, buf, starts[last[rest]], ends[last[rest]])
        yield whole, after
        state = np.zeros(n, np.uint32)
        state[whole] = after


def _words(column: pa.Array):
    """Chunks of a batch as (chunk, lower-cased bytes, starts, ends, document of each word)."""
    for chunk in chunks(column):
        starts, ends, first = spans(chunk, _GAP)
        yield chunk, lower(chunk.buf), starts, ends, np.repeat(np.arange(len(chunk)), np.diff(first))


def _frequent(parts: list[tuple[pa.Array, np.ndarray]], head: int) -> pa.Table:
    table = pa.table({"gram": pa.concat_arrays([p[0] for p in parts]), "n": np.concatenate([p[1] for p in parts])})
    table = table.group_by("gram").aggregate([("n", "sum")]).rename_columns(["gram", "n"])
    total = pc.sum(table["n"]).as_py() or 0
    return table.filter(pc.greater_equal(pc.multiply(table["n"], head), total))


def _count_head(head: int, known: pa.Array | None):
    """Frequent words of every batch; with `known` words, frequent pairs of these. At most `head` rows a batch, since each has that share of it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for _, buf, starts, ends, doc in _words(batch.column(0)):
                if not len(starts):
                    continue
                cells = cut(buf, starts, ends)
                if known is None:
                    found = pc.value_counts(cells)
                    parts.append((found.field("values"), found.field("counts").to_numpy()))
                    continue
                place = pc.fill_null(pc.index_in(cells, known), -1).to_numpy(zero_copy_only=False).astype(np.int64)
                both = np.flatnonzero((doc[:-1] == doc[1:]) & (place[:-1] >= 0) & (place[1:] >= 0))
                keys, n = np.unique(place[both] * len(known) + place[both + 1], return_counts=True)
                parts.append((pa.array(keys), n.astype(np.int64)))
            if parts:
                table = _frequent(parts, head)
                yield from table.combine_chunks().to_batches()
    return run


def learn_head(texts: DataFrame, longest: int = 1, head: int = HEAD) -> Head:
    """Frequent words, and frequent pairs if runs of two or more words are wanted, of the one column of `texts`, all rows.

    At most `head` of each reach the driver. What is missed here is worked out as tail, with the same result.
    """
    def top(known: pa.Array | None, kind: str) -> pa.Table:
        found = texts.mapInArrow(_count_head(head, known), f"gram {kind}, n long").groupBy("gram").agg(F.sum("n").alias("n"))
        return found.orderBy(F.desc("n"), "gram").limit(head).toArrow()

    words = top(None, "binary")["gram"].combine_chunks().cast(pa.binary())
    cells = words.to_pylist()
    states = np.array([zlib.crc32(w) for w in cells], np.uint32)
    pairs, pair_states = np.zeros(0, np.int64), np.zeros(0, np.uint32)
    if longest > 1 and len(words):
        pairs = np.sort(top(words, "long")["gram"].to_numpy())
        pair_states = np.array([zlib.crc32(b" " + cells[p % len(words)], int(states[p // len(words)])) for p in pairs], np.uint32)
    return Head(words, states, pairs, pair_states)


def _totals(longest: int, buckets: int, head: Head):
    """Bucket totals of a task: one row per bucket that occurs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, buf, starts, ends, doc in _words(batch.column(0)):
                for _, crc in _features(buf, starts, ends, doc, longest, head):
                    seen += np.bincount(crc % np.uint32(buckets), minlength=buckets)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[at])], names=["bucket", "n"])
    return run


def bucket_totals(texts: DataFrame, longest: int, buckets: int, head: Head) -> np.ndarray:
    """How many features of all texts fall into each bucket; `buckets` numbers reach the driver."""
    rows = texts.mapInArrow(_totals(longest, buckets, head), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets, np.int64)
    out[rows["bucket"].to_numpy()] = rows["n"].to_numpy()
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket, 1000 times the logarithm of the smoothed ratio target to source, floored."""
    k = len(source)
    s, t = source.astype(np.float64), target.astype(np.float64)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + k) / ((s + 1) * (t.sum() + k)))).astype(np.int64)


def _weigh(longest: int, gain: np.ndarray, head: Head, fields: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, buf, starts, ends, doc in _words(batch.column(0)):
                size = len(chunk)
                count, total = np.zeros(size, np.int64), np.zeros(size, np.int64)
                for at, crc in _features(buf, starts, ends, doc, longest, head):
                    count += np.bincount(doc[at], minlength=size)
                    sums = np.concatenate([[0], np.cumsum(gain[crc % np.uint32(len(gain))])])
                    bounds = np.searchsorted(doc[at], np.arange(size + 1))
                    total += sums[bounds[1:]] - sums[bounds[:-1]]
                words = np.bincount(doc, minlength=size)
                kept = [c.slice(chunk.first, size) for c in batch.columns[1:]]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(words), pa.array(count), pa.array(total // np.maximum(count, 1))],
                                                 names=[*(f"_{i}" for i in range(fields)), "n_words", "n_features", "weight"])
    return run


def resample(docs: DataFrame, target: DataFrame, longest: int = 1, buckets: int = 10_000, percent: int = 10, least_words: int = 20, seed: int = 2024,
             id: str = "doc_id", text: str = "text", target_text: str = "text", head: int = HEAD) -> DataFrame:
    """doc_id, n_features, weight, score and rank (null: not drawn) of every row of `docs`, drawn towards the texts of `target`.

    Of the rows with `least_words` or more, floor(percent of them) are drawn, those with the highest score; ties go to the smaller id.
    Null and empty texts have no features and weight 0. A null id draws noise like an empty one and comes last among ties. Every row
    counts and is ranked for itself, so repeated rows are drawn for themselves. An empty table gives an empty result; an empty target gives
    every bucket the same target count. Other columns of either table are not looked at.
    """
    texts = docs.select(quoted(text).alias("text"))
    learned = learn_head(texts, longest, head)
    source = bucket_totals(texts, longest, buckets, learned)
    wanted = bucket_totals(target.select(quoted(target_text).alias("text")), longest, buckets, learned)
    kind = docs.schema[id].dataType.simpleString()
    rows = docs.select(quoted(text).alias("text"), quoted(id).alias("_0"))
    weighed = rows.mapInArrow(_weigh(longest, gains(source, wanted), learned, 1), f"_0 {kind}, n_words long, n_features long, weight long")
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("_0").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296)))
    scored = weighed.select("_0", "n_features", "weight", (F.col("weight") + noise).alias("score"), (F.col("n_words") >= least_words).alias("able"))
    placed = numbered(durable(scored, "scored"), [F.desc("able"), F.desc("score"), F.asc_nulls_last("_0")], "place")
    able = placed.where("able").count()
    rank = F.when(F.col("able") & (F.col("place") <= percent * able // 100), F.col("place"))
    return placed.select(F.col("_0").alias("doc_id"), "n_features", "weight", "score", rank.alias("rank"))
