"""Removal of repeated byte strings by anchors and content hashes of two lengths, in place of the sorted ranks of prefix doubling.

A position p is removed material if the `length` bytes from p also start earlier (in a smaller document, or earlier in the same one).
Sorting every position is wasteful: most are unique after a few bytes. So nothing is ranked again at growing offsets; the first round groups sampled positions only. In every
string of `length` bytes the position with the least hash of its first `seed` bytes is the anchor, hence equal strings have equal anchors
at equal offsets, and a string can only repeat where its anchor's rank does.

Round 1 sorts (rank of `seed` bytes, rank of the anchor's whole neighbourhood, position). Unique ranks leave. A neighbourhood seen
before is a repeat as a whole; of the first of each kind, where several kinds share an anchor, the single positions go on.
Round 2 sorts (rank of half the length at p, rank of half the length at p + length / 2, position): ranks past the threshold.

Ranks are 64-bit hashes of the bytes, compared in pairs. Positions that repeat within a batch of one task are settled there, so a rank that
a third of all documents share reaches its sorting task once per batch, not once per document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabwright.llm.bytesvec import chunks, gram_hash, mix, prefix_hash, segment_hash, signed, sliding_min
from tabwright.llm.documents import one_row_per_id
from tabwright.sources.shared import durable

LENGTH = 100
SEED = 36
_PLACE = np.uint64((1 << 32) - 1)
_ANCHORS = "seed long, around long, doc_id long, start long, span long, known boolean"
_PAIRS = "left long, right long, doc_id long, start long, known boolean"
_RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _anchors(chunk, length: int, seed: int):
    """Anchor hash, neighbourhood hash, document and range of string starts, for each anchor of a chunk."""
    buf, offsets = chunk.buf, chunk.offsets
    per_doc = np.maximum(np.diff(offsets) - length + 1, 0)
    if not per_doc.sum():
        return None
    prefix = prefix_hash(buf)
    grams = gram_hash(prefix, seed)
    least = sliding_min((grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64), length - seed + 1)  # least hash, then leftmost
    doc = np.repeat(np.arange(len(per_doc)), per_doc)
    start = np.arange(len(doc)) + np.repeat(offsets[:-1] - np.cumsum(per_doc) + per_doc, per_doc)
    anchor = (least[start] & _PLACE).astype(np.int64)
    new = np.ones(len(doc), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(new)
    first, last = start[at], start[np.append(at[1:], len(doc)) - 1]
    return grams[anchor[at]], segment_hash(prefix, first, last + length, buf), doc[at], first - offsets[doc[at]], last - first


def _settled(order: np.ndarray, *keys: np.ndarray) -> np.ndarray:
    """Which rows have an equal row before them; order: the rows from the earliest on, by key."""
    same = np.ones(len(order), bool)
    for k in keys:
        same[1:] &= k[order][1:] == k[order][:-1]
    same[:1] = False
    out = np.zeros(len(order), bool)
    out[order] = same
    return out


def _own_key(doc: np.ndarray, start: np.ndarray) -> np.ndarray:
    """A key for a settled row, which only has to travel on, evenly."""
    return mix(doc.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + start.view(np.uint64))


def _anchor_batches(length: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, found = batch.column(0).to_numpy(zero_copy_only=False), []
            for chunk in chunks(batch.column(1)):
                if (got := _anchors(chunk, length, seed)) is not None:
                    found.append((*got[:2], ids[chunk.first:chunk.last][got[2]], *got[3:]))
            if not found:
                continue
            key, around, doc, start, span = (np.concatenate(x) for x in zip(*found, strict=True))
            known = _settled(np.lexsort((start, doc, around, key)), key, around)
            key = np.where(known, _own_key(doc, start), key)
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed(key)), pa.array(signed(around)), pa.array(doc), pa.array(start), pa.array(span), pa.array(known)],
                names=["seed", "around", "doc_id", "start", "span", "known"])
    return run


def _ranges(column: pa.Array):
    """Offsets and the flat fields of a list-of-structs column; a null list is empty."""
    offsets = column.offsets.to_numpy().astype(np.int64)
    return offsets, column.values


def _pair_batches(length: int):
    half = length // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, found = batch.column(0).to_numpy(zero_copy_only=False), []
            bounds, fields = _ranges(batch.column(2))
            starts, spans = (fields.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            for chunk in chunks(batch.column(1)):
                lo, hi = bounds[chunk.first], bounds[chunk.last]
                doc = np.repeat(np.arange(len(chunk)), np.diff(bounds[chunk.first:chunk.last + 1]))
                n = spans[lo:hi] + 1
                within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                start, doc = np.repeat(starts[lo:hi], n) + within, np.repeat(doc, n)
                p = start + chunk.offsets[doc]
                prefix = prefix_hash(chunk.buf)
                found.append((segment_hash(prefix, p, p + half, chunk.buf), segment_hash(prefix, p + half, p + length, chunk.buf), ids[chunk.first:chunk.last][doc], start))
            left, right, doc, start = (np.concatenate(x) for x in zip(*found, strict=True))
            known = _settled(np.lexsort((start, doc, right, left)), left, right)
            left = np.where(known, _own_key(doc, start), left)
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed(left)), pa.array(signed(right)), pa.array(doc), pa.array(start), pa.array(known)],
                names=["left", "right", "doc_id", "start", "known"])
    return run


def _cut_batches(length: int, with_kept: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            whole, single = _ranges(batch.column(2)), _ranges(batch.column(3))
            w0, w1 = (whole[1].field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            s0 = single[1].to_numpy(zero_copy_only=False)
            rows = []
            for chunk in chunks(texts):
                for i in range(len(chunk)):
                    k = chunk.first + i
                    buf = chunk.buf[chunk.offsets[i]:chunk.offsets[i + 1]]
                    a, b = w0[whole[0][k]:whole[0][k + 1]], w1[whole[0][k]:whole[0][k + 1]]
                    c = s0[single[0][k]:single[0][k + 1]]
                    if not len(a) and not len(c):
                        rows.append((len(buf), 0, 0, buf.tobytes()))
                        continue
                    mark = np.zeros(len(buf) + 1, np.int64)
                    np.add.at(mark, a, 1)
                    np.subtract.at(mark, a + b + length, 1)
                    np.add.at(mark, c, 1)
                    np.subtract.at(mark, c + length, 1)
                    gone = np.cumsum(mark[:-1]) > 0
                    spans = int(gone[0]) + int(np.count_nonzero(gone[1:] & ~gone[:-1]))
                    rows.append((len(buf), int(gone.sum()), spans, buf[~gone].tobytes()))
            n, removed, spans, kept = zip(*rows, strict=True) if rows else ([], [], [], [])
            out = {"doc_id": batch.column(0), "n_bytes": pa.array(n, pa.int64()), "n_removed": pa.array(removed, pa.int64()),
                   "n_spans": pa.array(spans, pa.int64()), "kept_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string())}
            yield pa.RecordBatch.from_pydict(out | ({"kept": pa.array(kept, pa.binary())} if with_kept else {}))
    return run


def remove_repeats(docs: DataFrame, id: str = "doc_id", text: str = "text", length: int = LENGTH, seed: int = SEED,
                   with_kept: bool = True) -> DataFrame:
    """Cut out each byte covered by a `length`-byte string that also starts earlier.

    Returns doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256 and, if asked for, kept (the remaining bytes), one row per document.
    A null text is empty. Texts shorter than `length` stay whole. Rows without an id are left out; of rows that repeat an id the one with
    the smallest text counts. Copies of a text lose all bytes but in the document with the smallest id. Other columns are ignored; an empty table
    gives an empty result. Bytes are cut without regard to characters, so `kept` may not be valid UTF-8. ids must be integers.
    """
    if not 2 <= length // 2 <= length or not 8 <= seed <= length:
        raise ValueError("length must be 4 or more, and seed between 8 and length")
    docs = one_row_per_id(docs, id, text).withColumn("doc_id", F.col("doc_id").cast("long"))
    ranked = durable(_ranked(docs, length, seed), "anchors")
    return _cut(docs, ranked, length, with_kept)


def _ranked(docs: DataFrame, length: int, seed: int) -> DataFrame:
    """(doc_id, start, span, known): neighbourhoods that repeat as a whole (known), and those whose positions go on to the second round."""
    kinds = Window.partitionBy("seed")
    return (docs.mapInArrow(_anchor_batches(length, seed), _ANCHORS)
            .withColumn("turn", F.row_number().over(Window.partitionBy("seed", "around").orderBy("doc_id", "start")))
            .withColumn("several", F.min("around").over(kinds) < F.max("around").over(kinds))
            .withColumn("known", F.expr("known or turn > 1"))
            .where("known or several").select("doc_id", "start", "span", "known"))


def _cut(docs: DataFrame, ranked: DataFrame, length: int, with_kept: bool) -> DataFrame:
    lists = ranked.groupBy("doc_id").agg(
        F.collect_list(F.expr("case when not known then struct(start, span) end")).alias("check"),
        F.collect_list(F.expr("case when known then struct(start, span) end")).alias("whole"))
    open_ = docs.join(lists.select(F.col("doc_id").alias("of"), "check").where("size(check) > 0"), F.col("of") == F.col("doc_id")).select("doc_id", "text", "check")
    pairs = open_.mapInArrow(_pair_batches(length), _PAIRS)
    turn = F.row_number().over(Window.partitionBy("left", "right").orderBy("doc_id", "start"))
    single = (pairs.withColumn("turn", turn).where("known or turn > 1").groupBy(F.col("doc_id").alias("of2")).agg(F.collect_list("start").alias("single")))
    empty = "cast(array() as array<{}>)"
    ready = (docs.join(lists.select(F.col("doc_id").alias("of"), "whole"), F.col("of") == F.col("doc_id"), "left")
             .join(single, F.col("of2") == F.col("doc_id"), "left")
             .select("doc_id", "text", F.expr(f"coalesce(whole, {empty.format('struct<start:bigint,span:bigint>')}) as whole"),
                     F.expr(f"coalesce(single, {empty.format('bigint')}) as single")))
    return ready.mapInArrow(_cut_batches(length, with_kept), _RESULT + ", kept binary" * with_kept)
