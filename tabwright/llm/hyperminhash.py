"""Near duplicates by HyperMinHash: compressed minima in buckets, banding, corrected estimates, exact confirmation.

A document is the set of its word shingles. Each shingle hash falls into one of 256 buckets; of a bucket's least hash the register keeps the
count of leading zeros and ten mantissa bits. Buckets that stay empty (small sets) are filled with the least hash of the whole set under
the bucket's own hash function, so that registers agree with the probability of the Jaccard similarity at any set size.
Bands of registers propose candidates. The share of equal registers, corrected for accidental collisions, sorts out most
wrong ones; the rest is confirmed on the full shingle sets.

Equal sets are one class from the start; only class representatives are compared. Within a band, members are first compared with the
least one only. Then components are formed, and what is left to compare are members of one band that are in different components. Those outside
its largest component meet a few members of that, which links almost all that can be linked. Who is then still outside is compared with all members in
blocks of bounded size that only put out links. Every pair that shares a band is so linked, refuted or already in one component, and no
group is ever expanded into its pairs. A group with many members that are similar to each other but not linked is the costly case: its undecided
members are compared with all of it, which is what losing no link takes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.llm.bytesvec import Chunk, chunks, lower, mix, prefix_hash, segment_hash, signed, words
from tabwright.llm.components import components
from tabwright.llm.documents import one_row_per_id
from tabwright.sources.shared import durable

REGISTERS = 256
MANTISSA = 10
BLOCK = 512
_RANDOM = np.random.Generator(np.random.PCG64(7))
_BUCKET_FACTORS = _RANDOM.integers(1, 1 << 63, REGISTERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BAND_FACTORS = _RANDOM.integers(1, 1 << 63, REGISTERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_WORD_FACTOR = 0xD6E8FEB86659FD93
_SKETCH = "doc_id long, n_shingles long, sig1 long, sig2 long, registers binary"


def _accident() -> float:
    """Chance that two different minima share a register: the same leading-zero count, then the same mantissa."""
    rates = 2.0 ** np.arange(0, 1, 0.05)
    octaves = 2.0 ** -np.arange(-8.0, 40)
    inside = np.exp(-rates[:, None] * octaves / 2) - np.exp(-rates[:, None] * octaves)
    return float((inside ** 2).sum(1).mean()) / 2 ** MANTISSA


ACCIDENT = _accident()


def shingle_sets(chunk: Chunk, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every document of a chunk, and where each document's begin.

    A shingle is `size` words (A-Z in lower case); a document with fewer words has its whole sequence as its only one.
    """
    starts, ends, first = words(chunk)
    low = lower(chunk.buf)
    code = segment_hash(prefix_hash(low), starts, ends, low)
    n_words = np.diff(first)
    sets, bounds = [], np.zeros(len(chunk) + 1, np.int64)
    factors = np.array([pow(_WORD_FACTOR, j, 1 << 64) for j in range(size)], np.uint64)
    whole = np.zeros(max(0, len(code) - size + 1), np.uint64)
    for j in range(size if len(whole) else 0):
        whole += code[j:len(whole) + j] * factors[j]
    whole = mix(whole)
    for i in range(len(chunk)):
        n = n_words[i]
        if n >= size:
            part = np.sort(whole[first[i]:first[i + 1] - size + 1])
            part = part[np.concatenate(([True], part[1:] != part[:-1]))] if len(part) > 1 else part
        elif n:
            part = mix((code[first[i]:first[i + 1]] * factors[:n]).sum(keepdims=True) + np.uint64(n))
        else:
            part = whole[:0]
        sets.append(part)
        bounds[i + 1] = bounds[i] + len(part)
    return (np.concatenate(sets) if sets else np.zeros(0, np.uint64)), bounds


def _compressed(rest: np.ndarray) -> np.ndarray:
    """Leading zeros of 56 bits and the mantissa after them, as 16 bits."""
    fraction, bits = np.frexp(rest.astype(np.float64))
    return (((56 - bits).astype(np.int64) << MANTISSA) | ((fraction * 2 - 1) * 2 ** MANTISSA).astype(np.int64).clip(0)).astype(np.uint16)


def _registers(part: np.ndarray) -> np.ndarray:
    """Registers of one sorted set."""
    bucket = (part >> np.uint64(56)).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
    least = np.zeros(REGISTERS, np.uint64)
    least[bucket[first]] = part[first] & np.uint64((1 << 56) - 1)
    empty = np.ones(REGISTERS, bool)
    empty[bucket[first]] = False
    if empty.any():
        least[empty] = (part[None, :] * _BUCKET_FACTORS[empty][:, None]).min(1) >> np.uint64(8)
    return _compressed(least)


def _sketch_batches(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                sets, bounds = shingle_sets(chunk, size)
                parts = [sets[bounds[i]:bounds[i + 1]] for i in range(len(chunk))]
                sig = [np.array([p.sum(), mix(p).sum()], np.uint64) for p in parts]
                sig = signed(np.stack(sig))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(chunk.first, len(chunk)), pa.array(np.diff(bounds)), pa.array(sig[:, 0]), pa.array(sig[:, 1]),
                     pa.array([_registers(p).tobytes() if len(p) else None for p in parts], pa.binary())],
                    names=["doc_id", "n_shingles", "sig1", "sig2", "registers"])
    return run


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(len(column), REGISTERS)


def _band_batches(rows: int):
    bands = REGISTERS // rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            m = _matrix(batch.column(1))[:, :bands * rows].astype(np.uint64) + np.uint64(1)
            key = mix((m * _BAND_FACTORS[:bands * rows]).reshape(len(m), bands, rows).sum(2) + np.arange(bands, dtype=np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(signed(key.reshape(-1))), pa.array(np.repeat(batch.column(0).to_numpy(), bands))], names=["band", "doc_id"])
    return run


def _likely_batches(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            equal = (_matrix(batch.column(2)) == _matrix(batch.column(3))).mean(1)
            keep = pa.array((equal - ACCIDENT) / (1 - ACCIDENT) >= least)
            yield batch.select([0, 1]).filter(keep)
    return run


def _set_batches(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                sets, bounds = shingle_sets(chunk, size)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(chunk.first, len(chunk)), pa.array([sets[bounds[i]:bounds[i + 1]].tobytes() for i in range(len(chunk))], pa.binary())],
                    names=["doc_id", "shingles"])
    return run


def _confirm_batches(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))
    return run


def band_rows(threshold: float, miss: float = 1e-5) -> int:
    """The most registers a band can have so that a pair at the threshold is missed with a chance of `miss` at most."""
    fit = [r for r in range(1, 33) if (1 - threshold ** r) ** (REGISTERS // r) <= miss]
    return max(fit, default=1)


def _both(pairs: DataFrame, table: DataFrame, value: str) -> DataFrame:
    """Pairs (a, b) with the value of either side."""
    of_a = table.select(F.col("doc_id").alias("a"), F.col(value).alias("value_a"))
    of_b = table.select(F.col("doc_id").alias("b"), F.col(value).alias("value_b"))
    return pairs.join(of_b, "b").join(of_a, "a").select("a", "b", "value_a", "value_b")


def _links(pairs: DataFrame, reps: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs that are linked: first by their registers, well below the threshold, then by their full sets."""
    threshold = percent / 100
    margin = 6 * math.sqrt(threshold * (1 - threshold) / REGISTERS)
    likely = _both(pairs, reps, "registers").mapInArrow(_likely_batches(threshold - margin), "a long, b long")
    return durable(_both(likely, sets, "shingles").mapInArrow(_confirm_batches(percent), "a long, b long"), "links")


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id (the least id reachable over links, itself included) and kept (doc_id = component_id).

    Two documents are linked if 100 * intersection >= percent * union of their shingle sets. Candidates are found by bands, with a chance of
    at most 1e-5 to miss a link at the threshold itself, far less above it; whoever is reported as linked is so exactly.
    A null or empty text, or one of white space, has no shingles and is linked with nothing. Rows without an id are left out; of rows that repeat an id
    the one with the smallest text counts. Other columns are ignored; an empty table gives an empty result. ids must be integers.
    """
    if not 50 <= percent <= 100 or shingle < 1:
        raise ValueError("percent must be between 50 and 100, shingle at least 1")
    docs = one_row_per_id(docs, id, text).withColumn("doc_id", F.col("doc_id").cast("long"))
    sketches = durable(docs.mapInArrow(_sketch_batches(shingle), _SKETCH), "sketches")
    same = ["sig1", "sig2", "n_shingles"]
    classes = durable(sketches.where("n_shingles > 0").groupBy(*same).agg(F.min("doc_id").alias("rep")), "classes")
    reps = sketches.join(classes.select("rep"), F.col("rep") == F.col("doc_id"), "left_semi").select("doc_id", "registers")

    bands = reps.select("doc_id", "registers").mapInArrow(
        lambda it, run=_band_batches(band_rows(percent / 100)): run(it), "band long, doc_id long")
    hubs = bands.groupBy(F.col("band").alias("of")).agg(F.min("doc_id").alias("hub"), F.count("*").alias("n")).where("n > 1").drop("n")
    members = durable(bands.join(hubs, F.col("of") == F.col("band")).where("doc_id <> hub").select("band", "doc_id", "hub"), "bands")
    asked = members.select(F.explode(F.array("hub", "doc_id")).alias("asked")).distinct()
    # the ids may be many or few: texts are always dealt by id, so that the cost is the same share at any size
    texts = docs.join(asked.hint("merge"), F.col("asked") == F.col("doc_id"), "left_semi")
    sets = durable(texts.mapInArrow(_set_batches(shingle), "doc_id long, shingles binary"), "shingles")
    links = _links(members.select(F.col("hub").alias("a"), F.col("doc_id").alias("b")).distinct(), reps, sets, percent)
    found = durable(components(links), "components")
    for resolve in (_meet_some, _meet_all):
        open_ = _open(members, found)
        if open_.isEmpty():
            break
        more = resolve(open_, reps, sets, percent)
        if not more.isEmpty():
            links = links.union(more)
            found = durable(components(links), "components")
    grouped = classes.join(found, F.col("node") == F.col("rep"), "left").select(
        *(F.col(c).alias("of_" + c) for c in same), F.coalesce("component", "rep").alias("component"))
    return (sketches.drop("registers").join(grouped, [F.col(c) == F.col("of_" + c) for c in same], "left")
            .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
            .withColumn("kept", F.expr("doc_id = component_id")))


def _open(members: DataFrame, found: DataFrame) -> DataFrame:
    """Members of bands with several components, with their label, the label of the band's largest component (main) and its size."""
    labelled = members.join(found, F.col("node") == F.col("doc_id"), "left").select("band", "doc_id", F.coalesce("component", "doc_id").alias("label"))
    sizes = labelled.groupBy("band", "label").agg(F.count("*").alias("n"))
    open_ = sizes.groupBy("band").agg(F.max(F.struct("n", "label")).alias("main"), F.count("*").alias("labels")).where("labels > 1")
    open_ = open_.select(F.col("band").alias("of"), F.col("main.label").alias("main"))
    return durable(labelled.join(open_, F.col("of") == F.col("band")).drop("of"), "open")


def _pairs(x: str, y: str):
    return F.least(x, y).alias("a"), F.greatest(x, y).alias("b")


def _meet_some(open_: DataFrame, reps: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links of members outside their band's largest component with four members of that."""
    draws = [F.xxhash64("doc_id", F.lit(i)) for i in (0, 1)]
    chosen = F.array(*(f("doc_id", d) for d in draws for f in (F.min_by, F.max_by)))
    of_main = open_.where("label = main").groupBy(F.col("band").alias("of")).agg(chosen.alias("of_main"))
    outside = open_.where("label <> main").join(of_main, F.col("of") == F.col("band"))
    return _links(outside.select("doc_id", F.explode("of_main").alias("x")).select(*_pairs("doc_id", "x")).distinct(), reps, sets, percent)


def _meet_all(open_: DataFrame, reps: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links of members outside a component with all that share a band with some of it, compared in blocks of 512 by 512.

    Only links come out, one for each member and component it is linked with. A block is a matrix product of who has which shingle.
    """
    every = durable(open_.select("main", "doc_id", "label").distinct(), "undecided")
    sizes = every.groupBy(F.col("main").alias("of")).agg(F.ceil(F.count_if(F.expr("label <> main")) / BLOCK).alias("rows"), F.ceil(F.count("*") / BLOCK).alias("columns"))
    placed = every.join(sizes, F.col("of") == F.col("main"))
    split = lambda n: F.expr(f"pmod(xxhash64(doc_id), {n})")
    fill = lambda n: F.explode(F.expr(f"sequence(0L, {n} - 1)"))
    left = placed.where("label <> main").select("main", "doc_id", "label", F.lit(True).alias("is_row"), split("rows").alias("i"), fill("columns").alias("j"))
    right = placed.where("rows > 0").select("main", "doc_id", "label", F.lit(False).alias("is_row"), fill("rows").alias("i"), split("columns").alias("j"))
    full = left.union(right).join(sets.withColumnRenamed("doc_id", "of"), F.col("of") == F.col("doc_id")).drop("of")
    return durable(full.groupBy("main", "i", "j").applyInArrow(_block(percent), "a long, b long"), "links")


def _block(percent: int):
    def run(table: pa.Table) -> pa.Table:
        is_row = table["is_row"].to_numpy()
        docs, labels = table["doc_id"].to_numpy(), table["label"].to_numpy()
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in table["shingles"]]
        n = np.array([len(x) for x in sets], np.int64)
        sides = [np.flatnonzero(is_row), np.flatnonzero(~is_row)]
        flat = [np.concatenate([sets[k] for k in side] or [np.zeros(0, np.uint64)]) for side in sides]
        common = np.intersect1d(*flat)
        both = np.zeros((len(sides[0]), len(sides[1])))
        places = []
        for side, values in zip(sides, flat, strict=True):
            at = np.searchsorted(common, values)
            hit = (at < len(common)) & (common[np.minimum(at, max(len(common) - 1, 0))] == values) if len(common) else np.zeros(len(values), bool)
            order = np.argsort(at[hit], kind="stable")
            places.append((at[hit][order], np.repeat(np.arange(len(side)), n[side])[hit][order]))
        for lo in range(0, len(common), 4096):  # columns of the two matrices, some at a time
            parts = []
            for side, (at, who) in zip(sides, places, strict=True):
                x, y = np.searchsorted(at, [lo, lo + 4096])
                m = np.zeros((len(side), min(4096, len(common) - lo)), np.float32)
                m[who[x:y], at[x:y] - lo] = 1
                parts.append(m)
            both += parts[0] @ parts[1].T
        rows, columns = sides
        linked = (both * (100 + percent) >= percent * (n[rows][:, None] + n[columns][None, :]) - 1e-6) & (labels[rows][:, None] != labels[columns][None, :])
        r, c = np.nonzero(linked)
        _, first = np.unique(np.stack([r, labels[columns][c]]), axis=1, return_index=True)  # one link to each component
        a, b = docs[rows][r[first]], docs[columns][c[first]]
        return pa.table({"a": pa.array(np.minimum(a, b), pa.int64()), "b": pa.array(np.maximum(a, b), pa.int64())})
    return run
