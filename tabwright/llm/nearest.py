"""Approximate nearest neighbours by multiprobe p-stable hashing.

A table hashes a vector to the cells of a few random projections, floor((a.v + b) / w). For the largest inner product, vectors get one more
component that makes them all equally long, and queries are scaled to that length, so that the nearest by distance is the one with the largest
product. A query visits its own bucket in every table and then buckets whose cells differ by one, in the order of their estimated success: the
squared distances to the borders that are crossed, smallest sum first. The candidates of all tables are ranked by the product itself.

How many buckets to visit is measured: a bounded sample of the queries is searched by brute force over all rows, and the least number on a
ladder of doublings that finds `recall` of its neighbours is taken; if even the last step does not, all buckets are visited.

On Spark, equal vectors are searched once. Rows of a table travel by their first cells to groups; a group is a block of rows and a block of
queries, both of bounded size, and groups that are too large for one block are split on both sides. A block returns its best per query, so a
query's results merge from as many short lists as it visits blocks.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass, replace
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.llm.bytesvec import mix
from tabwright.llm.documents import quoted
from tabwright.operators.lookup import left_lookup
from tabwright.sources.local import small_table
from tabwright.sources.shared import durable, temporary

TABLES = 8
CELL_WIDTH = 2.0  # in standard deviations of a projection
SAMPLE_QUERIES = 200  # distinct queries searched by brute force for the fit
SAMPLE_ROWS = 20_000  # about so many rows tell the spread of the projections
LADDER = [8, 16, 32, 64, 128, 256, 512, 1024]
RECALL = 0.95
BLOCK_ROWS = 4_096
SLICES = 1_024  # slices of a group of equal vectors while their ids are gathered


@dataclass(frozen=True)
class Index:
    """Projections, offsets and cell widths of all tables, how many cells name a group, the common length of vectors, and how many buckets a query visits."""

    axes: np.ndarray  # tables x dimensions + 1 x cells
    offsets: np.ndarray  # tables x cells
    width: float
    coarse: int
    length: float
    probes: int | None = None  # None: all buckets

    def place(self, x: np.ndarray, query: bool) -> tuple[np.ndarray, np.ndarray]:
        """Cells (tables x rows x cells), and where in its cell a vector lies (0 to 1)."""
        norm = np.sqrt((x * x).sum(1))
        if query:
            more, x = np.zeros(len(x)), x * (self.length / norm)[:, None]
        else:
            more = np.sqrt(np.maximum(self.length ** 2 - norm ** 2, 0))
        at = (np.einsum("nd,tdc->tnc", np.column_stack([x, more]), self.axes) + self.offsets[:, None, :]) / self.width
        cells = np.floor(at)
        return cells.astype(np.int64), at - cells


def _code(cells: np.ndarray) -> np.ndarray:
    """One number per row of cells; if two rows share one by chance, their buckets are visited together."""
    out = np.full(cells.shape[:-1], 0x9E3779B97F4A7C15, np.uint64)
    for j in range(cells.shape[-1]):
        out = mix(out + cells[..., j].astype(np.uint64))
    return out.view(np.int64)


def crossings(cells: int, most: int) -> np.ndarray:
    """Up to `most` sets of borders to cross (rows of flags over the 2 * cells borders, nearest first) by their expected success, none first.

    The borders of a random query lie at expected squared distances; sets that cross both sides of a cell are left out.
    """
    j = np.arange(1, cells + 1)
    near = j * (j + 1) / (4 * (cells + 1) * (cells + 2))
    i = 2 * cells + 1 - np.arange(cells + 1, 2 * cells + 1)
    far = 1 - i / (cells + 1) + i * (i + 1) / (4 * (cells + 1) * (cells + 2))
    cost = np.concatenate([near, far])
    out, heap = [np.zeros(2 * cells, bool)], [(cost[0], (0,))]
    while heap and len(out) < most:
        price, chosen = heapq.heappop(heap)
        if all(2 * cells - 1 - c not in chosen for c in chosen):
            flags = np.zeros(2 * cells, bool)
            flags[list(chosen)] = True
            out.append(flags)
        last = chosen[-1]
        if last + 1 < 2 * cells:
            heapq.heappush(heap, (price + cost[last + 1], (*chosen, last + 1)))
            heapq.heappush(heap, (price - cost[last] + cost[last + 1], (*chosen[:-1], last + 1)))
    return np.array(out)


def probe_cells(cells: np.ndarray, inside: np.ndarray, sets: np.ndarray, probes: int) -> np.ndarray:
    """For the rows of one table, the cells of the `probes` likeliest buckets of `sets` (rows x probes x cells), by the row's own distances."""
    n, m = cells.shape
    borders = np.concatenate([inside ** 2, (1 - inside) ** 2], 1)  # below, above
    order = np.argsort(borders, 1, kind="stable")
    ranked = np.take_along_axis(borders, order, 1)
    best = np.argsort(ranked @ sets.T, 1, kind="stable")[:, :probes]
    step = np.where(order < m, -1, 1)
    moves = np.zeros((n, best.shape[1], m), np.int64)
    chosen = sets[best]  # rows x probes x borders
    for b in range(2 * m):
        np.add.at(moves, (np.arange(n)[:, None], np.arange(best.shape[1])[None, :], (order[:, b] % m)[:, None]), chosen[:, :, b] * step[:, b][:, None])
    return cells[:, None, :] + moves


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors stored as bytes of doubles."""
    rows = column.cast(pa.large_binary()) if len(column) else column
    return np.frombuffer(b"".join(rows.to_pylist()), np.float64).reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _read_batches(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys, vectors = [], [], []
            for id, x in zip(batch.column(0).to_pylist(), batch.column(1)):
                if id is None or not x.is_valid or len(x) != size or x.values.null_count:
                    continue
                v = x.values.to_numpy(zero_copy_only=False).astype(np.float64) + 0.0  # no negative zero
                if np.isfinite(v).all() and v.any():
                    ids.append(id)
                    vectors.append(v.tobytes())
                    keys.append(blake2b(vectors[-1], digest_size=16).digest())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(keys, pa.binary()), pa.array(vectors, pa.binary())], names=["id", "key", "vector"])
    return run


def _usable(vectors: DataFrame, id: str, vector: str) -> DataFrame:
    """id, key (a digest of the vector) and vector, one row per id."""
    rows = vectors.select(quoted(id).cast("long").alias("id"), quoted(vector).alias("v")).where("id is not null and v is not null")
    lengths = rows.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), "size").first()
    size = lengths["size"] if lengths else 0
    if not rows.groupBy("id").count().where("count > 1").isEmpty():
        rows = rows.groupBy("id").agg(F.min("v").alias("v"))
    return durable(rows.mapInArrow(_read_batches(size), "id long, key binary, vector binary"), "vectors")


def _distinct(rows: DataFrame, every: int, keep: int) -> DataFrame:
    """One row per different vector: its `keep` smallest ids (no more can be among a query's nearest), and how many of its ids are queries."""
    least = lambda c: F.slice(F.sort_array(c), 1, keep)
    parts = rows.groupBy("key", F.pmod("id", F.lit(SLICES)).alias("slice")).agg(
        F.first("vector").alias("vector"), least(F.collect_list("id")).alias("ids"), F.count_if(F.pmod("id", F.lit(every)) == 0).alias("queries"))
    return durable(parts.groupBy("key").agg(F.first("vector").alias("vector"), least(F.flatten(F.collect_list("ids"))).alias("ids"), F.sum("queries").alias("queries")), "distinct")


def _best(scores: np.ndarray, most: int) -> np.ndarray:
    """Places of the `most` highest, and of all that rounding could put among them."""
    if len(scores) <= most:
        return np.arange(len(scores))
    cut = np.partition(scores, len(scores) - most)[len(scores) - most]
    return np.flatnonzero(scores >= cut - 1e-9 * max(1.0, abs(cut)))


def _exact(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products whose rounding does not depend on which rows are computed together."""
    return (x * q).sum(1)


def _brute_batches(sample: np.ndarray, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(np.zeros(0), np.zeros((0, sample.shape[1])))] * len(sample)
        for batch in batches:
            x = _matrix(batch.column(0))
            if not len(x):
                continue
            for i, scores in enumerate(sample @ x.T):
                at = _best(scores, most)
                s, v = np.concatenate([held[i][0], scores[at]]), np.concatenate([held[i][1], x[at]])
                at = np.argsort(-s, kind="stable")[:most]
                held[i] = (s[at], v[at])
        at = np.repeat(np.arange(len(sample)), [len(h[0]) for h in held])
        if len(at):
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(np.concatenate([h[0] for h in held])), pa.array([v.tobytes() for h in held for v in h[1]], pa.binary())], names=["query", "score", "vector"])
    return run


def fit(distinct: DataFrame, most: int, recall: float = RECALL, tables: int = TABLES, seed: int = 11) -> tuple[Index | None, float]:
    """The index for a table of different vectors, and the recall measured on the sample; None for an empty table.

    The number of cells per table grows with the logarithm of the rows, so that buckets stay small; the number of probes is then measured.
    """
    facts = distinct.agg(F.count("*").alias("n"), F.max(F.octet_length("vector")).alias("bytes")).first()
    n = facts["n"]
    if not n:
        return None, 1.0
    draw = lambda rows, share: rows.where(F.pmod(F.xxhash64("key", F.lit(seed)), F.lit(1 << 20)) < math.ceil(min(1.0, share) * (1 << 20)))
    spread = _matrix(draw(distinct, SAMPLE_ROWS / n).orderBy("key").limit(SAMPLE_ROWS).select("vector").toArrow()["vector"].combine_chunks())
    length = distinct.mapInArrow(_longest, "length double").agg(F.max("length")).first()[0]
    dims = facts["bytes"] // 8
    cells = min(dims + 1, max(4, round(math.log2(max(n, 2)) / 1.7)))
    rng = np.random.default_rng(seed)
    axes = np.stack([np.linalg.qr(rng.normal(size=(dims + 1, dims + 1)))[0][:, :cells] for _ in range(tables)])
    more = np.sqrt(np.maximum(length ** 2 - (spread ** 2).sum(1), 0)) if len(spread) else np.zeros(0)
    deviation = float(np.einsum("nd,tdc->tnc", np.column_stack([spread, more]), axes).std(1).mean()) if len(spread) > 1 else length
    width = CELL_WIDTH * (deviation or length)
    coarse = min(cells, max(0, math.floor(math.log2(max(n / BLOCK_ROWS, 1)) / 1.5)))
    index = Index(axes, rng.uniform(0, width, (tables, cells)), width, coarse, length)
    queries = distinct.where("queries > 0")
    share = SAMPLE_QUERIES / max(queries.count(), 1)
    sample = _matrix(draw(queries, 2 * share).orderBy(F.xxhash64("key", F.lit(seed + 1))).limit(SAMPLE_QUERIES).select("vector").toArrow()["vector"].combine_chunks())
    if not len(sample):
        return index, 1.0
    found = distinct.select("vector").mapInArrow(_brute_batches(sample, most), "query long, score double, vector binary")
    near = F.slice(F.sort_array(F.collect_list(F.struct("score", "vector")), False), 1, most)
    pairs = found.groupBy("query").agg(near.alias("near")).select("query", F.explode("near.vector").alias("vector")).toArrow()  # `most` rows per sampled query
    first = _first_visit(index, sample, pairs["query"].to_numpy(), _matrix(pairs["vector"].combine_chunks()))
    for probes in LADDER:
        share = float((first < probes).mean())
        if share >= recall:
            return replace(index, probes=probes), share
    return index, 1.0


def _longest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = _matrix(batch.column(batch.schema.get_field_index("vector")))
        if len(x):
            yield pa.RecordBatch.from_arrays([pa.array([float(np.sqrt((x * x).sum(1)).max())])], names=["length"])


def _first_visit(index: Index, queries: np.ndarray, of: np.ndarray, near: np.ndarray) -> np.ndarray:
    """For pairs of a query and a vector, the least number of probes over the tables that visits the vector's bucket (beyond the ladder: its end)."""
    sets = crossings(index.axes.shape[2], 2 * LADDER[-1])
    cells, inside = index.place(queries, True)
    theirs, _ = index.place(near, False)
    out = np.full(len(of), LADDER[-1])
    for t in range(len(cells)):
        for q in np.unique(of):
            at = np.flatnonzero(of == q)
            visited = _code(probe_cells(cells[t][q:q + 1], inside[t][q:q + 1], sets, LADDER[-1])[0])
            hits = _code(theirs[t][at])[:, None] == visited[None, :]
            out[at] = np.minimum(out[at], np.where(hits.any(1), hits.argmax(1), LADDER[-1]))
    return out


def _entry_batches(index: Index):
    """Rows of every table: its number, group, bucket, and the vector with its ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(0))
            if not len(x):
                continue
            cells, _ = index.place(x, False)
            for t, c in enumerate(cells):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), t, np.int32)), pa.array(_code(c[:, :index.coarse])), pa.array(_code(c)), batch.column(0), batch.column(1)], names=["t", "g", "bucket", "vector", "ids"])
    return run


def _query_batches(index: Index):
    """Rows of every table and group that a query visits: the query and its buckets there, in the order of their success."""
    sets = crossings(index.axes.shape[2], 2 * index.probes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                x = _matrix(part.column(1))
                cells, inside = index.place(x, True)
                for t in range(len(cells)):
                    probes = probe_cells(cells[t], inside[t], sets, index.probes)
                    group, bucket = _code(probes[:, :, :index.coarse]), _code(probes)
                    row, g, buckets = [], [], []
                    for i in range(len(x)):
                        order = np.argsort(group[i], kind="stable")
                        cuts = np.flatnonzero(np.diff(group[i][order])) + 1
                        for some in np.split(order, cuts):
                            row.append(i)
                            g.append(group[i][some[0]])
                            buckets.append(bucket[i][some].tobytes())
                    yield pa.RecordBatch.from_arrays([pa.array([t] * len(row), pa.int32()), pa.array(g, pa.int64()), part.column(0).take(pa.array(row)), part.column(1).take(pa.array(row)), pa.array(buckets, pa.binary())],
                                                     names=["t", "g", "query", "vector", "buckets"])
    return run


def _meet(most: int):
    """The best rows of a block for each query of a block: those in the buckets the query visits (null: all)."""
    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        bucket = rows["bucket"].to_numpy()
        order = np.argsort(bucket, kind="stable")
        x = _matrix(rows["vector"].combine_chunks())[order]
        ids = rows["ids"].combine_chunks().take(pa.array(order)).to_pylist()
        codes, starts = np.unique(bucket[order], return_index=True)
        ends = np.append(starts[1:], len(order))
        sought = _matrix(queries["vector"].combine_chunks())
        out, lists = [], []
        for i, visited in enumerate(queries["buckets"].to_pylist() if len(x) else []):
            if visited is None:
                at = np.arange(len(x))
            else:
                visited = np.frombuffer(visited, np.int64)
                slot = np.searchsorted(codes, visited)
                slot = slot[(slot < len(codes)) & (codes[np.minimum(slot, len(codes) - 1)] == visited)]
                at = np.concatenate([np.arange(starts[s], ends[s]) for s in slot]) if len(slot) else np.zeros(0, np.int64)
            if not len(at):
                continue
            at = at[_best(x[at] @ sought[i], most)]
            scores = _exact(x[at], sought[i])
            found = sorted((-s, v) for s, k in zip(scores.tolist(), at) for v in ids[k])[:most]
            out.append(i)
            lists.append([{"down": s, "id": v} for s, v in found])
        return pa.table({"query": queries["query"].combine_chunks().take(pa.array(out, pa.int64())), "found": pa.array(lists, pa.list_(pa.struct([("down", pa.float64()), ("id", pa.int64())])))})
    return run


def _blocks(entries: DataFrame, probes: DataFrame, n: int) -> DataFrame:
    """How many slices the rows and the queries of a group need, for groups that need more than one.

    A block holds BLOCK_ROWS, or one row in 65,536 if that is more; a table has at most 65,536 groups that exceed it on either side.
    """
    size = max(BLOCK_ROWS, n // 65_536)
    counts = entries.select("t", "g", F.lit(1).alias("r"), F.lit(0).alias("q")).unionAll(probes.select("t", "g", F.lit(0), F.lit(1)))
    counts = counts.groupBy("t", "g").agg(F.ceil(F.sum("r") / size).cast("int").alias("rows"), F.ceil(F.sum("q") / size).cast("int").alias("queries"))
    return counts.where("rows > 1 or queries > 1").select("t", "g", F.greatest("rows", F.lit(1)).alias("_rows"), F.greatest("queries", F.lit(1)).alias("_queries"))


def _sliced(side: DataFrame, blocks: DataFrame, own: str, other: str, by: str, columns: list[str]) -> DataFrame:
    """A side of the meeting with its slice of the group, once for every slice of the other side."""
    wide = side.join(F.broadcast(blocks), ["t", "g"], "left")
    mine = F.pmod(F.xxhash64(by), F.coalesce(F.col(own), F.lit(1))).cast("int")
    theirs = F.explode(F.sequence(F.lit(0), F.coalesce(F.col(other), F.lit(1)) - 1))
    first, second = (mine.alias("i"), theirs.alias("j")) if own == "_rows" else (theirs.alias("i"), mine.alias("j"))
    return wide.select("t", "g", first, second, *columns)


def search(vectors: DataFrame, every: int = 20, most: int = 20, recall: float = RECALL, tables: int = TABLES, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: for every row whose id is divisible by `every`, the `most` rows with the largest inner product that are found, itself left out.

    Nearest first, ties to the smaller id; all rows if there are fewer. Scores are inner products of the original vectors in double precision.
    Rows without an id, and vectors that are null, all zero, of another length than the most common one, or that hold a null, NaN or infinite
    component take no part. Of rows that repeat an id the smallest vector counts. An empty table gives an empty result. Other columns are not looked at.
    """
    if min(every, most, tables) < 1:
        raise ValueError(f"every, most and tables must be 1 or more: {every}, {most}, {tables}")
    with temporary(vectors.sparkSession) as keep:
        rows = _usable(vectors, id, vector)
        distinct = _distinct(rows, every, most + 1)
        index, _ = fit(distinct, most + 1, recall, tables)
        kinds = "query_id long, rank int, vec_id long, score double"
        if index is None:
            return small_table(vectors.sparkSession, [], kinds)
        if index.probes is None:  # every bucket of one table
            index = replace(index, axes=index.axes[:1], offsets=index.offsets[:1], coarse=0)
        ids = "array<bigint>"
        entries = distinct.select("vector", "ids").mapInArrow(_entry_batches(index), f"t int, g bigint, bucket bigint, vector binary, ids {ids}")
        sought = distinct.where("queries > 0").select(F.col("key").alias("query"), "vector")
        if index.probes is None:
            g = F.lit(int(_code(np.zeros((1, 0), np.int64))[0]))
            probes = sought.select(F.lit(0).alias("t"), g.alias("g"), "query", "vector", F.lit(None).cast("binary").alias("buckets"))
        else:
            probes = sought.mapInArrow(_query_batches(index), "t int, g bigint, query binary, vector binary, buckets binary")
        n, n_queries = distinct.count(), rows.where(F.pmod("id", F.lit(every)) == 0).count()
        blocks = durable(_blocks(entries, probes, n), "blocks")
        left = _sliced(entries, blocks, "_rows", "_queries", "vector", ["bucket", "vector", "ids"])
        right = _sliced(probes, blocks, "_queries", "_rows", "query", ["query", "vector", "buckets"])
        keys = ["t", "g", "i", "j"]
        met = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_meet(most + 1), "query binary, found array<struct<down:double,id:bigint>>")
        # a row found in several tables has one score, so after sorting its copies are neighbours
        once = F.transform(F.array(F.sort_array(F.flatten(F.collect_list("found")))), lambda s: F.filter(s, lambda x, i: (i == 0) | (x != F.get(s, i - 1))))
        merged = F.slice(once[0], 1, most + 1)
        lists = durable(met.groupBy("query").agg(merged.alias("found")), "found")
        table = lists.join(distinct.select(F.col("key").alias("query"), F.col("queries").alias("w")), "query")
        asked = rows.where(F.pmod("id", F.lit(every)) == 0).select("id", F.col("key").alias("query"))
        answered = left_lookup(asked, table, "query", "found", "w", lists.count(), n_queries)
        others = F.slice(F.filter("found", lambda x: x["id"] != F.col("id")), 1, most)
        out = answered.select(F.col("id").alias("query_id"), F.posexplode(others).alias("at", "x"))
        return keep(out.select("query_id", (F.col("at") + 1).alias("rank"), F.col("x.id").alias("vec_id"), (-F.col("x.down")).alias("score")), "nearest")
