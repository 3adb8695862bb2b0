"""Exact k nearest neighbours between two tables.

Training rows are grouped around a few pivot rows. By the triangle inequality a query can rule out every
group that is farther than k rows already known to be close, and only meets the groups that remain. Groups are
cut into blocks of bounded size on both sides; a block pair returns k rows per query, never all pairs.

Where the groups rule out little and a table is searched for its own rows, a distance serves both rows of a pair, blocks of one
group never meet, and a limit from rows drawn by hash leaves few pairs to be measured.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window, functions as F

from tabwright.functions.exprs import col, row_hash
from tabwright.sources.local import small_table
from tabwright.sources.shared import durable

MAX_PIVOTS = 256
BLOCK_CELLS = 1_000_000   # numbers in one side of a block
BLOCK_ROWS = 16_000
GROUP_ROWS = 4_000        # training rows per pivot, on average
STRIP_CELLS = 1_000_000   # distances held at a time
TILE = 2_048              # training rows of a strip that are added up together
USELESS = 0.5             # share of all visits from which groups are not worth their copies
DIGITS = 9                # distances equal to this many digits count as ties, decided by row key
TIE = 2 * 10.0 ** -DIGITS
MUTUAL_CELLS = 2_000_000  # numbers in one side of a block when both sides are queries
MUTUAL_ROWS = 1_000       # rows of such a block that are worth a meeting of their own
MUTUAL_STRIP = 128        # rows that are compared with a tile of the other side at a time
LIMIT_ROWS = 8_192        # training rows, drawn by hash, that limit how far the nearest of a row can be
EARLY = 2                 # blocks on either side that a block of a long table meets first
TRIED_ROWS = 2_000        # rows on which groups are tried before all rows are grouped
SEPARATE = 64             # so many groups have blocks of their own


def _distances(a: np.ndarray, b: np.ndarray, p: int) -> np.ndarray:
    """All distances between the rows of two bounded blocks."""
    out = np.empty((len(a), len(b)))
    step = max(1, 2_000_000 // max(b.size, 1))
    for at in range(0, len(a), step):
        gap = np.abs(a[at:at + step, None, :] - b[None, :, :])
        out[at:at + step] = gap.sum(axis=2) if p == 1 else np.sqrt((gap * gap).sum(axis=2))
    return out


def _rough_short(a: np.ndarray, b_t: np.ndarray) -> np.ndarray:
    """As `_rough_manhattan` for 7-bit codes: two features fit one byte, and bytes are added up in pairs as the halves of 16-bit words."""
    odd_d, odd_n = len(b_t) % 2, b_t.shape[1] % 2
    if odd_d or odd_n:
        a, b_t = np.pad(a, ((0, 0), (0, odd_d))), np.pad(b_t, ((0, odd_d), (0, odd_n)))
    shape = len(a), b_t.shape[1]
    larger, second = np.empty(shape, np.uint8), np.empty(shape, np.uint8)
    words = larger.view("<u2")
    sums, upper = np.zeros(words.shape, np.uint16), np.zeros(words.shape, np.uint16)
    columns = np.ascontiguousarray(a.T)
    for f in range(0, len(b_t), 2):
        np.maximum(columns[f][:, None], b_t[f][None, :], out=larger)
        np.maximum(columns[f + 1][:, None], b_t[f + 1][None, :], out=second)
        larger += second
        sums += words
        np.right_shift(words, 8, out=words)
        upper += words
    sums -= upper << 8
    out = np.empty(shape, np.uint16)
    out[:, ::2], out[:, 1::2] = sums, upper
    out *= np.uint16(2)
    out -= a.sum(axis=1, dtype=np.uint16)[:, None]
    out -= b_t.sum(axis=0, dtype=np.uint16)[None, :]
    return out[:, :shape[1] - odd_n]


def _rough_manhattan(a: np.ndarray, b_t: np.ndarray) -> np.ndarray:
    """Sums of |x - y| as twice the larger less both, a feature at a time over tiles that stay in the cache. Whole numbers may wrap on the way."""
    if a.dtype == np.uint8:
        return _rough_short(a, b_t)
    out = np.empty((len(a), b_t.shape[1]), a.dtype)
    for at in range(0, b_t.shape[1], TILE):
        side = b_t[:, at:at + TILE]
        sums, larger = np.zeros((len(a), side.shape[1]), a.dtype), np.empty((len(a), side.shape[1]), a.dtype)
        for x, y in zip(a.T, side, strict=True):
            sums += np.maximum(x[:, None], y[None, :], out=larger)
        sums *= a.dtype.type(2)
        sums -= a.sum(axis=1, dtype=a.dtype)[:, None]
        sums -= side.sum(axis=0, dtype=a.dtype)[None, :]
        out[:, at:at + TILE] = sums
    return out


def _manhattan_kinds(t_t: np.ndarray, q: np.ndarray, plain: bool, short: bool = False):
    """Both sides in growing precision, with the size of a unit and the margin, in units, by which a rough distance may be off.

    16-bit codes come first: a code is off by half a step at most, and sums over all features fit. With `short`, 7-bit codes come before
    them; the margin is what the codes are off by, added up over a row.
    """
    d = len(t_t)
    ends = [f(x) for f, x in ((np.min, t_t), (np.max, t_t), (np.min, q), (np.max, q)) if x.size]
    brief = (max(ends) - min(ends)) / 127 if short and plain and ends and d <= 256 else 0.0
    if brief > 0 and np.isfinite(brief):
        exact = [(x - min(ends)) / brief for x in (t_t, q)]
        codes = [np.rint(x) for x in exact]
        off = [np.abs(x - y).sum(axis=axis).max(initial=0.0) for x, y, axis in zip(exact, codes, (0, 1))]
        yield codes[0].astype(np.uint8), codes[1].astype(np.uint8), brief, sum(off) * (1 + 1e-6) + 0.01
        del exact, codes
    step = (max(ends) - min(ends)) / (65_534 // max(d, 1)) if plain and ends and d <= 1_024 else 0.0
    if step > 0 and np.isfinite(step):
        code = lambda x: np.rint((x - min(ends)) / step).astype(np.uint16)
        yield code(t_t), code(q), step, d * (1 + 1e-6) + 1
    scale = np.abs(q).sum(axis=1).max(initial=0.0) + np.abs(t_t).sum(axis=0).max(initial=0.0)
    for dtype in (np.float32, np.float64) if plain else (np.float64,):
        yield t_t.astype(dtype), q.astype(dtype), 1.0, 4.0 * (d + 4) * float(np.finfo(dtype).eps) * float(scale)


def _rough_squares(a: np.ndarray, b_t: np.ndarray) -> tuple[np.ndarray, float]:
    """Squared distances by a matrix product; off by at most the margin."""
    aa, bb = (a * a).sum(axis=1), (b_t * b_t).sum(axis=0)
    out = a @ b_t
    out *= -2.0
    out += aa[:, None]
    out += bb[None, :]
    return out, 1e-12 * float(aa.max(initial=0.0) + bb.max(initial=0.0)) * max(a.shape[1], 1) / 16


def _kth_or_above(rough: np.ndarray, k: int) -> np.ndarray:
    """For each row a number that at least k of its cells do not exceed: the k-th least of the minima of many groups of cells."""
    n = rough.shape[1]
    if n <= k:
        return np.full(len(rough), np.inf)
    groups = 16 * k
    if n >= 4 * groups:
        whole = n // groups * groups
        rough = rough[:, :whole].reshape(len(rough), -1, groups).min(axis=1)
    return np.partition(rough, k - 1, axis=1)[:, k - 1].astype(float)


def _matrix(values: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=float) for v in values]) if len(values) else np.empty((0, 0))


def _near(q: np.ndarray, t_t: np.ndarray, k: int, p: int, same: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, training row) among which are the k nearest of every query; `same` marks pairs that do not count."""
    plain = max(np.abs(t_t).max(initial=0.0), np.abs(q).max(initial=0.0)) < 1e30
    for side, some, unit, margin in _manhattan_kinds(t_t, q, plain) if p == 1 else [(t_t, q, 1.0, 0.0)]:
        if p == 1:
            rough = _rough_manhattan(some, side)
        else:
            rough, margin = _rough_squares(some, side)
        codes = rough.dtype == np.uint16
        if same is not None:
            rough[same] = 65_535 if codes else np.inf
        kth = _kth_or_above(rough, k)
        limit = kth + 2 * margin + TIE / unit if p == 1 else (np.sqrt(np.maximum(kth, 0.0) + margin) + TIE) ** 2 + margin
        if codes:
            limit = np.minimum(limit, 65_535).astype(np.uint16)
        elif rough.dtype == np.float32:
            limit = np.nextafter(limit.astype(np.float32), np.float32(np.inf))
        i, j = np.nonzero(rough <= limit[:, None])
        if rough.dtype == np.float64 or len(i) <= 32 * k * len(q):
            break
    return (i, j) if same is None else (i[~same[i, j]], j[~same[i, j]])


def nearest_rows(t_keys: np.ndarray, t: np.ndarray, q: np.ndarray, k: int, p: int,
                 t_group: np.ndarray | None = None, q_group: np.ndarray | None = None):
    """For stretches of query rows of a block: positions of queries and of their k nearest training rows, and the distances.

    Rough distances of a few queries at a time leave few pairs, which are measured exactly; rough ones that leave too many are repeated in
    a higher precision. Memory depends on STRIP_CELLS, not on the rows of the blocks.
    """
    # rows that are not finite are near to none
    t_at, q_at = (np.flatnonzero(np.isfinite(x).all(axis=1)) if x.size else np.arange(0) for x in (t, q))
    middle = t[t_at].mean(axis=0) if len(t_at) else 0.0   # distances do not depend on it, rounding does
    t_t = np.ascontiguousarray((t[t_at] - middle).T)
    step = max(1, STRIP_CELLS // max(len(t_at), 1))
    few = max(1, STRIP_CELLS // max(t.shape[1], 1))
    for at in range(0, len(q_at) if len(t_at) else 0, step):
        here = q_at[at:at + step]
        same = q_group[here][:, None] == t_group[t_at][None, :] if t_group is not None else None
        i, j = _near(q[here] - middle, t_t, k, p, same)
        i, j = here[i], t_at[j]
        exact = np.empty(len(i))
        for lot in range(0, len(i), few):
            gap = np.abs(q[i[lot:lot + few]] - t[j[lot:lot + few]])
            exact[lot:lot + few] = gap.sum(axis=1) if p == 1 else np.sqrt((gap * gap).sum(axis=1))
        order = np.lexsort((t_keys[j], np.round(exact, DIGITS), i))
        i, j, exact = i[order], j[order], exact[order]
        first = np.arange(len(i)) - np.searchsorted(i, i) < k
        yield i[first], j[first], exact[first]


def _limits(rows: np.ndarray, groups: np.ndarray, drawn: np.ndarray, drawn_groups: np.ndarray, k: int, p: int, by_group: bool) -> np.ndarray:
    """For each row a distance within which at least k of the drawn training rows of other groups lie; infinite if they are fewer."""
    out = np.full(len(rows), np.inf)
    at = np.flatnonzero(np.isfinite(rows).all(axis=1)) if rows.size else np.arange(0)
    if not len(at) or not len(drawn):
        return out
    middle = drawn.mean(axis=0)
    q, t_t = rows[at] - middle, np.ascontiguousarray((drawn - middle).T)
    if p == 1:
        side, some, unit, margin = next(_manhattan_kinds(t_t, q, max(np.abs(t_t).max(), np.abs(q).max()) < 1e30))
    step = max(1, STRIP_CELLS // len(drawn))
    for lot in range(0, len(at), step):
        here = slice(lot, lot + step)
        if p == 1:
            rough = _rough_manhattan(some[here], side)
        else:
            rough, margin = _rough_squares(q[here], t_t)
        none = 65_535 if rough.dtype == np.uint16 else np.inf
        if by_group:
            rough[groups[at[here], None] == drawn_groups[None, :]] = none
        kth = _kth_or_above(rough, k)
        far = (kth + margin) * unit if p == 1 else np.sqrt(np.maximum(kth, 0.0) + margin)
        out[at[here]] = np.where(kth < none, far, np.inf)
    return out


def _mutual_screens(a: np.ndarray, b: np.ndarray, p: int):
    """Tests in growing precision: which pairs of a stretch of `a` and one of `b` may be as near as the limit of either row."""
    middle = np.median(b, axis=0)   # not drawn away by a few rows, which would cost all others digits
    if p == 1:
        a, b_t = a - middle, np.ascontiguousarray((b - middle).T)

        def manhattan(side, some, unit, margin):
            def units(far):
                limit = (far + TIE) / unit + margin
                if some.dtype in (np.uint8, np.uint16):
                    return np.minimum(limit, 65_535).astype(np.uint16)
                return np.nextafter(limit.astype(some.dtype), some.dtype.type(np.inf))

            return lambda i, j, x, y: _rough_manhattan(some[i], side[:, j]) <= np.maximum(units(x)[:, None], units(y)[None, :])

        for kind in _manhattan_kinds(b_t, a, max(np.abs(a).max(initial=0.0), np.abs(b_t).max(initial=0.0)) < 1e30, short=True):
            yield manhattan(*kind)
        return
    a, b = a - middle, b - middle
    size = max(np.abs(a).max(initial=0.0), np.abs(b).max(initial=0.0)) or 1.0
    a, b = a / size, b / size
    aa, bb = (a * a).sum(axis=1)[:, None], (b * b).sum(axis=1)[:, None]

    def euclidean(dtype):
        # one product gives minus half of the squared distances, and as much more as it may be off for this pair
        off = 1 - 4.0 * (a.shape[1] + 10) * float(np.finfo(dtype).eps)
        left = np.hstack([a, -0.5 * off * aa, np.ones_like(aa)]).astype(dtype)
        right = np.ascontiguousarray(np.hstack([b, np.ones_like(bb), -0.5 * off * bb]).T.astype(dtype))
        low = lambda far: np.nextafter((-0.5 * ((far + TIE) / size) ** 2 - 1e-30).astype(dtype), dtype(-np.inf))
        return lambda i, j, x, y: left[i] @ right[:, j] >= np.minimum(low(x)[:, None], low(y)[None, :])

    for dtype in (np.float32, np.float64):
        yield euclidean(dtype)


def _hits(close: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the few true cells; eight cells at a time are passed over."""
    if close.size % 8:
        return np.nonzero(close)
    eights = np.flatnonzero(close.reshape(-1).view(np.uint64))
    at, within = np.nonzero(close.reshape(-1, 8)[eights])
    return np.divmod(eights[at] * 8 + within, close.shape[1])


class _Nearest:
    """The k nearest rows of the other side for every row of one side, as far as they lie within its limit."""

    def __init__(self, far: np.ndarray, keys: np.ndarray, may: np.ndarray, k: int):
        self.far, self.keys, self.may, self.k = far.copy(), keys, may, k  # keys of the other side, and which of them are training rows
        self.lots, self.held, self.most = [], 0, max(4 * k * len(far), 100_000)

    def offer(self, i: np.ndarray, j: np.ndarray, dist: np.ndarray) -> None:
        near = self.may[j] & (dist <= self.far[i] + TIE)
        self.lots.append((i[near].astype(np.int32), j[near].astype(np.int32), dist[near]))
        self.held += len(self.lots[-1][0])
        if self.held > self.most:
            self.best()

    def best(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Also lets go of the others, and narrows the limits."""
        i, j, dist = (np.concatenate(x) for x in zip(*self.lots)) if self.lots else (np.empty(0, np.int32), np.empty(0, np.int32), np.empty(0))
        order = np.lexsort((self.keys[j], np.round(dist, DIGITS), i))
        i, j, dist = i[order], j[order], dist[order]
        rank = np.arange(len(i)) - np.searchsorted(i, i)
        last = rank == self.k - 1
        self.far[i[last]] = np.minimum(self.far[i[last]], dist[last])
        first = rank < self.k
        self.lots, self.held = [(i[first], j[first], dist[first])], int(first.sum())
        return self.lots[0]


def mutual_rows(a: dict, b: dict, k: int, p: int):
    """For two blocks, the k nearest of every row on the other side, within the rows' limits: (i, j, dist) for `a` and (j, i, dist) for `b`.

    A block has `keys`, `v`, `far` (limits), `may` (training rows), and `g` if rows of a group do not count for each other. Every distance is
    worked out once, roughly, for both rows; what may lie within one of the limits is measured exactly.
    """
    a_at, b_at = (np.flatnonzero(np.isfinite(x["v"]).all(axis=1)) if x["v"].size else np.arange(0) for x in (a, b))
    of_a, of_b = _Nearest(a["far"], b["keys"], b["may"], k), _Nearest(b["far"], a["keys"], a["may"], k)
    if len(a_at) and len(b_at):
        x, y = a["v"], b["v"]
        few = max(1, STRIP_CELLS // max(x.shape[1], 1))
        screens = _mutual_screens(x[a_at], y[b_at], p)
        screen, settled = next(screens), False
        for j_from in range(0, len(b_at), TILE):
            for i_from in range(0, len(a_at), MUTUAL_STRIP):
                i_here, j_here = slice(i_from, i_from + MUTUAL_STRIP), slice(j_from, j_from + TILE)
                x_far, y_far = of_a.far[a_at[i_here]], of_b.far[b_at[j_here]]
                i, j = _hits(screen(i_here, j_here, x_far, y_far))
                many = len(x_far) * len(y_far) // 32
                if len(i) > many and not settled:
                    tried = [(screen, i, j)]
                    while len(tried[-1][1]) > many and not settled:
                        finer = next(screens, None)
                        settled = finer is None
                        tried += [] if settled else [(finer, *_hits(finer(i_here, j_here, x_far, y_far)))]
                    # precision costs time, so it must halve what is left at least
                    screen, i, j = next(t for t in tried if len(t[1]) <= 2 * len(tried[-1][1]))
                i, j = a_at[i_from + i], b_at[j_from + j]
                if a.get("g") is not None:
                    apart = a["g"][i] != b["g"][j]
                    i, j = i[apart], j[apart]
                for lot in range(0, len(i), few):
                    m, n = i[lot:lot + few], j[lot:lot + few]
                    gap = np.abs(x[m] - y[n])
                    dist = gap.sum(axis=1) if p == 1 else np.sqrt((gap * gap).sum(axis=1))
                    of_a.offer(m, n, dist)
                    of_b.offer(n, m, dist)
    return of_a.best(), of_b.best()


def _listed(column: pa.ChunkedArray) -> np.ndarray:
    """Arrays of one length as a matrix."""
    lists = column.combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = pa.concat_arrays(lists.chunks) if lists.num_chunks else pa.array([], column.type)
    if not len(lists):
        return np.empty((0, 0))
    sizes = np.diff(lists.offsets.to_numpy())
    if lists.null_count or sizes.min() != sizes.max():
        raise ValueError("vectors differ in length")
    return lists.flatten().to_numpy(zero_copy_only=False).astype(float, copy=False).reshape(len(lists), -1)


def _mutual(points: DataFrame, kept: DataFrame, n: int, d: int, k: int, p: int, by_group: bool) -> DataFrame:
    """(query, neighbour, label, dist): for each of the n points its nearest among those marked `may`, k from every block it meets."""
    spark = points.sparkSession
    drawn = kept.orderBy(row_hash(["key"], 0), "key").limit(max(k, min(LIMIT_ROWS, BLOCK_CELLS // d))).select("v", "g").collect()
    sides, drawn_groups = _matrix(pd.Series([r["v"] for r in drawn])), np.array([np.nan if r["g"] is None else r["g"] for r in drawn], float)
    finite = np.isfinite(sides).all(axis=1)
    sides, drawn_groups = sides[finite], drawn_groups[finite]

    @F.pandas_udf("double")
    def limit(v: pd.Series, g: pd.Series) -> pd.Series:
        return pd.Series(_limits(_matrix(v), g.to_numpy(dtype=float), sides, drawn_groups, k, p, by_group), dtype=float)

    sizes = {r["g"]: r["count"] for r in points.groupBy("g").count().limit(SEPARATE + 1).collect()} if by_group else {}
    separate = by_group and len(sizes) <= SEPARATE and None not in sizes
    if not separate:
        sizes = {0: n}
    # some meetings for every core, since their work grows with the square of the rows
    full = math.ceil(n * d / MUTUAL_CELLS)
    wanted = math.ceil(math.sqrt(16 * spark.sparkContext.defaultParallelism / (1 - 1 / len(sizes) if len(sizes) > 1 else 1)))
    wanted = max(full, min(wanted, math.ceil(n / MUTUAL_ROWS)))
    counts = {g: math.ceil(m * wanted / n) for g, m in sizes.items()}
    # numbers next to each other belong to different groups
    blocks = [(i * len(sizes) + place, g) for place, (g, c) in enumerate(counts.items()) for i in range(c)]
    span = max(i for i, _ in blocks) + 1
    by_g = lambda values: F.element_at(F.create_map(*[F.lit(x) for pair in zip(sizes, values) for x in pair]), F.col("g") if separate else F.lit(0))
    dealt = durable(points.withColumn("far", limit("v", "g")).withColumn(
        "block", (F.pmod(F.xxhash64("key", "v"), by_g(counts.values())) * len(sizes) + by_g(range(len(sizes)))).cast("int")), "limits")
    lots = small_table(spark, blocks, "a int, ga int")
    gap = F.col("b") - F.col("a")
    pairs = lots.crossJoin(lots.toDF("b", "gb")).where("a < b and ga <> gb" if separate else "a <= b").select(
        "a", "b", (F.least(gap, span - gap) <= EARLY).alias("early"))
    meetings = (len(blocks) ** 2 - sum(c * c for c in counts.values())) // 2 if separate else len(blocks) * (len(blocks) + 1) // 2
    masked = by_group and not separate
    key_type = points.schema["key"].dataType.simpleString()

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["query", "neighbour", "label", "dist"]
        block = lambda t: {"keys": t["key"].to_numpy(), "v": _listed(t["v"]), "far": t["far"].to_numpy(), "may": t["may"].to_numpy(),
                           "g": t["g"].to_pandas().to_numpy(dtype=float) if masked else None}
        parts = []
        if len(left) and len(right):
            both = [(left, right), (right, left)] if left["a"][0] != left["b"][0] else [(left, right)]  # a block that meets itself answers once
            for (own, other), (i, j, dist) in zip(both, mutual_rows(block(left), block(right), k, p)):
                parts.append(pa.table([own["key"].take(pa.array(i)), other["key"].take(pa.array(j)), other["label"].take(pa.array(j)),
                                       pa.array(dist)], names=names))
        if not parts:
            return pa.table([left["key"].slice(0, 0), left["key"].slice(0, 0), left["label"].slice(0, 0), pa.array([], pa.float64())], names=names)
        return pa.concat_tables(parts)

    def met(dealt: DataFrame, pairs: DataFrame, meetings: int) -> DataFrame:
        tasks = max(1, min(4 * meetings, 10_000))  # more than meetings, so that few share a task
        side = lambda name: dealt.join(F.broadcast(pairs), F.col("block") == F.col(name)).select(
            *[F.col(c).alias(c) for c in ("a", "b", "key", "label", "v", "g", "may", "far")]).repartition(tasks, "a", "b")
        return side("a").groupBy("a", "b").cogroup(side("b").groupBy("a", "b")).applyInArrow(
            meet, f"query {key_type}, neighbour {key_type}, label int, dist double")

    if full <= 4 * EARLY:
        return met(dealt, pairs, meetings)
    # what some blocks have found for a row narrows its limit for all others
    found = durable(_ranked(met(dealt, pairs.where("early"), len(blocks) * EARLY), k), "early")
    narrow = found.where(F.col("rank") == k).select("query", F.col("dist").alias("_dist"))
    dealt = durable(dealt.join(narrow, F.col("key").eqNullSafe(F.col("query")), "left").withColumn(
        "far", F.least("far", "_dist")).drop("query", "_dist"), "limits")
    return found.drop("rank").unionAll(met(dealt, pairs.where("not early"), meetings))


def _pick(table: dict[int, int], size: int) -> Column:
    """The number for the row's cell, from a literal array with one entry per pivot."""
    return F.get(F.array(*[F.lit(int(table.get(c, 0))) for c in range(size)]), F.col("cell"))


def _reachable(dist: np.ndarray, usable: np.ndarray, radius: np.ndarray, k: int) -> np.ndarray:
    """The groups that a query at these distances from the pivots cannot rule out."""
    live = usable > 0
    worst = np.where(live, dist + radius, np.inf)   # no member is farther than this
    order = np.argsort(worst)
    enough = np.searchsorted(np.cumsum(usable[order]), k)
    bound = worst[order[enough]] if enough < len(order) else np.inf
    best = dist - radius                            # no member is nearer than this
    return np.flatnonzero(live & (best <= bound * (1 + 1e-9) + 1e-6)).astype("int32")


def _useless(pivots: np.ndarray, some: np.ndarray, n: int, k: int, p: int) -> bool:
    """Whether groups rule out little even for some of the rows, with no more of every group than these rows show of it."""
    dist = _distances(some, pivots, p)
    cell = dist.argmin(axis=1)
    radius = np.full(len(pivots), -np.inf)
    np.maximum.at(radius, cell, dist[np.arange(len(cell)), cell])
    usable = np.bincount(cell, minlength=len(pivots)) * (n / len(some))
    return sum(len(_reachable(row, usable, radius, k)) for row in dist) > USELESS * len(some) * (usable > 0).sum()


def _grouped(kept: DataFrame, points: DataFrame, pivots: np.ndarray, k: int, p: int, by_group: bool):
    """Training rows with their group, queries with the groups they cannot rule out, and rows and visits per group."""
    n_pivots = len(pivots)

    @F.pandas_udf("struct<cell:int,far:double>")
    def place(v: pd.Series) -> pd.DataFrame:
        if not len(v):
            return pd.DataFrame({"cell": pd.Series(dtype="int32"), "far": pd.Series(dtype="float64")})
        dist = _distances(_matrix(v), pivots, p)
        cell = dist.argmin(axis=1)
        return pd.DataFrame({"cell": cell.astype("int32"), "far": dist[np.arange(len(cell)), cell]})

    placed = durable(kept.withColumn("_p", place("v")).select("key", "label", "v", "g", "_p.cell", "_p.far"), "cells")
    # one row per pivot and group
    stats = placed.groupBy("cell", "g").agg(F.count("*").alias("n"), F.max("far").alias("far")).collect()
    radius = np.full(n_pivots, -np.inf)
    sizes: dict[int, int] = {}
    members = np.zeros(n_pivots)
    own: dict[int, np.ndarray] = {}
    for r in stats:
        radius[r["cell"]] = max(radius[r["cell"]], r["far"])
        sizes[r["cell"]] = sizes.get(r["cell"], 0) + r["n"]
        members[r["cell"]] += r["n"]
        own.setdefault(r["g"], np.zeros(n_pivots))[r["cell"]] += r["n"]

    @F.pandas_udf("array<int>")
    def reach(v: pd.Series, g: pd.Series) -> pd.Series:
        if not len(v):
            return pd.Series([], dtype=object)
        dist = _distances(_matrix(v), pivots, p)
        return pd.Series([_reachable(row, members - own[mine] if by_group and mine in own else members, radius, k) for row, mine in zip(dist, g)])

    reached = durable(points.withColumn("cells", reach("v", "g")), "reach")
    visits = {r["cell"]: r["count"] for r in
              reached.select(F.explode("cells").alias("cell")).groupBy("cell").count().collect()}
    return placed, reached, sizes, visits


def neighbours(train: DataFrame, queries: DataFrame, key: str, k: int, p: int = 2, group: str | None = None,
               block_rows: int | None = None) -> DataFrame:
    """(query, neighbour, label, dist, rank): the k nearest training rows of every query, ties by row key.

    `train` has `key`, `label` and `features`, `queries` has `key` and `features`. With `group`, rows of the query's own
    group are no neighbours. Each `key` is unique within its table.
    """
    arrays = lambda df, *more: df.select(col(key).alias("key"), *more, vector_to_array("features").alias("v"),
                                         (col(group) if group else F.lit(0)).cast("int").alias("g"))
    # of identical rows only the first k by key can be neighbours; the rank filter drops copies before the shuffle
    copies = Window.partitionBy("g", "v").orderBy("key")
    kept = durable(arrays(train, col("label").cast("int").alias("label"))
                   .withColumn("_c", F.row_number().over(copies)).where(F.col("_c") <= k).drop("_c"), "points")
    facts = kept.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("d")).first()
    n, d = facts["n"], facts["d"] or 1
    if not n:
        raise ValueError("no training rows")
    block = block_rows or max(1, min(BLOCK_ROWS, BLOCK_CELLS // d))
    n_pivots = max(1, min(MAX_PIVOTS, BLOCK_CELLS // d, n // min(block, GROUP_ROWS)))
    by_group = group is not None
    points = arrays(queries)
    n_queries = queries.count()
    if n_pivots > 1:
        tried = min(TRIED_ROWS, BLOCK_CELLS // d) if queries is train else 0
        drawn = _matrix(pd.Series([r["v"] for r in kept.orderBy(row_hash(["key"], 0), "key").limit(n_pivots + tried).collect()]))
        pivots, some = drawn[:n_pivots], drawn[n_pivots:]
        if len(some) and np.isfinite(drawn).all() and _useless(pivots, some, n, k, p):
            n_pivots = 1
    if n_pivots > 1:
        placed, reached, sizes, visits = _grouped(kept, points, pivots, k, p, by_group)
    if n_pivots == 1 or sum(visits.values()) > USELESS * n_queries * len(sizes):  # few rows, or groups that rule out little
        n_pivots = 1
        if queries is train and 2 * n >= n_queries:  # else so many copies were dropped that one-sided blocks are smaller
            return _ranked(_mutual(_marked(kept, arrays(train, col("label").cast("int").alias("label")), k, n < n_queries), kept, n_queries, d, k, p,
                                   by_group), k)
        placed, reached = kept.withColumn("cell", F.lit(0)), points.withColumn("cells", F.array(F.lit(0)))
        sizes, visits = {0: n}, {0: n_queries}
    # small inputs still make a few blocks per core, since the work per byte is large
    spark = train.sparkSession
    q_block = max(1, min(block, math.ceil(sum(visits.values()) / (4 * spark.sparkContext.defaultParallelism))))
    t_blocks = {c: math.ceil(m / block) for c, m in sizes.items()}
    q_blocks = {c: math.ceil(m / q_block) for c, m in visits.items()}
    meetings = sum(t_blocks.get(c, 0) * q_blocks.get(c, 0) for c in visits)
    tasks = max(1, min(meetings, 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    blocked = lambda df, table, name: df.withColumn(
        name, F.pmod(F.xxhash64("key"), F.greatest(_pick(table, n_pivots), F.lit(1))).cast("int"))
    copied = lambda df, table, name: df.where(_pick(table, n_pivots) > 0).withColumn(
        name, F.explode(F.sequence(F.lit(0), _pick(table, n_pivots) - 1)))
    t_rows = copied(blocked(placed, t_blocks, "tb"), q_blocks, "qb")
    q_rows = copied(blocked(reached.select("key", "v", "g", F.explode("cells").alias("cell")), q_blocks, "qb"),
                    t_blocks, "tb")
    key_type = kept.schema["key"].dataType.simpleString()

    def meet(t: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        names = ["query", "neighbour", "label", "dist"]
        if not len(t) or not len(q):
            return pd.DataFrame(columns=names)
        t_keys, labels, q_keys = t["key"].to_numpy(), t["label"].to_numpy(), q["key"].to_numpy()
        groups = (t["g"].to_numpy(), q["g"].to_numpy()) if by_group else (None, None)
        found = list(nearest_rows(t_keys, _matrix(t["v"]), _matrix(q["v"]), k, p, *groups))
        if not found:
            return pd.DataFrame(columns=names)
        i, j, dist = (np.concatenate(x) for x in zip(*found))
        return pd.DataFrame({"query": q_keys[i], "neighbour": t_keys[j], "label": labels[j], "dist": dist})

    block_key = ["cell", "tb", "qb"]
    # a fixed number of tasks: by bytes alone, adaptive execution would merge this work into a few
    spread = lambda df: df.repartition(tasks, *block_key)
    near = spread(t_rows).groupBy(*block_key).cogroup(spread(q_rows).groupBy(*block_key)).applyInPandas(
        meet, f"query {key_type}, neighbour {key_type}, label int, dist double")
    return _ranked(near, k)


def _marked(kept: DataFrame, points: DataFrame, k: int, dropped: bool) -> DataFrame:
    """All points; `may` marks training rows, which copies beyond the first k of a point are not."""
    if not dropped:
        return kept.withColumn("may", F.lit(True))
    full = kept.groupBy("g", "v").agg(F.count("*").alias("_n"), F.max("key").alias("_last")).where(F.col("_n") >= k).drop("_n")
    same = [points["g"].eqNullSafe(full["g"]), points["v"] == full["v"]]
    return points.join(full, same, "left").select(
        "key", "label", points["v"], points["g"], (F.col("_last").isNull() | (F.col("key") <= F.col("_last"))).alias("may"))


def _ranked(near: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("query").orderBy(F.round("dist", DIGITS), "neighbour")
    return near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def vote_grid(near: DataFrame, settings: list[tuple[int, str]], n_classes: int) -> DataFrame:
    """(query, setting, winner, probability): the vote under each setting (k, weights), all from one pass.

    Ties go to the first class. With distance weights a vote counts 1/d, and exact matches, if any, take all of it.
    The neighbours of a query already share a task, so neither aggregate shuffles again.
    """
    for _, weights in settings:
        if weights not in ("uniform", "distance"):
            raise ValueError("weights must be 'uniform' or 'distance'")
    dist = F.round("dist", DIGITS)
    rows = near.withColumn("_exact", F.min(dist).over(Window.partitionBy("query")) == 0)
    inverse = F.when(F.col("_exact"), (dist == 0).cast("double")).otherwise(1.0 / F.col("dist"))
    ballots = rows.select("query", "label", "rank", inverse.alias("_inverse")).select(
        "query", "label", "rank", F.inline(F.array(*[
            F.struct(F.lit(i).alias("setting"), F.lit(k).alias("k"),
                     (F.lit(1.0) if weights == "uniform" else F.col("_inverse")).alias("w"))
            for i, (k, weights) in enumerate(settings)]))).where("rank <= k")
    sums = ballots.groupBy("query", "setting", "label").agg(F.sum("w").alias("w"))
    won = sums.groupBy("query", "setting").agg(
        F.max_by("label", F.struct(F.round("w", DIGITS), -F.col("label"))).alias("winner"),
        F.map_from_entries(F.collect_list(F.struct("label", "w"))).alias("_by"), F.sum("w").alias("_all"))
    shares = F.transform(F.sequence(F.lit(0), F.lit(n_classes - 1)),
                         lambda c: F.coalesce(F.try_element_at("_by", c) / F.col("_all"), F.lit(0.0)))
    return won.select("query", "setting", "winner", shares.alias("probability"))


def votes(near: DataFrame, k: int, n_classes: int, weights: str = "uniform") -> DataFrame:
    """(query, winner, probability) from the k nearest."""
    return vote_grid(near, [(k, weights)], n_classes).drop("setting")
