"""Exact order statistics, running totals and hash cuts without a global sort in one task."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from tabwright.functions.exprs import col, row_hash
from tabwright.sources.local import small_table
from tabwright.sources.shared import durable

BRACKET_ROWS = 2_000       # rows of one open bracket that may be sorted in a task
CUTS = 400                 # sketch cut points per column and pass
COLUMNS_AT_ONCE = 20       # columns whose sketches share an aggregate


def exact_quantiles(df: DataFrame, probs: dict[str, list[float]], *, counts: dict[str, int] | None = None,
                    bracket_rows: int = BRACKET_ROWS) -> dict[str, list[float | None]]:
    """Linear-interpolated quantiles of numeric columns, exact at any size.

    Non-null counts first, unless given. Every wanted rank is enclosed in a bracket of values, which each pass over the
    columns narrows with a sketch and proves with counts, until few rows are left inside. No data row is shuffled; a
    pass moves one small row per task. Between two equal values, infinite ones too, a quantile is that value.
    """
    columns = list(probs)
    if not columns:
        return {}
    if counts is None:
        row = df.agg(*[F.count(col(c)).alias(f"n{i}") for i, c in enumerate(columns)]).first()
        counts = {c: row[f"n{i}"] for i, c in enumerate(columns)}
    n = {c: counts[c] for c in columns}
    wanted: dict[tuple[str, int], float | None] = {}
    for c in columns:
        for p in probs[c] if n[c] else []:
            pos = p * (n[c] - 1)
            wanted[c, math.floor(pos)] = None
            wanted[c, math.ceil(pos)] = None
    for at in range(0, len(columns), COLUMNS_AT_ONCE):
        some = {key: None for key in wanted if key[0] in columns[at:at + COLUMNS_AT_ONCE]}
        if some:
            _order_statistics(df, n, some, bracket_rows)
            wanted.update(some)

    def value(c: str, p: float) -> float | None:
        if not n[c]:
            return None
        pos = p * (n[c] - 1)
        low, high = wanted[c, math.floor(pos)], wanted[c, math.ceil(pos)]
        return low if low == high else low + (high - low) * (pos - math.floor(pos))

    return {c: [value(c, p) for p in probs[c]] for c in columns}


def _order_statistics(df: DataFrame, n: dict[str, int], found: dict[tuple[str, int], float | None],
                      bracket_rows: int) -> None:
    """Fill `found[(column, rank)]` by narrowing value brackets."""
    cut_probs = F.expr(f"array({', '.join(f'{i / CUTS}D' for i in range(CUTS + 1))})")

    def sketch(c: str, inside: Column | None) -> Column:
        v = col(c).cast("double")
        return F.percentile_approx(v if inside is None else F.when(inside, v), cut_probs, 10 * CUTS)

    columns = sorted({c for c, _ in found})
    row = df.agg(*[sketch(c, None).alias(f"s{i}") for i, c in enumerate(columns)]).first()
    # per target: closed ends low and high (data values that enclose the rank)
    ends = {}
    proven = dict.fromkeys(found, (None, None))  # values known to lie at or outside the rank; None is open
    for i, c in enumerate(columns):
        cuts = list(row[f"s{i}"])
        for key in found:
            if key[0] == c:
                at = key[1] / max(n[c] - 1, 1) * CUTS
                ends[key] = (cuts[max(0, math.floor(at) - 1)], cuts[min(CUTS, math.ceil(at) + 1)])
    while ends:
        # neighbouring ranks mostly share a bracket, which is then measured once
        brackets = {(key[0], *ends[key]): j for j, key in enumerate(ends)}
        exprs = []
        for (c, low, high), j in brackets.items():
            v = col(c).cast("double")
            inside = (v > F.lit(low)) & (v < F.lit(high))
            exprs += [F.count_if(v < F.lit(low)).alias(f"b{j}"), F.count_if(v == F.lit(low)).alias(f"l{j}"),
                      F.count_if(inside).alias(f"i{j}"), F.count_if(v == F.lit(high)).alias(f"h{j}"),
                      F.min(v).alias(f"mn{j}"), F.max(v).alias(f"mx{j}"), sketch(c, inside).alias(f"c{j}")]
        row = df.agg(*exprs).first()
        ready, after = {}, {}
        for key, (low, high) in ends.items():
            j = brackets[key[0], low, high]
            below, at_low, inner, at_high = (row[f"{x}{j}"] for x in "blih")
            rank = key[1] - below
            least, most = proven[key]
            if rank < 0:                      # the sketch missed: widen, no further than what is proven
                proven[key] = (least, low)
                after[key] = (row[f"mn{j}"] if least is None else least, low)
            elif rank < at_low:
                found[key] = low
            elif low != high and rank < at_low + inner:
                rank -= at_low
                proven[key] = (low, high)
                if inner <= bracket_rows:
                    ready.setdefault((key[0], low, high), []).append((key, rank))
                else:
                    cuts, at = list(row[f"c{j}"]), rank / inner * CUTS
                    after[key] = (cuts[max(0, math.floor(at) - 1)], cuts[min(CUTS, math.ceil(at) + 1)])
                    if after[key] == (low, high):
                        after[key] = (cuts[0], cuts[CUTS])
            elif low != high and rank < at_low + inner + at_high:
                found[key] = high
            else:
                proven[key] = (high, most)
                after[key] = (high, row[f"mx{j}"] if most is None else most)
        if ready:
            picks = []
            for j, ((c, low, high), wanted) in enumerate(ready.items()):
                v = col(c).cast("double")
                kept = F.sort_array(F.collect_list(F.when((v > F.lit(low)) & (v < F.lit(high)), v)))
                picks += [F.get(kept, F.lit(rank)).alias(f"v{j}_{m}") for m, (_, rank) in enumerate(wanted)]
            row = df.agg(*picks).first()
            for j, wanted in enumerate(ready.values()):
                for m, (key, _) in enumerate(wanted):
                    found[key] = row[f"v{j}_{m}"]
        ends = after


def _add_up(weights: list[str], before: list[str], by: list[str], at: list[int]):
    """Running totals inside a sorted partition: sums of the rows before within the group, and which group of the partition it is."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last, group, place, carried = None, -1, 0, [0] * len(weights)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            new = np.zeros(n, bool)
            for i in at:
                codes = batch.column(i).dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
                new[1:] |= codes[1:] != codes[:-1]
            first = [batch.column(i)[0].as_py() for i in at]
            new[0] = place == 0 or first != last
            groups = group + np.cumsum(new)
            starts = np.flatnonzero(new)
            out = []
            for k, w in enumerate(weights):
                values = batch.column(batch.schema.get_field_index(w)).to_numpy(zero_copy_only=False)
                sums = np.concatenate([[0], np.cumsum(values)])
                base = np.zeros(n, sums.dtype)
                base[starts] = np.diff(np.concatenate([[0], sums[starts]]))
                carry = 0 if new[0] else carried[k]
                local = sums[:-1] - np.cumsum(base)
                open_ = slice(0, starts[0] if len(starts) else n)
                local[open_] += carry
                out.append(pa.array(local))
                carried[k] = local[-1] + values[-1]
            yield pa.RecordBatch.from_arrays([*batch.columns, *out, pa.array(np.full(n, part, np.int32)), pa.array(groups.astype(np.int64)), pa.array(place + np.arange(n))],
                                             names=[*batch.schema.names, *before, "_part", "_group", "_place"])
            last, group, place = [batch.column(i)[n - 1].as_py() for i in at], int(groups[-1]), place + n
    return run


def running_totals(df: DataFrame, order: str, weight: str | dict[str, str], by: list[str] | None = None,
                   descending: bool = False) -> DataFrame:
    """Add `before`: the weight of all smaller `order` values within `by`; for several weights, a name for each.

    `df` holds one row per (by, order). One range shuffle sorts it; every range partition adds up its own rows. Only a
    partition's first group can have begun earlier, so one figure per partition and weight, a constant, completes the sums.
    """
    by = by or []
    named = {weight: "before"} if isinstance(weight, str) else weight
    key = col(order).desc() if descending else col(order).asc()
    keys = [*[col(b) for b in by], key]
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    sums = {w: "double" if kinds[w] == "double" else "bigint" for w in named}
    ready = df.withColumns({w: col(w).cast(t) for w, t in sums.items()})
    fields = [*[f"`{c}` {sums.get(c, t)}" for c, t in kinds.items()], *[f"`{b}` {sums[w]}" for w, b in named.items()],
              "_part int", "_group bigint", "_place bigint"]
    added = durable(ready.repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(
        _add_up(list(named), list(named.values()), by, [df.columns.index(b) for b in by]), ", ".join(fields)), "ranged")
    group = F.struct(*[col(b) for b in by], F.lit(0).alias("_all"))
    totals = F.struct("_group", *[(col(b) + col(w)).alias(w) for w, b in named.items()])
    ends = added.groupBy("_part").agg(F.min_by(group, "_place").alias("first"), F.max_by(group, "_place").alias("last"),
                                      F.max_by(totals, "_place").alias("total")).orderBy("_part").collect()  # a row per partition
    offsets = {w: [0] * (max((r["_part"] for r in ends), default=0) + 1) for w in named}
    carried, of = dict.fromkeys(named, 0), None
    for r in ends:
        goes_on = of is not None and r["first"] == of
        for w in named:
            offsets[w][r["_part"]] = carried[w] if goes_on else 0
            carried[w] = r["total"][w] + (offsets[w][r["_part"]] if r["total"]["_group"] == 0 else 0)
        of = r["last"]
    whole = {b: col(b) + F.when(F.col("_group") == 0, F.get(F.array(*[F.lit(v).cast(sums[w]) for v in offsets[w]]), F.col("_part"))).otherwise(F.lit(0))
             for w, b in named.items()}
    return added.withColumns(whole).drop("_part", "_group", "_place")


def numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Add `name`: the place of every row, from 1, in the given order over the whole table.

    Range partitions are sorted and written with their own numbering; one count per partition places them. Rows that tie
    in all of `order` get their places in any order.
    """
    ranged = durable(df.repartitionByRange(*order).sortWithinPartitions(*order)
                     .withColumn("_at", F.monotonically_increasing_id()), "numbered")  # partition, then place inside it
    sizes = ranged.groupBy(F.shiftright("_at", 33).alias("part")).count().orderBy("part").collect()
    starts, before = [], 0
    for r in sizes:
        starts.append((r["part"], before))
        before += r["count"]
    offsets = F.broadcast(small_table(df.sparkSession, starts, "_part bigint, _before bigint"))
    placed = ranged.join(offsets, F.shiftright("_at", 33) == F.col("_part"))
    return placed.select(*[col(c) for c in df.columns],
                         (F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1).alias(name))


def hash_cuts(df: DataFrame, ids: list[str], ranks: dict, cls: str | None, seed: int, largest: int,
              bucket_rows: int = 10_000) -> dict:
    """The row key `(h, *ids)` at the given 0-based ranks of each class in hash order.

    `largest` is the row count of the largest class. `ranks` maps a class to a list of ranks; the result maps (class, rank) to the key. The hash is uniform, so
    its leading bits narrow every rank to a bucket of bounded size before anything is sorted.
    """
    targets = [(c, r) for c, rs in ranks.items() for r in rs]
    if not targets:
        return {}
    label = col(cls) if cls else F.lit(0)
    keyed = df.select(label.alias("_cls"), row_hash(ids, seed).alias("_h"), *[col(i) for i in ids])
    if not cls:
        targets = [(0, r) for _, r in targets]
    spark = df.sparkSession
    cls_type = keyed.schema["_cls"].dataType.simpleString()
    state = {t: ("", t[1]) for t in targets}  # hash prefix, rank among the rows that have it
    digits = 0

    def seekers() -> DataFrame:  # a row per class and rank
        return small_table(spark, [(t[0], t[1], prefix, rank) for t, (prefix, rank) in state.items()],
                           f"_cls {cls_type}, _target bigint, _prefix string, _rank bigint")

    def candidates(sought: DataFrame) -> DataFrame:
        return keyed.withColumn("_prefix", F.substring("_h", 1, digits) if digits else F.lit("")).join(
            F.broadcast(sought.select("_cls", "_prefix").distinct()), ["_cls", "_prefix"], "left_semi")

    while largest / 16 ** digits > bucket_rows and digits < 8:
        sought = seekers()
        buckets = candidates(sought).groupBy(
            "_cls", "_prefix", F.substring("_h", 1, digits + 2).alias("_next")).count()
        w = Window.partitionBy("_cls", "_prefix").orderBy("_next")  # at most 256 rows
        spans = buckets.withColumn("_end", F.sum("count").over(w)).withColumn("_start", F.col("_end") - F.col("count"))
        hits = (spans.join(F.broadcast(sought), ["_cls", "_prefix"])
                .where("_start <= _rank and _rank < _end")
                .select("_cls", "_target", "_next", (F.col("_rank") - F.col("_start")).alias("_left")).collect())
        digits += 2
        state = {(r["_cls"], r["_target"]): (r["_next"], r["_left"]) for r in hits}
    sought = seekers()
    w = Window.partitionBy("_cls", "_prefix").orderBy("_h", *[col(i) for i in ids])
    rows = (candidates(sought).withColumn("_rank", F.row_number().over(w).cast("bigint") - 1)
            .join(F.broadcast(sought), ["_cls", "_prefix", "_rank"]).collect())
    return {(r["_cls"], r["_target"]): (r["_h"], *[r[i] for i in ids]) for r in rows}


def not_after(ids: list[str], seed: int, cuts: dict, cls: str | None = None, hashed: Column | None = None) -> Column:
    """True for rows at or before the cut key of their class in hash order; False for a class without a cut.

    The hash is computed once per row, or taken from `hashed`.
    """
    if not cuts:
        return F.lit(False)
    pack = lambda h, values: F.struct(h.alias("h"), *[v.alias(f"k{i}") for i, v in enumerate(values)])
    literal = lambda key: pack(F.lit(key[0]), [F.lit(v) for v in key[1:]])
    if cls is None:
        cut = literal(next(iter(cuts.values())))
    else:
        cut = F
        for c, key in cuts.items():
            cut = cut.when(col(cls) == F.lit(c), literal(key))
    mine = pack(hashed if hashed is not None else row_hash(ids, seed), [col(i) for i in ids])
    return F.coalesce(mine <= cut, F.lit(False))
