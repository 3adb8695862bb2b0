"""Train/test split and folds as plain filter expressions.

A row's side depends only on its class and its place in the hash order of row keys. The few keys where
one side ends and the next begins are found once; after that a split is a predicate on the scan.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window, functions as F

from tabwright.functions.exprs import col, row_hash
from tabwright.operators.ordered import hash_cuts, not_after
from tabwright.sources.shared import durable

SEED = 42
COPY = "_copy"


def distinct_keys(df: DataFrame, ids: list[str]) -> tuple[DataFrame, list[str]]:
    """The table and its row keys; where keys repeat, a counter among rows of one key is added to them.

    Only the keys are counted. The counter follows the order of the rows' contents, so it is the same under any plan. The table with the
    counter is stored, since every pass over it would sort all rows again.
    """
    hashed = df.select(F.xxhash64(*[col(i) for i in ids]).alias("h"))
    if hashed.groupBy("h").count().where("count > 1").isEmpty():
        return df, ids
    rest = [c for c in df.columns if c not in ids]
    w = Window.partitionBy(*[col(i) for i in ids]).orderBy(F.xxhash64(*[col(c) for c in rest]) if rest else F.lit(0), *[col(c) for c in rest])
    return durable(df.withColumn(COPY, F.row_number().over(w)), "keys"), [*ids, COPY]


def class_sizes(df: DataFrame, target: str) -> dict:
    """Rows per class in class order."""
    return class_sizes_and_missing(df, target)[0]


def class_sizes_and_missing(df: DataFrame, target: str) -> tuple[dict, int]:
    rows = df.groupBy(col(target).alias("c")).agg(F.count("*").alias("n")).collect()  # one row per class
    known = [r for r in rows if r["c"] is not None]
    missing = sum(r["n"] for r in rows if r["c"] is None)
    return {r["c"]: r["n"] for r in sorted(known, key=lambda r: r["c"])}, missing


def test_quotas(sizes: dict, test_size: float) -> dict:
    """Test rows per class: proportional, remaining rows by largest remainder, then class order."""
    n = sum(sizes.values())
    n_test = math.ceil(test_size * n)
    quotas = {c: m * n_test // n for c, m in sizes.items()}
    by_remainder = sorted(sizes, key=lambda c: (-(sizes[c] * n_test % n), list(sizes).index(c)))
    for c in by_remainder[:n_test - sum(quotas.values())]:
        quotas[c] += 1
    return quotas


def mark_test(df: DataFrame, ids: list[str], target: str, test_size: float = 0.2, stratify: bool = True,
              seed: int = SEED, flag: str = "is_test") -> tuple[DataFrame, int]:
    """Rows with a target and their side, exact in size, per class if stratified; and how many had no target."""
    if stratify:
        sizes, missing = class_sizes_and_missing(df, target)
        if sizes and min(sizes.values()) < 2:
            raise ValueError("The least populated class has fewer than 2 rows; it cannot be split.")
        quotas, cls, largest = test_quotas(sizes, test_size), target, max(sizes.values(), default=0)
    else:
        row = df.agg(F.count(col(target)).alias("n"), F.count_if(col(target).isNull()).alias("missing")).first()
        largest, missing = row["n"], row["missing"]
        quotas, cls = {0: math.ceil(test_size * largest)}, None
    known, ids = distinct_keys(df.where(col(target).isNotNull()), ids)
    found = hash_cuts(known, ids, {c: [q - 1] for c, q in quotas.items() if q > 0}, cls, seed, largest)
    marked = known.withColumn(flag, not_after(ids, seed, {c: key for (c, _), key in found.items()}, cls))
    return marked.drop(COPY), missing


def train_test_split(df: DataFrame, ids: list[str], target: str, test_size: float = 0.2, stratify: bool = True,
                     seed: int = SEED) -> tuple[DataFrame, DataFrame, int]:
    """(train, test, dropped)."""
    marked, missing = mark_test(df, ids, target, test_size, stratify, seed, "_test")
    return marked.where(~F.col("_test")).drop("_test"), marked.where("_test").drop("_test"), missing


def fold_sizes(sizes: dict, k: int) -> dict:
    """Rows per class and fold: class sizes differ by at most one between folds, and so do fold totals."""
    out, earlier = {}, 0
    for c, n in sizes.items():
        out[c] = [len(range((f - earlier) % k, n, k)) for f in range(k)]
        earlier += n
    return out


def stratified_folds(df: DataFrame, ids: list[str], target: str, k: int = 5, seed: int = SEED) -> DataFrame:
    """`df` with a column `fold` in 0..k-1: consecutive stretches of each class's hash order."""
    if not 2 <= k <= 10:
        raise ValueError("The number of folds must be between 2 and 10.")
    df, ids = distinct_keys(df, ids)
    sizes = class_sizes(df, target)
    if sizes and k > max(sizes.values()):
        raise ValueError("More folds than rows in every class.")
    ends = {}
    for c, counts in fold_sizes(sizes, k).items():
        ends[c] = [sum(counts[:f + 1]) - 1 for f in range(k - 1)]
    cuts = hash_cuts(df, ids, {c: sorted({r for r in rs if r >= 0}) for c, rs in ends.items()}, target, seed,
                     max(sizes.values(), default=0))
    # a row moves on one fold for every cut of its class that it lies behind
    fold = F.lit(0)
    for f in range(k - 1):
        here = {c: cuts[c, ranks[f]] for c, ranks in ends.items() if ranks[f] >= 0}
        fold = fold + F.when(not_after(ids, seed, here, target, F.col("_h")), 0).otherwise(1)
    hashed = df.withColumn("_h", row_hash(ids, seed))
    return hashed.withColumn("fold", F.when(col(target).isNotNull(), fold)).drop("_h", COPY)
