"""Missing values, correlations, outliers, distributions and the full profile."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from tabwright.functions.exprs import col, is_numeric, nan_to_null, text_to_number
from tabwright.operators.coltypes import resolve_profile_types
from tabwright.operators.counts import per_column, top_values, value_counts
from tabwright.operators.lookup import left_lookup
from tabwright.operators.ordered import exact_quantiles, running_totals
from tabwright.operators.table import capped, numeric_columns
from tabwright.sources.local import small_table
from tabwright.sources.shared import durable

SHORT_RANKS = 2_000_000  # ranks that travel to every task: 32 MB


@dataclass(frozen=True)
class Facts:
    """What one pass over a table tells about its columns: rows, and per column count, mean, spread and ends."""

    rows: int
    count: dict[str, int]
    mean: dict[str, float | None]
    std: dict[str, float | None]
    low: dict[str, float | None]
    high: dict[str, float | None]


def measure(df: DataFrame) -> Facts:
    """The figures that missing values, statistics, correlations, outliers and histograms share, in one aggregate."""
    df = nan_to_null(df)
    numeric = set(numeric_columns(df))
    aggs = [F.count("*").alias("rows")]
    for i, c in enumerate(df.columns):
        aggs.append(F.count(col(c)).alias(f"count{i}"))
        if c in numeric:
            aggs += [F.avg(col(c)).cast("double").alias(f"mean{i}"), F.stddev_pop(col(c)).alias(f"std{i}"),
                     F.min(col(c)).cast("double").alias(f"low{i}"), F.max(col(c)).cast("double").alias(f"high{i}")]
    row = df.agg(*aggs).first()
    take = lambda name: {c: row[f"{name}{i}"] for i, c in enumerate(df.columns) if name == "count" or c in numeric}
    return Facts(row["rows"], *[take(name) for name in ("count", "mean", "std", "low", "high")])


def missing_values(df: DataFrame, facts: Facts | None = None) -> DataFrame:
    """column, missing_count, missing_percent; an empty table has 0 percent."""
    if facts:
        rows = small_table(df.sparkSession, [(c, facts.rows - n, facts.rows) for c, n in facts.count.items()],
                           "column string, missing_count bigint, n_rows bigint")
    else:
        df = nan_to_null(df)
        rows = per_column(df, df.columns, {"missing_count": lambda c: F.count_if(col(c).isNull())},
                          {"n_rows": F.count("*")})
    percent = F.coalesce(100.0 * F.try_divide(F.col("missing_count"), F.col("n_rows")), F.lit(0.0))
    return rows.select("column", "missing_count", percent.alias("missing_percent")).orderBy(
        F.desc("missing_percent"), F.desc("missing_count"), "column")


def missing_total(df: DataFrame) -> DataFrame:
    return missing_values(df).agg(F.sum("missing_count").alias("total_missing"))


def high_missing(df: DataFrame, threshold: float) -> DataFrame:
    return missing_values(df).where(F.col("missing_percent") >= threshold)


def missing_patterns(df: DataFrame) -> DataFrame:
    """Row counts per combination of missing columns, as a bit string in column order."""
    df = nan_to_null(df)
    bits = F.concat(*[F.when(col(c).isNull(), "1").otherwise("0") for c in df.columns])
    return df.select(bits.alias("pattern")).groupBy("pattern").agg(F.count("*").alias("count"))


def _pairs(columns: list[str]) -> list[tuple[str, str]]:
    return list(combinations(columns, 2))


def pearson(df: DataFrame, columns: list[str] | None = None, max_features: int | None = None, per_pass: int = 120,
            facts: Facts | None = None) -> DataFrame:
    """(col_a, col_b, n, corr) over rows where both are present; constant columns give NULL.

    Columns are first shifted by their mean, so plain sums are stable. A pass then needs one sum per pair plus those per column;
    a pair with gaps is measured on its own rows, which may lie far from that mean. Whether a column is constant is told by its
    ends, since rounding leaves it some variance. No shuffle beyond one row per task.
    """
    df = nan_to_null(df)
    columns, _ = capped(columns or numeric_columns(df), max_features, "Correlation")
    pairs = _pairs(columns)
    if not pairs:
        return small_table(df.sparkSession, [], "col_a string, col_b string, n bigint, corr double")
    if facts is None:
        facts = measure(df.select(*[col(c) for c in columns]))
    at = {c: i for i, c in enumerate(columns)}
    centre = [facts.mean[c] or 0.0 for c in columns]
    shifted = df.select(*[(col(c).cast("double") - F.lit(centre[i])).alias(f"x{i}") for c, i in at.items()])
    full = {i for c, i in at.items() if facts.count[c] == facts.rows}
    constant = {i for c, i in at.items() if facts.low[c] == facts.high[c]}
    parts = []
    for start in range(0, len(pairs), per_pass):
        chunk = [(at[a], at[b]) for a, b in pairs[start:start + per_pass]]
        sums: dict[str, Column] = {"n": F.count("*")}
        structs = []
        for i, j in chunk:
            x, y = F.col(f"x{i}"), F.col(f"x{j}")
            if i in full and j in full:
                sums[f"xy_{i}_{j}"] = F.sum(x * y)
                for k, v in ((i, x), (j, y)):
                    sums[f"s{k}"] = F.sum(v)
                    sums[f"q{k}"] = F.sum(v * v)
            else:
                both = x.isNotNull() & y.isNotNull()
                sums[f"n_{i}_{j}"] = F.count_if(both)
                sums[f"cov_{i}_{j}"] = F.covar_pop(x, y)
                for k, v in ((i, F.when(both, x)), (j, F.when(both, y))):
                    sums[f"std{k}_{i}_{j}"] = F.when(F.min(v) < F.max(v), F.stddev_pop(v))
            structs.append((i, j))
        wide = shifted.agg(*[e.alias(name) for name, e in sums.items()])

        def shown(i: int, j: int) -> list[Column]:
            if not (i in full and j in full):
                scale = F.col(f"std{i}_{i}_{j}") * F.col(f"std{j}_{i}_{j}")
                return [F.col(f"n_{i}_{j}").alias("n"), F.try_divide(F.col(f"cov_{i}_{j}"), scale).alias("corr")]
            n = F.nullif(F.col("n").cast("double"), F.lit(0.0))
            mean = {k: F.col(f"s{k}") / n for k in (i, j)}
            var = {k: F.col(f"q{k}") / n - mean[k] * mean[k] for k in (i, j)}
            cov = F.col(f"xy_{i}_{j}") / n - mean[i] * mean[j]
            flat = F.lit(bool({i, j} & constant)) | (var[i] <= 0) | (var[j] <= 0)
            return [F.col("n"), F.when(~flat, F.try_divide(cov, F.sqrt(var[i] * var[j]))).alias("corr")]

        parts.append(wide.select(F.inline(F.array(*[
            F.struct(F.lit(columns[i]).alias("col_a"), F.lit(columns[j]).alias("col_b"), *shown(i, j))
            for i, j in structs]))))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return out


def _pair_counts(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """Distinct (pair, x, y) with their row count; the starting point of the rank correlations."""
    structs = [F.struct(F.lit(k).alias("pair"), col(a).cast("double").alias("x"), col(b).cast("double").alias("y"))
               for k, (a, b) in enumerate(pairs)]
    return (df.select(F.inline(F.array(*structs))).where("x is not null and y is not null")
            .groupBy("pair", "x", "y").agg(F.count("*").alias("n")))


def _pair_names(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    names = [(k, a, b) for k, (a, b) in enumerate(pairs)]
    return F.broadcast(small_table(df.sparkSession, names, "pair int, col_a string, col_b string"))


def spearman(df: DataFrame, columns: list[str] | None = None, max_features: int | None = None) -> DataFrame:
    """(col_a, col_b, corr): Pearson over average ranks, ranked within each pair's complete rows.

    Ranks come from running totals over distinct values, never from a sort of all rows in one task.
    Columns without gaps have the same ranks in every pair of them, so these are looked up once per column;
    a pair with gaps is ranked on its own.
    """
    df = nan_to_null(df)
    columns, _ = capped(columns or numeric_columns(df), max_features, "Correlation")
    if len(columns) < 2:
        return small_table(df.sparkSession, [], "col_a string, col_b string, corr double")
    first = df.agg(F.count("*").alias("n"), *[F.count(col(c)).alias(f"n{i}") for i, c in enumerate(columns)]).first()
    full = [c for i, c in enumerate(columns) if first[f"n{i}"] == first["n"]]
    parts = []
    if len(full) > 1:
        parts.append(_spearman_complete(df, full, first["n"]))
    rest = [(a, b) for a, b in _pairs(columns) if not (a in full and b in full)]
    if rest:
        parts.append(_spearman_pairs(df, rest))
    return parts[0] if len(parts) == 1 else parts[0].unionAll(parts[1])


def _cross_products(width: int, short: list[int], tables):
    """Sums of products of ranks over the rows of a task; `short` columns are ranked here, by values that all tasks have."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, known = np.zeros((width, width)), tables.value
        for batch in batches:
            ranks = np.empty((width, batch.num_rows))
            for i in range(width):
                ranks[i] = batch.column(i).to_numpy(zero_copy_only=False)
                if i in known:
                    values, r = known[i]
                    ranks[i] = r[np.searchsorted(values, ranks[i])]
            total += ranks @ ranks.T
        at = np.arange(width * width)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total.ravel())], names=["cell", "s"])
    return run


def _spearman_complete(df: DataFrame, columns: list[str], n: int) -> DataFrame:
    """Columns of few distinct values, together at most SHORT_RANKS, are ranked by a table that every task has. The cells of all others,
    (row, column, value), find their ranks in one shuffle by value, hot values apart, and their rows in a second one."""
    cells = df.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("c"), (col(c).cast("double") + F.lit(0.0)).alias("v")) for i, c in enumerate(columns)])))
    counts = cells.groupBy("c", "v").agg(F.count("*").alias("w"))
    centre = (n + 1) / 2
    ranks = running_totals(counts, "v", "w", ["c"]).select(
        "c", "v", "w", (F.col("before") + (F.col("w") + 1) / 2 - F.lit(centre)).alias("r"))
    sizes = {r["c"]: r["count"] for r in ranks.groupBy("c").count().collect()}  # a row per column
    short, held = [], 0
    for c, size in sorted(sizes.items(), key=lambda x: (x[1], x[0])):
        held += size
        if held > SHORT_RANKS:
            break
        short.append(c)
    table = ranks.where(F.col("c").isin(short)).select("c", "v", "r").toArrow() if short else None
    known = {}
    for c in short:
        own = table.filter(pc.equal(table["c"], c))
        v, r = own["v"].to_numpy(), own["r"].to_numpy()
        known[c] = (np.sort(v), r[np.argsort(v)])
    rows = df.select(*[(col(c).cast("double") + F.lit(0.0)).alias(f"v{i}") for i, c in enumerate(columns)])
    long = [i for i in range(len(columns)) if i not in known]
    if long:
        rows = durable(rows.withColumn("_row", F.monotonically_increasing_id()), "rows")
        key = F.struct(F.col("c"), F.col("v")).alias("key")
        wide = rows.select("_row", F.inline(F.array(*[F.struct(F.lit(i).alias("c"), F.col(f"v{i}").alias("v")) for i in long]))).select("_row", "c", key)
        found = left_lookup(wide, ranks.where(F.col("c").isin(long)).select(key, "r", "w"), "key", "r", "w", sum(sizes[i] for i in long), n * len(long))
        by_row = found.groupBy("_row").agg(*[F.max(F.when(F.col("c") == i, F.col("r"))).alias(f"v{i}") for i in long])
        rows = rows.select("_row", *[f"v{i}" for i in short]).join(by_row, "_row") if short else by_row
    rows = rows.select(*[f"v{i}" for i in range(len(columns))])
    shared = df.sparkSession.sparkContext.broadcast(known)
    sums = rows.mapInArrow(_cross_products(len(columns), short, shared), "cell bigint, s double").groupBy("cell").agg(F.sum("s").alias("s")).collect()
    s = {r["cell"]: r["s"] for r in sums}  # a number per pair of columns
    k, out = len(columns), []
    for i, j in combinations(range(k), 2):
        scale = math.sqrt(s.get(i * k + i, 0.0) * s.get(j * k + j, 0.0))
        out.append((columns[i], columns[j], s[i * k + j] / scale if scale else None))
    return small_table(df.sparkSession, out, "col_a string, col_b string, corr double")


def _spearman_pairs(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    cells = durable(_pair_counts(df, pairs), "pairs")

    def ranks(side: str) -> DataFrame:
        totals = cells.groupBy("pair", side).agg(F.sum("n").alias("w"))
        placed = running_totals(totals, side, "w", ["pair"])
        return placed.select("pair", side, (F.col("before") + (F.col("w") + 1) / 2).alias(f"r{side}"))

    ranked = cells.join(ranks("x"), ["pair", "x"]).join(ranks("y"), ["pair", "y"])
    # centre on the known mean rank (N + 1) / 2; one row per pair
    size = cells.groupBy("pair").agg(((F.sum("n") + 1) / 2).alias("mid"))
    centred = ranked.join(F.broadcast(size), "pair").select(
        "pair", "n", (F.col("rx") - F.col("mid")).alias("dx"), (F.col("ry") - F.col("mid")).alias("dy"))
    sums = centred.groupBy("pair").agg(
        *[F.sum(F.col("n") * F.col(a) * F.col(b)).alias(a + b) for a, b in (("dx", "dx"), ("dx", "dy"), ("dy", "dy"))])
    corr = F.try_divide(F.col("dxdy"), F.nullif(F.sqrt(F.col("dxdx") * F.col("dydy")), F.lit(0.0)))
    # a pair without complete rows still has its line
    return (_pair_names(df, pairs).join(sums, "pair", "left").select("col_a", "col_b", corr.alias("corr")))


def kendall(df: DataFrame, columns: list[str] | None = None, max_features: int | None = None) -> DataFrame:
    """(col_a, col_b, corr): Kendall's tau-b without comparing all pairs of rows.

    Two different ranks of y share a leading part and then differ in one bit. So for every bit, pairs that
    first differ there are counted inside each leading part by a running total along x: log2(d) copies
    of d distinct points in place of d * d comparisons.
    """
    df = nan_to_null(df)
    columns, _ = capped(columns or numeric_columns(df), max_features, "Correlation")
    if len(columns) < 2:
        return small_table(df.sparkSession, [], "col_a string, col_b string, corr double")
    cells = durable(_pair_counts(df, _pairs(columns)), "pairs")
    y_values = cells.groupBy("pair", "y").agg(F.sum("n").alias("w")).withColumn("one", F.lit(1))
    y_ranks = durable(running_totals(y_values, "y", "one", ["pair"])
                      .select("pair", "y", "w", F.col("before").alias("rank")), "ranks")
    x_weights = cells.groupBy("pair", "x").agg(F.sum("n").alias("w"))
    top = y_ranks.agg(F.max("rank")).first()[0] or 0
    bits = max(int(top).bit_length(), 1)
    points = cells.join(y_ranks.select("pair", "y", "rank"), ["pair", "y"])
    levels = points.select("pair", "x", "n", "rank", F.explode(F.sequence(F.lit(0), F.lit(bits - 1))).alias("bit"))
    split = levels.select(
        "pair", "x", "bit", F.expr("shiftright(rank, bit + 1)").alias("lead"),
        F.when(F.expr("shiftright(rank, bit) % 2 = 0"), F.col("n")).otherwise(0).alias("n0"),
        F.when(F.expr("shiftright(rank, bit) % 2 = 1"), F.col("n")).otherwise(0).alias("n1"))
    group = ["pair", "bit", "lead"]
    steps = split.groupBy(*group, "x").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    lows = running_totals(steps, "x", "n0", group)
    # along x: ones see the zeros before them (concordant); zeros after them are discordant
    agree = lows.groupBy("pair").agg(F.sum(F.col("n1").cast("double") * F.col("before")).alias("agree"),
                                     F.sum(F.col("n1").cast("double") * F.col("n0")).alias("level"))
    zeros_ones = split.groupBy(*group).agg(
        (F.sum("n0").cast("double") * F.sum("n1")).alias("all"))
    crossing = zeros_ones.groupBy("pair").agg(F.sum("all").alias("all"))

    def tied(t: DataFrame, name: str) -> DataFrame:
        w = F.col("w").cast("double")
        return t.groupBy("pair").agg((F.sum(w * (w - 1)) / 2).alias(name), F.sum(w).alias(f"size_{name}"))

    table = (agree.join(crossing, "pair").join(tied(x_weights, "tx"), "pair").join(tied(y_ranks, "ty"), "pair"))
    n = F.col("size_tx")
    total = n * (n - 1) / 2
    score = F.col("agree") - (F.col("all") - F.col("agree") - F.col("level"))
    scale = F.sqrt((total - F.col("tx")) * (total - F.col("ty")))
    return _pair_names(df, _pairs(columns)).join(table, "pair", "left").select(
        "col_a", "col_b", F.try_divide(score, F.nullif(scale, F.lit(0.0))).alias("corr"))


def correlations(df: DataFrame, method: str = "pearson", max_features: int | None = None, facts: Facts | None = None
                 ) -> DataFrame:
    if method == "pearson":
        return pearson(df, max_features=max_features, facts=facts).drop("n")
    if method == "spearman":
        return spearman(df, max_features=max_features)
    if method == "kendall":
        return kendall(df, max_features=max_features)
    raise ValueError("Correlation method must be 'pearson', 'spearman' or 'kendall'.")


def iqr_bounds(df: DataFrame, columns: list[str], multiplier: float = 1.5, facts: Facts | None = None
               ) -> dict[str, tuple[float, float] | None]:
    """Lower and upper fence per column; None for a column without values."""
    out = {}
    counts = facts.count if facts else None
    for c, (q1, q3) in exact_quantiles(df, {c: [0.25, 0.75] for c in columns}, counts=counts).items():
        out[c] = None if q1 is None else (q1 - multiplier * (q3 - q1), q3 + multiplier * (q3 - q1))
    return out


def outliers(df: DataFrame, method: str = "iqr", iqr_multiplier: float = 1.5, zscore_threshold: float = 3.0,
             columns: list[str] | None = None, max_columns: int | None = None, facts: Facts | None = None) -> DataFrame:
    """column, outlier_count, outlier_percent of the non-null rows; zero spread means no outliers.

    Pass one learns bounds, a few numbers per column; pass two counts with them as constants.
    """
    df = nan_to_null(df)
    columns, _ = capped(columns if columns is not None else numeric_columns(df), max_columns, "Outlier scan")
    method = method.strip().lower()
    if method not in ("iqr", "z", "zscore", "z-score"):
        raise ValueError(f"unknown outlier method {method!r}: iqr or zscore")
    if not columns:
        return small_table(df.sparkSession, 
            [], "column string, method string, non_null_count bigint, outlier_count bigint, outlier_percent double")
    tests: dict[str, Column] = {}
    if method == "iqr":
        for c, b in iqr_bounds(df, columns, iqr_multiplier, facts).items():
            if b is not None and b[0] < b[1]:
                tests[c] = (col(c) < F.lit(b[0])) | (col(c) > F.lit(b[1]))
    else:
        facts = facts or measure(df.select(*[col(c) for c in columns]))
        for c in columns:
            if facts.std[c] and not math.isnan(facts.std[c]):  # infinite values have no spread to measure by
                tests[c] = F.abs((col(c) - F.lit(facts.mean[c])) / F.lit(facts.std[c])) > F.lit(zscore_threshold)
    table = per_column(df, columns, {
        "non_null_count": lambda c: F.count(col(c)),
        "outlier_count": lambda c: F.count_if(tests.get(c, F.lit(False))),
    })
    percent = F.coalesce(100.0 * F.try_divide(F.col("outlier_count"), F.col("non_null_count")), F.lit(0.0))
    return table.select("column", F.lit(method).alias("method"), "non_null_count", "outlier_count",
                        percent.alias("outlier_percent")).orderBy(F.desc("outlier_count"), F.desc("outlier_percent"),
                                                                  "column")


def numeric_stats(df: DataFrame, columns: list[str] | None = None, facts: Facts | None = None) -> DataFrame:
    """n, mean, population std, min and max per numeric column."""
    df = nan_to_null(df)
    columns = columns if columns is not None else numeric_columns(df)
    if columns and facts is None:
        facts = measure(df.select(*[col(c) for c in columns]))
    rows = [(c, *[f[c] for f in (facts.count, facts.mean, facts.std, facts.low, facts.high)]) for c in columns]
    return small_table(df.sparkSession, rows,
                       "column string, n bigint, mean double, std double, min double, max double")


def histogram(df: DataFrame, columns: list[str] | None = None, bins: int = 30, max_columns: int | None = None,
              facts: Facts | None = None) -> DataFrame:
    """(column, bin, lower, upper, count) over equal widths; empty bins included, the last one closed."""
    df = nan_to_null(df)
    columns, _ = capped(columns if columns is not None else numeric_columns(df), max_columns, "Distributions")
    if columns and facts is None:
        facts = measure(df.select(*[col(c) for c in columns]))
    ends = {c: (facts.low[c], facts.high[c]) for c in columns if facts.count[c]}
    bounds = {c: (lo, hi) if lo < hi else (lo - 0.5, hi + 0.5) for c, (lo, hi) in ends.items()}
    if not bounds:
        return small_table(df.sparkSession, 
            [], "column string, bin int, lower double, upper double, count bigint")

    def place(c: str) -> Column:
        lo, hi = bounds[c]
        at = F.floor((col(c).cast("double") - F.lit(lo)) / F.lit(hi - lo) * F.lit(float(bins)))
        return F.when(at < bins, at).when(at.isNotNull(), F.lit(bins - 1)).cast("int")  # `least` would skip NULL

    placed = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), place(c).alias("bin")) for c in bounds]))).where("bin is not null")
    counts = placed.groupBy("column", "bin").agg(F.count("*").alias("count"))
    grid = small_table(df.sparkSession, 
        [(c, b, lo + (hi - lo) / bins * b, lo + (hi - lo) / bins * (b + 1))
         for c, (lo, hi) in bounds.items() for b in range(bins)],
        "column string, bin int, lower double, upper double")
    return F.broadcast(grid).join(counts, ["column", "bin"], "left").fillna({"count": 0})


def category_counts(df: DataFrame, columns: list[str], top: int | None = 50) -> DataFrame:
    """(column, value, count, n) and, with a limit, rank: values as text, missing as 'nan', n the table's rows."""
    counts = value_counts(df, columns).withColumn("value", F.coalesce("value", F.lit("nan")))
    merged = counts.groupBy("column", "value").agg(F.sum("count").alias("count"))
    n = merged.groupBy("column").agg(F.sum("count").alias("n"))  # one row per column
    return (merged if top is None else top_values(merged, top)).join(F.broadcast(n), "column")


def convertible_fractions(df: DataFrame) -> DataFrame:
    """Share of rows whose text is a number, per column; an all-missing column has 0."""
    return per_column(df, df.columns, {
        "convertible": lambda c: F.coalesce(
            F.try_divide(F.count(text_to_number(col(c))), F.count(col(c))), F.lit(0.0))}).drop("position")


def box_stats(df: DataFrame, columns: list[str] | None = None, multiplier: float = 1.5) -> DataFrame:
    """Five numbers and the whiskers: the outermost values inside the fences."""
    df = nan_to_null(df)
    columns = columns or numeric_columns(df)
    five = {c: q for c, q in exact_quantiles(df, {c: [0.0, 0.25, 0.5, 0.75, 1.0] for c in columns}).items()
            if q[0] is not None}

    if not five:
        return small_table(df.sparkSession, [], "column string, min double, q1 double, median double, q3 double, "
                                                "max double, whisker_low double, whisker_high double")

    def fence(c: str, side: int) -> float:
        _, q1, _, q3, _ = five[c]
        return q1 - multiplier * (q3 - q1) if side < 0 else q3 + multiplier * (q3 - q1)

    return per_column(df, list(five), {
        **{name: (lambda c, k=k: F.lit(five[c][k])) for k, name in enumerate(("min", "q1", "median", "q3", "max"))},
        "whisker_low": lambda c: F.min(F.when(col(c) >= F.lit(fence(c, -1)), col(c))).cast("double"),
        "whisker_high": lambda c: F.max(F.when(col(c) <= F.lit(fence(c, 1)), col(c))).cast("double"),
    }).drop("position")


def column_summary(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Count, mean, sample std, min, quartiles and max per numeric column."""
    df = nan_to_null(df)
    columns = columns or numeric_columns(df)
    if not columns:
        return small_table(df.sparkSession, [], "column string, count bigint, mean double, std double, min double, "
                                                "q1 double, median double, q3 double, max double")
    quartiles = exact_quantiles(df, {c: [0.25, 0.5, 0.75] for c in columns})
    return per_column(df, columns, {
        "count": lambda c: F.count(col(c)),
        "mean": lambda c: F.avg(col(c)).cast("double"),
        "std": lambda c: F.stddev_samp(col(c)),
        "min": lambda c: F.min(col(c)).cast("double"),
        **{q: (lambda c, k=k: F.lit(quartiles[c][k]).cast("double")) for k, q in enumerate(("q1", "median", "q3"))},
        "max": lambda c: F.max(col(c)).cast("double"),
    }).drop("position")


def kde(df: DataFrame, column: str, grid_points: int = 50, bins: int = 200) -> DataFrame:
    """(x, density): Gaussian kernel density with Scott's bandwidth over binned counts.

    Only the bins, whose number is fixed, meet the grid.
    """
    df = nan_to_null(df)
    facts = measure(df.select(col(column)))
    n = facts.count[column]
    if n < 2 or not facts.std[column]:
        return small_table(df.sparkSession, [], "x double, density double")
    width = facts.std[column] * math.sqrt(n / (n - 1)) * n ** (-0.2)
    lo, hi = facts.low[column], facts.high[column]
    cells = histogram(df, [column], bins, facts=facts).select(((F.col("lower") + F.col("upper")) / 2).alias("c"), "count")
    grid = F.array(*[F.lit(lo + (hi - lo) * i / (grid_points - 1)) for i in range(grid_points)])
    z = (F.col("x") - F.col("c")) / F.lit(width)
    weight = F.col("count") * F.exp(-z * z / 2) / F.lit(n * width * 2.5066282746310002)
    return cells.select("c", "count", F.explode(grid).alias("x")).groupBy("x").agg(F.sum(weight).alias("density"))


def profile(df: DataFrame, target: str | None = None, declared: dict[str, str] | None = None,
            correlation_method: str = "pearson", outlier_method: str = "iqr", bins: int = 30, iqr_multiplier: float = 1.5,
            zscore_threshold: float = 3.0, max_corr_features: int | None = None, max_columns: int | None = None,
            distribution_columns: list[str] | None = None) -> dict[str, DataFrame | list]:
    """All profile tables of one dataset, with the warnings. One pass supplies the figures they share.

    Without limits every column is looked at; what a given limit leaves out is named in the warnings. `distribution_columns`
    chooses the columns of histograms, statistics and category counts.
    """
    df = nan_to_null(df)
    facts = measure(df)
    types = resolve_profile_types(df, declared, target)
    stored = {f.name: f.dataType for f in df.schema}
    numeric = [c for c, t in types.items() if t == "numeric"]
    categorical = [c for c, t in types.items() if t == "categorical"]
    # with no column typed numeric, correlations and outliers fall back to what is stored as numbers
    measured = [c for c in (numeric or types) if is_numeric(stored[c])]
    shown, counted = numeric, categorical
    if distribution_columns is not None:
        shown, counted = ([c for c in cs if c in distribution_columns] for cs in (numeric, categorical))
    correlated, warnings = capped(measured, max_corr_features, "Correlation")
    for columns, what in ((measured, "Outlier scan"), (shown, "Numeric distributions"), (counted, "Categorical distributions")):
        warnings += capped(columns, max_columns, what)[1]
    if not numeric:
        warnings.append("No column is typed numeric: correlations and outliers take what is stored as numbers, histograms are empty.")
    shown = [c for c in capped(shown, max_columns, "")[0] if is_numeric(stored[c])]
    features = df.select(*[col(c) for c in correlated]) if correlated else df.select()
    return {
        "warnings": warnings, "numeric_columns": numeric, "categorical_columns": categorical,
        "missing": missing_values(df, facts),
        "correlations": correlations(features, correlation_method, facts=facts),
        "outliers": outliers(df, outlier_method, iqr_multiplier, zscore_threshold, measured, max_columns, facts),
        "histograms": histogram(df, shown, bins, facts=facts),
        "numeric_stats": numeric_stats(df, shown, facts),
        "category_counts": category_counts(df, capped(counted, max_columns, "")[0]),
    }
