"""Data-quality rules, with thresholds estimated from the data."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window, functions as F, types as T

from tabwright.functions.exprs import col, is_date_text, is_numeric, nan_to_null, row_hash, text_to_number
from tabwright.operators.coltypes import class_distribution
from tabwright.operators.counts import distinct_counts, per_column, value_counts
from tabwright.operators.profile import high_missing
from tabwright.operators.table import capped, require
from tabwright.sources.local import small_table


def imbalance(df: DataFrame, target: str, min_share: float = 0.20, min_ratio: float = 0.50) -> DataFrame:
    """One row: is the smallest class too small, alone or against the largest? Missing targets only count."""
    require(df, [target], "Target column")
    counts = df.groupBy(col(target).alias("class")).agg(F.count("*").alias("count"))
    known = F.when(F.col("class").isNotNull(), F.col("count"))
    facts = counts.agg(
        F.coalesce(F.sum(F.when(F.col("class").isNull(), F.col("count"))), F.lit(0)).alias("missing_target_count"),
        (F.min(known) / F.sum(known)).alias("min_class_proportion"),
        (F.max(known) / F.sum(known)).alias("max_class_proportion"))
    ratio = F.col("min_class_proportion") / F.col("max_class_proportion")
    flag = (F.col("min_class_proportion") < min_share) | (ratio < min_ratio)
    return facts.withColumns({
        "imbalance_ratio": ratio,
        "is_imbalanced": F.coalesce(flag, F.lit(False)),
        "reason": F.when(ratio.isNull(), f"{target} is missing in every row.").otherwise(""),
    })


def imbalance_distribution(df: DataFrame, target: str) -> DataFrame:
    return class_distribution(df, target, dropna=True).orderBy(F.desc("count"), "class")


def categorical_scope(df: DataFrame, types: dict[str, str] | None, target: str | None) -> list[str]:
    """Declared categorical columns, else text columns; never the target."""
    if types:
        return [c for c, t in types.items() if t == "categorical" and c in df.columns and c != target]
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType) and f.name != target]


def high_cardinality(df: DataFrame, types: dict[str, str] | None = None, target: str | None = None,
                     threshold: int = 50, max_columns: int | None = None) -> DataFrame:
    """Categorical columns with more distinct values than the threshold, with their extremes.

    One shuffle of combined counts by column and value serves every figure.
    """
    columns, _ = capped(categorical_scope(df, types, target), max_columns, "High cardinality")
    counts = value_counts(nan_to_null(df), columns)
    shown = F.coalesce("value", F.lit("nan"))
    facts = counts.groupBy("column").agg(
        F.count("value").alias("unique_values"),
        F.min_by(F.struct(shown.alias("value"), "count"), F.struct(-F.col("count"), shown)).alias("top"),
        F.min_by(F.struct(shown.alias("value"), "count"), F.struct(F.col("count"), shown)).alias("bottom"),
        F.sum("count").alias("n"))
    flagged = facts.where(F.col("unique_values") > threshold)
    # missing values come last, so that the ranking reads the same exchange of counts as the figures
    w = Window.partitionBy("column").orderBy(F.asc_nulls_last("value"))
    samples = (counts.withColumn("at", F.row_number().over(w)).where("at <= 5 and value is not null")
               .groupBy("column").agg(F.array_join(F.sort_array(F.collect_list("value")), ", ").alias("sample_values")))
    share = lambda c: 100.0 * c / F.col("n")
    return flagged.join(samples, "column").select(
        "column", "unique_values", share(F.col("unique_values")).alias("unique_percent"),
        F.col("top.value").alias("top_value"), F.col("top.count").alias("top_count"),
        share(F.col("top.count")).alias("top_percent"),
        F.col("bottom.value").alias("bottom_value"), F.col("bottom.count").alias("bottom_count"),
        share(F.col("bottom.count")).alias("bottom_percent"), "sample_values",
    ).orderBy(F.desc("unique_values"), F.desc("unique_percent"), "column")


def hash_sample(df: DataFrame, ids: list[str], n: int = 5000, seed: int = 42) -> DataFrame:
    """n rows in hash order of their key: a sample that is the same under any plan."""
    return df.withColumn("_h", row_hash(ids, seed)).orderBy("_h", *[col(i) for i in ids]).limit(n).drop("_h")


def type_mismatch(df: DataFrame, types: dict[str, str] | None = None, target: str | None = None,
                  threshold: float = 0.90, ids: list[str] | None = None, sample_size: int | None = None) -> DataFrame:
    """Columns whose values contradict their declared or stored type.

    Scans every row; pass `ids` and `sample_size` to judge a sample instead.
    """
    types = types or {}
    df = nan_to_null(df)
    if sample_size and ids:
        df = hash_sample(df, ids, sample_size)
    stored = {f.name: f.dataType for f in df.schema}
    columns = [c for c in df.columns if c != target]

    def share(test):
        return lambda c: F.try_divide(F.count_if(test(c)), F.count(col(c)))

    table = per_column(df, columns, {
        "non_null": lambda c: F.count(col(c)),
        "numeric_fraction": share(lambda c: text_to_number(col(c)).isNotNull()),
        "datetime_fraction": share(lambda c: is_date_text(col(c)) if isinstance(stored[c], T.StringType)
                                   else F.lit(isinstance(stored[c], (T.TimestampType, T.DateType)))),
    }).where("non_null > 0")
    pick = lambda f: F.create_map(*[F.lit(x) for c in columns for x in (c, f(c))])[F.col("column")]
    declared = pick(lambda c: types.get(c, "unknown"))
    number = pick(lambda c: is_numeric(stored[c]) or isinstance(stored[c], T.BooleanType))
    date = pick(lambda c: isinstance(stored[c], (T.TimestampType, T.DateType)))
    nf, df_ = F.col("numeric_fraction"), F.col("datetime_fraction")
    numeric_like, open_type = nf >= threshold, ~declared.isin("numeric", "categorical")
    rules = [
        ((declared == "numeric") & ~number & numeric_like, "declared_numeric_string_values", nf),
        ((declared == "numeric") & ~number, "declared_numeric_mixed_types", 1.0 - nf),
        ((declared == "categorical") & number & numeric_like, "categorical_as_numeric_dtype", nf),
        ((declared == "categorical") & numeric_like, "categorical_looks_numeric", nf),
        (open_type & numeric_like & ~number, "numeric_like_strings", nf),
        (open_type & (df_ >= threshold) & ~date, "datetime_like_strings", df_),
    ]
    issue, confidence = F.lit(None).cast("string"), F.lit(None).cast("double")
    for test, name, value in reversed(rules):
        issue, confidence = F.when(test, name).otherwise(issue), F.when(test, value).otherwise(confidence)
    return table.select("column", declared.alias("declared_type"), issue.alias("issue_type"), "numeric_fraction",
                        "datetime_fraction", confidence.alias("confidence")
                        ).where("issue_type is not null").orderBy(F.desc("confidence"), "column")


def _quantile(values: list[float], q: float, empty: float) -> float:
    """Linear quantile of a short list with one entry per column."""
    if not values:
        return empty
    values = sorted(values)
    at = q * (len(values) - 1)
    low = math.floor(at)
    high = min(low + 1, len(values) - 1)
    return values[low] + (values[high] - values[low]) * (at - low)


def estimate_thresholds(df: DataFrame, target: str | None = None, types: dict[str, str] | None = None) -> dict:
    """Starting values for the quality rules. Spark reduces the rows; one figure per column comes back."""
    df = nan_to_null(df)
    per = per_column(df, df.columns, {
        "filled": lambda c: F.count(col(c)), "numbers": lambda c: F.count(text_to_number(col(c))),
    }, {"n_rows": F.count("*")}).collect()  # a row per column
    n = max(per[0]["n_rows"], 1)
    rates = [(r["n_rows"] - r["filled"]) / n for r in per]
    convertible = [r["numbers"] / r["filled"] if r["filled"] else 0.0 for r in per]
    columns = categorical_scope(df, types, target)
    ratios = [r["n_unique"] / n for r in distinct_counts(df, columns).collect()] if columns else []
    ratios += [0.0] * (len(columns) - len(ratios))
    low = smallest = largest = None
    if target is not None and target in df.columns:
        row = class_distribution(df, target).agg(
            F.percentile("proportion", F.lit(0.05)).alias("low"), F.min("proportion").alias("min"),
            F.max("proportion").alias("max")).first()
        low, smallest, largest = row["low"], row["min"], row["max"]
    ratio = smallest / largest if smallest and largest else 1.0
    mean = sum(rates) / len(rates)
    upper = _quantile(rates, 0.75, 1.0)
    if len(rates) > 1:
        upper = min(upper, mean + math.sqrt(sum((r - mean) ** 2 for r in rates) / (len(rates) - 1)))
    cardinality = min(50, n) if not columns else int(min(_quantile(ratios, 0.90, 0.0), 0.95) * n)
    return {
        "min_class_proportion": round(min(max(low or 0.0, 2 / n), 0.4), 3),
        "imbalance_ratio": round(max(min(0.8 * ratio, 0.9), 0.1), 2),
        "missingness_threshold_pct": round(upper * 100.0, 1),
        "high_cardinality_threshold": max(2, cardinality),
        "datatype_mismatch_threshold": round(max(_quantile(convertible, 0.10, 0.0), 0.8), 2),
    }


def thresholds_table(df: DataFrame, target: str | None = None, types: dict[str, str] | None = None) -> DataFrame:
    found = estimate_thresholds(df, target, types)
    return small_table(df.sparkSession, [(k, float(v)) for k, v in found.items()], "name string, value double")


def issues(df: DataFrame, target: str, types: dict[str, str] | None = None, thresholds: dict | None = None) -> DataFrame:
    """(issue, subject, detail, value): every rule with the estimated thresholds, or given ones."""
    df = nan_to_null(df)
    t = thresholds or estimate_thresholds(df, target, types)
    flag = imbalance(df, target, t["min_class_proportion"], t["imbalance_ratio"]).where("is_imbalanced").select(
        F.lit("class_imbalance").alias("issue"), F.lit(target).alias("subject"),
        F.lit("imbalance_ratio").alias("detail"), F.col("imbalance_ratio").alias("value"))
    wide = high_cardinality(df, types, target, t["high_cardinality_threshold"]).select(
        F.lit("high_cardinality"), "column", "top_value", F.col("unique_values").cast("double"))
    mismatch = type_mismatch(df, types, target, t["datatype_mismatch_threshold"]).select(
        F.lit("datatype_mismatch"), "column", "issue_type", "confidence")
    gaps = high_missing(df, t["missingness_threshold_pct"]).select(
        F.lit("high_missingness"), "column", F.lit("missing_percent"), "missing_percent")
    return flag.unionAll(wide).unionAll(mismatch).unionAll(gaps)


def schema_violations(df: DataFrame, expected: dict[str, str]) -> DataFrame:
    """(column, status, expected, actual, non_null): absent, unexpected or differently typed columns."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema}
    rows = [(c, "missing", t, None) for c, t in expected.items() if c not in actual]
    rows += [(c, "type_mismatch", t, actual[c]) for c, t in expected.items() if c in actual and actual[c] != t]
    rows += [(c, "unexpected", None, t) for c, t in actual.items() if c not in expected]
    table = small_table(df.sparkSession, rows, "column string, status string, expected string, actual string")
    present = [r[0] for r in rows if r[0] in actual]
    if not present:
        return table.withColumn("non_null", F.lit(None).cast("bigint"))
    counts = per_column(df, present, {"non_null": lambda c: F.count(col(c))}).drop("position")
    return F.broadcast(table).join(counts, "column", "left")


def range_violations(df: DataFrame, ranges: dict[str, tuple[float | None, float | None]]) -> DataFrame:
    """(column, below, above, total): rows outside the given bounds; None leaves a side open."""
    def side(c: str, k: int):
        bound = ranges[c][k]
        if bound is None:
            return F.lit(False)
        return col(c) < F.lit(bound) if k == 0 else col(c) > F.lit(bound)

    return per_column(nan_to_null(df), list(ranges), {
        "below": lambda c: F.count_if(side(c, 0)), "above": lambda c: F.count_if(side(c, 1)),
        "total": lambda c: F.count(col(c)),
    }).drop("position")


def clean_column_names(df: DataFrame) -> DataFrame:
    """Names of letters, digits and underscores; a repeated name gets a number."""
    import re

    seen: dict[str, int] = {}
    names = []
    for c in df.columns:
        base = re.sub(r"[^A-Za-z0-9_]+", "_", c) or "_"
        name = base
        while name in seen:
            seen[base] += 1
            name = f"{base}_{seen[base]}"
        seen.setdefault(name, 0)
        names.append(name)
    return df.toDF(*names)
