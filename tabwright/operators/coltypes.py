"""Semantic column types, classification targets and class distributions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from tabwright.functions.exprs import col, is_fractional, is_numeric, near_integer
from tabwright.operators.counts import distinct_counts, few_distinct, per_column
from tabwright.operators.table import require
from tabwright.sources.local import small_table

MAX_CLASSES = 200


def column_facts(df: DataFrame, columns: list[str] | None = None, limits: dict[str, int] | None = None) -> DataFrame:
    """Per column: type, rows, non-null rows, distinct values, integer tests.

    With `limits`, distinct values of the columns named are counted exactly up to their limit and are NULL beyond; those of others are NULL.
    """
    columns = columns or df.columns
    fields = {f.name: f.dataType for f in df.schema}

    def whole(c: str):
        v = col(c).cast("double")
        return F.coalesce(F.bool_and(v == F.rint(v)), F.lit(True)) if is_numeric(fields[c]) else F.lit(False)

    def near(c: str):
        v = col(c).cast("double")
        return F.coalesce(F.bool_and(near_integer(v)), F.lit(False)) if is_fractional(fields[c]) else F.lit(False)

    def kind(c: str) -> str:
        dt = fields[c]
        if isinstance(dt, T.BooleanType):
            return "bool"
        if isinstance(dt, T.IntegralType):
            return "int"
        if is_numeric(dt):
            return "float"
        return "text" if isinstance(dt, T.StringType) else "other"

    facts = per_column(df, columns, {
        "non_null": lambda c: F.count(col(c)), "whole": whole, "near_whole": near,
    }, {"n_rows": F.count("*")})
    kinds = F.create_map(*[F.lit(x) for c in columns for x in (c, kind(c))])
    facts = facts.withColumn("kind", kinds[F.col("column")])
    if limits is not None:
        return facts.join(few_distinct(df, {c: limits[c] for c in columns if c in limits}), "column", "left")
    return facts.join(distinct_counts(df, columns), "column", "left").fillna({"n_unique": 0})


def _decided(df: DataFrame, columns: list[str], most: int, share: float, whole_only: bool) -> DataFrame:
    """Facts with distinct values counted as far as a type depends on them: up to `most`, beyond only where the share of rows decides.

    Only numbers are looked at, and of those beyond `most` only columns whose rows could hold that many values: share * rows > most.
    """
    fields = {f.name: f.dataType for f in df.schema}
    numbers = [c for c in columns if is_numeric(fields[c])]
    facts = column_facts(df, columns, dict.fromkeys(numbers, most))
    rows = facts.select("column", "n_rows", "non_null", "whole", "n_unique").where(F.col("column").isin(numbers)).collect()
    open_columns = [r["column"] for r in rows if r["n_unique"] is None and share * r["n_rows"] > most and (r["whole"] or not whole_only)]
    counted = distinct_counts(df, open_columns).withColumnRenamed("n_unique", "_counted")
    return facts.join(counted, "column", "left").withColumn("n_unique", F.coalesce("n_unique", "_counted")).drop("_counted")


def _unique_ratio():
    return F.col("n_unique") / F.greatest(F.col("n_rows"), F.lit(1))


def upload_types(df: DataFrame, unique_threshold: int = 5, ratio_threshold: float = 0.005, counts: bool = True) -> DataFrame:
    """Few distinct values make a numeric column categorical; other types always are.

    Without `counts`, n_unique is NULL where the type does not depend on it, and no text is shuffled.
    """
    few = (F.col("n_unique") <= unique_threshold) | (_unique_ratio() <= ratio_threshold)
    numeric = F.col("kind").isin("int", "float") & ~F.coalesce(few, F.lit(False))
    facts = column_facts(df) if counts else _decided(df, df.columns, unique_threshold, ratio_threshold, False)
    return facts.select("column", "position", "n_unique", F.when(numeric, "numeric").otherwise("categorical").alias("type"))


def profile_types(df: DataFrame, target: str | None = None, max_unique: int = 20, unique_share: float = 0.10, counts: bool = True
                  ) -> DataFrame:
    """Whole numbers with few distinct values are categorical; the target is left out. `counts` as in `upload_types`."""
    few = (F.col("n_unique") <= max_unique) | (_unique_ratio() <= unique_share)
    numeric = F.col("kind").isin("int", "float") & ~(F.col("whole") & F.coalesce(few, F.lit(False)))
    columns = [c for c in df.columns if c != target]
    facts = column_facts(df, columns) if counts else _decided(df, columns, max_unique, unique_share, True)
    return facts.select("column", "position", "n_unique", F.when(numeric, "numeric").otherwise("categorical").alias("type"))


def dtype_types(df: DataFrame) -> dict[str, str]:
    """Type by storage alone."""
    return {f.name: "numeric" if is_numeric(f.dataType) else "categorical" for f in df.schema}


def declared_first(columns: list[str], declared: dict[str, str], inferred: dict[str, str]) -> dict[str, str]:
    """Declared types win; the rest is inferred and comes after them."""
    known = {c: declared[c] for c in columns if declared.get(c) in ("numeric", "categorical")}
    return {**known, **{c: inferred[c] for c in columns if c not in known and c in inferred}}


def resolve_types(df: DataFrame, declared: dict[str, str] | None = None) -> dict[str, str]:
    return declared_first(df.columns, declared or {}, dtype_types(df))


def resolve_profile_types(df: DataFrame, declared: dict[str, str] | None, target: str | None) -> dict[str, str]:
    """As `resolve_types`, with the profile rule for the undeclared columns only; what is no number needs no look at its values."""
    columns = [c for c in df.columns if c != target]
    open_columns = [c for c in columns if (declared or {}).get(c) not in ("numeric", "categorical")]
    inferred = {f.name: "categorical" for f in df.schema if f.name in open_columns}
    numbers = [f.name for f in df.schema if f.name in open_columns and is_numeric(f.dataType)]
    if numbers:
        rows = profile_types(df.select(*[col(c) for c in numbers]), counts=False).collect()
        inferred.update({r["column"]: r["type"] for r in rows})
    return declared_first(columns, declared or {}, inferred)


def types_table(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Resolved types in order, with each column's non-null rows."""
    names = list(types)
    roles = F.create_map(*[F.lit(x) for c in names for x in (c, types[c])])
    return per_column(df, names, {"non_null": lambda c: F.count(col(c))}).select(
        "column", "position", "non_null", roles[F.col("column")].alias("type"))


def _is_candidate(max_classes: int):
    few = F.col("n_unique") <= max_classes
    return (F.col("n_unique") >= 2) & (
        F.col("kind").isin("bool", "text") | ((F.col("kind") == "int") & few)
        | ((F.col("kind") == "float") & few & F.col("near_whole")))


def target_candidates(df: DataFrame, max_classes: int = MAX_CLASSES, counts: bool = True) -> DataFrame:
    """Columns that can be a target. Without `counts`, n_unique is exact up to `max_classes` and NULL beyond."""
    if counts:
        return column_facts(df).where(_is_candidate(max_classes)).select("column", "position", "kind", "n_unique")
    facts = column_facts(df, limits=dict.fromkeys(df.columns, max_classes)).withColumn("_n", F.col("n_unique"))
    more = facts.withColumn("n_unique", F.coalesce("n_unique", F.lit(max_classes + 1)))
    return more.where(_is_candidate(max_classes)).select("column", "position", "kind", F.col("_n").alias("n_unique"))


def integer_like(df: DataFrame) -> DataFrame:
    """Which fractional columns hold whole numbers within tolerance."""
    columns = [f.name for f in df.schema if is_fractional(f.dataType)]
    if not columns:
        return small_table(df.sparkSession, [], "column string, non_null bigint, near_whole boolean")
    return column_facts(df, columns).select("column", "non_null", "near_whole")


def validate_target(df: DataFrame, target: str, max_classes: int = MAX_CLASSES) -> DataFrame:
    """One row: usable or not, with the errors and warnings as text."""
    if target not in df.columns:
        return df.agg(F.lit(target).alias("target"), F.lit(False).alias("ok"),
                      F.lit(f"The table has no column {target}.").alias("errors"), F.lit("").alias("warnings"),
                      F.lit(0).cast("bigint").alias("n_classes"))
    facts = column_facts(df, [target])
    no_rows, single = F.col("n_rows") == 0, F.col("n_unique") < 2
    good = _is_candidate(max_classes)
    errors = (F.when(no_rows, "The table has no rows.")
              .when(single, F.format_string("%s has %d distinct values; two are needed.", F.lit(target), F.col("n_unique")))
              .when(~good, F.format_string("%s has %d distinct numbers or fractions, which are no classes.",
                                           F.lit(target), F.col("n_unique")))
              .otherwise(""))
    warnings = F.when(good & (F.col("n_unique") > 50),
                      F.format_string("%s has %d classes over %d rows.", F.lit(target),
                                      F.col("n_unique"), F.col("n_rows"))).otherwise("")
    return facts.select(F.col("column").alias("target"), (~no_rows & good).alias("ok"), errors.alias("errors"),
                        warnings.alias("warnings"), F.col("n_unique").alias("n_classes"))


def class_distribution(df: DataFrame, target: str, dropna: bool = False) -> DataFrame:
    """class, count, proportion; missing is a class of its own unless dropped."""
    require(df, [target], "Target column")
    rows = df.where(col(target).isNotNull()) if dropna else df
    counts = rows.groupBy(col(target).cast("string").alias("class")).agg(F.count("*").alias("count"))
    return counts.withColumn("proportion", F.col("count") / counts.agg(F.sum("count")).scalar())
