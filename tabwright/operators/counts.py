"""Value counts of many columns in one shuffle: the kernel under most profile and quality operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tabwright.functions.exprs import col, is_fractional
from tabwright.sources.local import small_table


def long_text(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value) rows with values as text."""
    return df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), col(c).cast("string").alias("value")) for c in columns
    ])))


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value, count), missing values included.

    Keyed by column and value and combined before the shuffle, so a frequent value costs one row per task.
    """
    if not columns:
        return small_table(df.sparkSession, [], "column string, value string, count bigint")
    return long_text(df, columns).groupBy("column", "value").agg(F.count("*").alias("count"))


def _family(dt: T.DataType) -> str:
    return "double" if is_fractional(dt) else "bigint" if isinstance(dt, T.IntegralType) else "string"


def distinct_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, n_unique) without missing values, from one scan and one shuffle of combined values.

    A value travels in the field of its type family, so 64-bit integers stay exact and numbers need no text.
    """
    family = {f.name: _family(f.dataType) for f in df.schema if f.name in columns}
    if not family:
        return small_table(df.sparkSession, [], "column string, n_unique bigint")
    kinds = sorted(set(family.values()))

    def cell(c: str) -> Column:
        value = col(c).cast(family[c]) + F.lit(0.0) if family[c] == "double" else col(c).cast(family[c])
        return F.struct(F.lit(c).alias("column"),
                        *[(value if k == family[c] else F.lit(None).cast(k)).alias(k) for k in kinds])

    cells = df.select(F.inline(F.array(*[cell(c) for c in family])))
    present = cells.where(" or ".join(f"{k} is not null" for k in kinds))
    distinct = present.groupBy("column", *kinds).agg(F.lit(1).alias("_one"))
    return distinct.groupBy("column").agg(F.count("*").alias("n_unique"))


def _few_batches(limits: list[int]):
    """Per column the distinct values of a task, as text, or one mark (null) as soon as there are more than its limit."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: list[pa.Array | None] = [None] * len(limits)
        full = [False] * len(limits)
        for batch in batches:
            for i, limit in enumerate(limits):
                if not full[i]:
                    values = pc.drop_null(pc.unique(batch.column(i)))
                    if pa.types.is_floating(values.type):
                        values = pc.add(values, pa.scalar(0.0, values.type))  # no negative zero
                    seen[i] = pc.unique(values if seen[i] is None else pa.concat_arrays([seen[i], values]))
                    full[i] = len(seen[i]) > limit
        for i, values in enumerate(seen):
            if values is not None:
                text = pa.nulls(1, pa.string()) if full[i] else pc.cast(values, pa.string())
                yield pa.RecordBatch.from_arrays([pa.array([i] * len(text), pa.int32()), text], names=["at", "value"])
    return run


def few_distinct(df: DataFrame, limits: dict[str, int]) -> DataFrame:
    """(column, n_unique): distinct values without missing ones, exact up to the column's limit, NULL beyond it.

    A task gives up on a column as soon as it has seen more, so at most `limit` values per task and column are shuffled.
    """
    if not limits:
        return small_table(df.sparkSession, [], "column string, n_unique bigint")
    found = df.select(*[col(c) for c in limits]).mapInArrow(_few_batches(list(limits.values())), "at int, value string")
    per = found.groupBy("at", "value").agg(F.lit(1).alias("_one")).groupBy("at").agg(F.count("value").alias("n"), F.count_if(F.col("value").isNull()).alias("full"))
    names = F.broadcast(small_table(df.sparkSession, [(i, c, m) for i, (c, m) in enumerate(limits.items())], "at int, column string, most bigint"))
    n = F.coalesce("n", F.lit(0))
    whole = F.when((F.coalesce("full", F.lit(0)) == 0) & (n <= F.col("most")), n)
    return names.join(per, "at", "left").select("column", whole.alias("n_unique"))


def top_values(counts: DataFrame, n: int) -> DataFrame:
    """The n most frequent values per column with their rank; ties go to the smaller value.

    The rank filter lets Spark keep n rows per column in every task before the shuffle.
    """
    w = Window.partitionBy("column").orderBy(F.desc("count"), F.asc("value"))
    ranked = counts.withColumn("rank", F.row_number().over(w))
    return ranked.where(F.col("rank") <= n)


def per_column(df: DataFrame, columns: list[str], measures: dict[str, object], extra: dict[str, Column] | None = None
               ) -> DataFrame:
    """One wide aggregate over the table, turned into one row per column.

    `measures` maps an output name to a function from column name to aggregate expression;
    `extra` holds table-wide aggregates repeated on every row.
    """
    aggs = [fn(c).alias(f"{name}_{i}") for i, c in enumerate(columns) for name, fn in measures.items()]
    aggs += [expr.alias(name) for name, expr in (extra or {}).items()]
    wide = df.agg(*aggs)
    return wide.select(*(extra or {}), F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(i).alias("position"),
                 *[F.col(f"{name}_{i}").alias(name) for name in measures])
        for i, c in enumerate(columns)
    ])))
