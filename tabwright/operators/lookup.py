"""Left lookup of a keyed table that stays balanced when one key holds most rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tabwright.functions.exprs import col

SMALL_TABLE_ROWS = 50_000
HOT_SHARE = 0.001  # a key above this share of all rows is hot, so there are at most 1000 of them


def left_lookup(facts: DataFrame, table: DataFrame, key: str, value: str, weight: str,
                table_rows: int, fact_rows: int) -> DataFrame:
    """`facts` plus `value`, found by `key`; `weight` is the key's row count and `table_rows` the table's size.

    Small table: broadcast. Large table: broadcast only the hot keys, whose number the share
    bounds, and shuffle the rest. Rows that need no shuffle partner carry a NULL key and a salt,
    so that they spread evenly instead of meeting in one task.
    """
    right = table.select(col(key).alias("_k"), col(value).alias(value))
    if table_rows <= SMALL_TABLE_ROWS:
        return facts.join(F.broadcast(right), col(key).eqNullSafe(F.col("_k")), "left").drop("_k")
    is_hot = F.col(weight) > F.lit(int(fact_rows * HOT_SHARE))
    hot = table.where(is_hot).select(col(key).alias("_hk"), F.col(value).alias("_hv"))
    cold = table.where(~is_hot).select(col(key).alias("_k"), F.col(value).alias("_cv"), F.lit(0).alias("_s"))
    matched = facts.join(F.broadcast(hot), col(key) == F.col("_hk"), "left")
    idle = F.col("_hk").isNotNull() | col(key).isNull()
    salted = matched.withColumns({
        "_fk": F.when(~idle, col(key)),
        "_fs": F.when(idle, F.pmod(F.xxhash64(*[col(c) for c in facts.columns]), F.lit(4096)).cast("int") + 1)
               .otherwise(0),
    })
    joined = salted.join(cold, (F.col("_fk") == F.col("_k")) & (F.col("_fs") == F.col("_s")), "left")
    return joined.select(*[col(c) for c in facts.columns], F.coalesce("_hv", "_cv").alias(value))
