"""Scoring new data with a fitted preparation and classifier."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from tabwright.functions.exprs import col, coerce_value
from tabwright.operators.classify import Classifier
from tabwright.operators.counts import per_column
from tabwright.operators.prep import Preparation
from tabwright.operators.table import remap_values
from tabwright.sources.local import small_table


def scoring_frame(df: DataFrame, wanted: list[str], target: str, numeric: list[str], keep: list[str],
                  value_maps: dict | None = None, types: dict | None = None) -> DataFrame:
    """`keep` and the wanted columns in training order; absent ones are NULL, others are dropped."""
    df = remap_values(df, value_maps or {}, types or {})
    df = df.drop(target) if target not in keep else df
    missing = lambda c: F.lit(None).cast("double" if c in numeric else "string").alias(c)
    return df.select(*[col(k) for k in keep], *[col(c) if c in df.columns else missing(c) for c in wanted])


def scoring_columns(df: DataFrame, wanted: list[str], target: str, keep: list[str] | None = None) -> DataFrame:
    """(column, status, non_null): which columns are found, missing or extra."""
    present = [c for c in df.columns if c != target and c not in (keep or [])]
    status = {**{c: "found" if c in present else "missing" for c in wanted},
              **{c: "extra" for c in present if c not in wanted}}
    names = F.broadcast(small_table(df.sparkSession, list(status.items()), "column string, status string"))
    if not present:
        return names.withColumn("non_null", F.lit(None).cast("bigint"))
    counts = per_column(df, present, {"non_null": lambda c: F.count(col(c))}).drop("position")
    return names.join(counts, "column", "left")


@dataclass
class Scorer:
    """Everything that turns raw rows into predictions."""

    preparation: Preparation
    model: Classifier
    value_maps: dict = field(default_factory=dict)
    types: dict = field(default_factory=dict)

    def frame(self, df: DataFrame, keep: list[str]) -> DataFrame:
        p = self.preparation
        wanted = list(dict.fromkeys(p.input_columns() + p.numeric + p.categorical))
        return scoring_frame(df, wanted, p.config.target, p.numeric, keep, self.value_maps, self.types)

    def score(self, df: DataFrame, keep: list[str] | None = None) -> DataFrame:
        """Row key, `prediction` and `proba_<class>` columns."""
        keep = keep or [self.model.key]
        ready = self.preparation.transform(self.frame(df, keep), keep)
        return self.model.probability_columns(self.model.score(ready))

    def score_one(self, spark: SparkSession, values: dict[str, str | None]) -> DataFrame:
        """One sample typed in as text: blanks and unreadable numbers count as missing."""
        p = self.preparation
        wanted = p.input_columns()
        raw = small_table(spark, [(0, *[values.get(c) for c in wanted])],
                          ", ".join([f"`{self.model.key}` bigint", *[f"`{c}` string" for c in wanted]]))
        typed = raw.select(col(self.model.key),
                           *[coerce_value(col(c), c in p.numeric).alias(c) for c in wanted])
        return self.score(typed)

    def save(self, spark: SparkSession, path: str) -> None:
        self.preparation.save(spark, f"{path}/preparation")
        self.model.save(spark, f"{path}/classifier")

    @classmethod
    def load(cls, spark: SparkSession, path: str, value_maps: dict | None = None, types: dict | None = None) -> Scorer:
        return cls(Preparation.load(spark, f"{path}/preparation"), Classifier.load(spark, f"{path}/classifier"),
                   value_maps or {}, types or {})
