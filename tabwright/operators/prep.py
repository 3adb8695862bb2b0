"""Imputation, outlier capping, scaling and encoding: learned on the training rows, applied anywhere.

What is learned from numbers is a few constants per column. What is learned from categories is a
vocabulary table, kept as a table because nothing bounds its size.
"""

from __future__ import annotations

import json
import math
from dataclasses import asdict, dataclass, field

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructField, StructType

from tabwright.functions.exprs import col, is_numeric, nan_to_null
from tabwright.operators.coltypes import resolve_types
from tabwright.operators.counts import long_text
from tabwright.operators.lookup import SMALL_TABLE_ROWS, left_lookup
from tabwright.operators.ordered import exact_quantiles, running_totals
from tabwright.operators.profile import Facts, measure
from tabwright.operators.split import SEED, mark_test
from tabwright.operators.table import features_of, tabular
from tabwright.sources.local import small_table
from tabwright.sources.shared import durable

INLINE_CODES = 64      # vocabularies up to this size become part of the expression
WIDE_COLUMNS = 5_000   # most columns a named-column result may have


@dataclass(frozen=True)
class PrepConfig:
    target: str
    feature_columns: list[str] | None = None
    test_size: float = 0.2
    stratify: bool = True
    numeric_imputer: str = "mean"             # mean, median, most_frequent, constant
    categorical_imputer: str = "most_frequent"  # most_frequent, constant
    encoder: str = "onehot"                   # onehot, label
    scaler: str = "standard"                  # standard, minmax, none
    outlier_handling: str = "none"            # none, cap, remove
    iqr_multiplier: float = 1.5
    numeric_fill: float = 0.0
    categorical_fill: str = "missing"

    def __post_init__(self):
        for value, allowed in ((self.numeric_imputer, ("mean", "median", "most_frequent", "constant")),
                               (self.categorical_imputer, ("most_frequent", "constant")),
                               (self.encoder, ("onehot", "label")), (self.scaler, ("standard", "minmax", "none")),
                               (self.outlier_handling, ("none", "cap", "remove"))):
            if value not in allowed:
                raise ValueError(f"{value!r} is not one of {', '.join(allowed)}")


def numeric_modes(df: DataFrame, columns: list[str]) -> dict[str, float]:
    """Most frequent value per numeric column, the smallest on ties."""
    if not columns:
        return {}
    cells = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), col(c).cast("double").alias("value")) for c in columns])))
    counts = cells.where("value is not null").groupBy("column", "value").agg(F.count("*").alias("n"))
    best = counts.groupBy("column").agg(F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("mode"))
    return {r["column"]: r["mode"] for r in best.collect()}


def numeric_fills(df: DataFrame, columns: list[str], strategy: str, facts: Facts, constant: float = 0.0
                  ) -> dict[str, float]:
    """Replacement for missing values per column; a column without values has none and is left out."""
    if strategy == "most_frequent":
        return numeric_modes(df, columns)
    if strategy == "median":
        found = {c: q[0] for c, q in exact_quantiles(df, {c: [0.5] for c in columns}, counts=facts.count).items()}
    else:
        found = {c: constant if strategy == "constant" else facts.mean[c] for c in columns}
    return {c: v for c, v in found.items() if v is not None}


def filled_scale(facts: Facts, c: str, fill: float, scaler: str) -> tuple[float, float]:
    """(offset, divisor) of a column after its gaps are filled, worked out from the figures before."""
    n, gaps = facts.count[c], facts.rows - facts.count[c]
    if scaler == "minmax":
        ends = [v for v in (facts.low[c], facts.high[c], fill if gaps else None) if v is not None]
        return min(ends), max(ends) - min(ends)
    mean, std = facts.mean[c] or 0.0, facts.std[c] or 0.0
    centre = mean if not gaps or fill == mean else (n * mean + gaps * fill) / facts.rows
    variance = (n * (std ** 2 + (mean - centre) ** 2) + gaps * (fill - centre) ** 2) / max(facts.rows, 1)
    spread = math.sqrt(variance)
    return centre, 0.0 if spread <= 1e-13 * abs(centre) else spread  # rounding dust of a constant is no spread


def value_table(df: DataFrame, columns: list[str], numeric: list[str] | None = None) -> DataFrame:
    """(column, value, n, _order): distinct values with their counts, written to the shared folder.

    Counts are combined before the shuffle. Columns listed as `numeric` sort by number.
    """
    number = F.when(F.col("column").isin(numeric), F.col("value").try_cast("double")) if numeric else F.lit(None)
    counts = (long_text(df, columns).where("value is not null").groupBy("column", "value")
              .agg(F.count("*").alias("n"))
              .withColumn("_order", F.struct(number.cast("double").alias("number"), F.col("value").alias("text"))))
    return durable(counts, "values")


def vocabulary(values: DataFrame, rows: int) -> DataFrame:
    """(column, value, n, code): values numbered in sorted order within their column.

    A short table is numbered by a plain window, a long one by running totals over range partitions.
    """
    if rows <= SMALL_TABLE_ROWS:
        w = Window.partitionBy("column").orderBy("_order")
        return values.select("column", "value", "n", (F.row_number().over(w).cast("bigint") - 1).alias("code"))
    placed = running_totals(values.withColumn("_one", F.lit(1)), "_order", "_one", ["column"])
    return durable(placed.select("column", "value", "n", F.col("before").alias("code")), "vocabulary")


@dataclass
class Preparation:
    """A fitted chain: impute, cap, scale for numbers; impute, encode for categories."""

    numeric: list[str]
    categorical: list[str]
    config: PrepConfig
    fills: dict = field(default_factory=dict)
    caps: dict = field(default_factory=dict)
    scales: dict = field(default_factory=dict)   # column -> (offset, divisor); divisor 0 gives 0
    sizes: dict = field(default_factory=dict)    # column -> number of codes
    inline: dict = field(default_factory=dict)   # column -> values in code order, when few
    rows: int = 0
    vocab: DataFrame | None = None

    # --- learning

    @classmethod
    def fit(cls, train: DataFrame, config: PrepConfig, numeric: list[str], categorical: list[str]) -> Preparation:
        train = nan_to_null(tabular(train))
        facts = measure(train.select(*[col(c).cast("double").alias(c) for c in numeric])) if numeric else None
        fills = numeric_fills(train, numeric, config.numeric_imputer, facts, config.numeric_fill) if numeric else {}
        self = cls([c for c in numeric if c in fills], [], config, fills=fills)
        if config.outlier_handling == "cap" and self.numeric:
            filled = train.select(*[self.number(c).alias(c) for c in self.numeric])
            rows = {c: facts.rows for c in self.numeric}
            for c, (q1, q3) in exact_quantiles(filled, {c: [0.25, 0.75] for c in self.numeric}, counts=rows).items():
                reach = config.iqr_multiplier * (q3 - q1)
                self.caps[c] = (q1 - reach, q3 + reach)
            # capping changes the figures, so they are taken again
            facts = measure(train.select(*[self.number(c).alias(c) for c in self.numeric]))
        if config.scaler != "none":
            self.scales = {c: filled_scale(facts, c, fills[c], config.scaler) for c in self.numeric}
        if categorical:
            self._learn_categories(train, categorical)
        return self

    def _learn_categories(self, train: DataFrame, categorical: list[str]) -> None:
        texts = train.select(*[col(c) for c in categorical])
        constant = self.config.categorical_imputer == "constant"
        if constant:
            texts = texts.select(*[F.coalesce(col(c).cast("string"), F.lit(self.config.categorical_fill)).alias(c)
                                   for c in categorical])
        values = value_table(texts, categorical, [f.name for f in train.schema if is_numeric(f.dataType)])
        facts = values.groupBy("column").agg(
            F.count("*").alias("size"),
            F.sum("n").alias("rows"),
            F.min_by("value", F.struct(-F.col("n"), F.col("_order"))).alias("mode")).collect()  # a row per column
        self.rows = max((r["rows"] for r in facts), default=0)
        self.vocab = vocabulary(values, sum(r["size"] for r in facts))
        self.sizes = {r["column"]: r["size"] for r in facts}
        self.categorical = [c for c in categorical if c in self.sizes]
        for r in facts:
            self.fills[r["column"]] = self.config.categorical_fill if constant else r["mode"]
        few = [c for c in self.categorical if self.sizes[c] <= INLINE_CODES]
        if few:
            rows = self.vocab.where(F.col("column").isin(few)).orderBy("column", "code").collect()
            self.inline = {c: [r["value"] for r in rows if r["column"] == c] for c in few}

    # --- applying

    def number(self, c: str, scaled: bool = False) -> Column:
        v = F.coalesce(col(c).cast("double"), F.lit(float(self.fills[c])))
        if c in self.caps:
            low, high = self.caps[c]
            v = F.least(F.greatest(v, F.lit(low)), F.lit(high))
        if scaled and c in self.scales:
            offset, divisor = self.scales[c]
            v = (v - F.lit(offset)) / F.lit(divisor) if divisor else F.lit(0.0)
        return v

    def category(self, c: str) -> Column:
        return F.coalesce(col(c).cast("string"), F.lit(self.fills[c]))

    def encode(self, df: DataFrame, keep: list[str]) -> DataFrame:
        """`keep`, prepared numbers under their names, and per category its code (NULL when unknown)."""
        df = nan_to_null(df)
        out = df.select(*[col(k) for k in keep], *[self.number(c, scaled=True).alias(f"num_{c}") for c in self.numeric],
                        *[self.category(c).alias(f"cat_{c}") for c in self.categorical])
        few = {}
        for c in self.categorical:
            if c in self.inline:
                values = F.array(*[F.lit(v) for v in self.inline[c]])
                few[f"code_{c}"] = F.nullif(F.array_position(values, F.col(f"`cat_{c}`")), F.lit(0)) - 1
        out = out.withColumns(few) if few else out
        for c in self.categorical:
            if c not in self.inline:
                table = self.vocab.where(F.col("column") == c).select(
                    F.col("value").alias(f"cat_{c}"), F.col("code").alias(f"code_{c}"), "n")
                out = left_lookup(out, table, f"cat_{c}", f"code_{c}", "n", self.sizes[c], self.rows)
        return out

    def transform(self, df: DataFrame, keep: list[str], encoded: DataFrame | None = None) -> DataFrame:
        """`keep` and the feature vector, sparse where that is smaller."""
        out = encoded if encoded is not None else self.encode(df, keep)
        inputs = [f"num_{c}" for c in self.numeric]
        if self.config.encoder == "label":
            out = out.withColumns({f"code_{c}": F.coalesce(F.col(f"`code_{c}`"), F.lit(-1)).cast("double")
                                   for c in self.categorical})
            inputs += [f"code_{c}" for c in self.categorical]
        elif self.categorical and self.width() > WIDE_COLUMNS:
            return out.select(*[col(k) for k in keep], self._wide_vector().alias("features"))
        elif self.categorical:
            # an unknown category takes the index after the last; "keep" and dropLast make that all zeros
            out = out.withColumns({f"code_{c}": F.coalesce(F.col(f"`code_{c}`"), F.lit(self.sizes[c])).cast("double")
                                   for c in self.categorical})
            codes, slots = [f"code_{c}" for c in self.categorical], [f"slot_{c}" for c in self.categorical]
            tops = small_table(df.sparkSession, [tuple(float(self.sizes[c] - 1) for c in self.categorical)],
                               ", ".join(f"`{c}` double" for c in codes))
            encoder = OneHotEncoder(inputCols=codes, outputCols=slots, handleInvalid="keep", dropLast=True).fit(tops)
            out = encoder.transform(out)
            inputs += slots
        out = VectorAssembler(inputCols=inputs, outputCol="features").transform(out)
        return out.select(*[col(k) for k in keep], "features")

    def _wide_vector(self) -> Column:
        """The one-hot vector without a name for every slot, which the library's encoder would put into the schema, and the schema into every file."""
        cell = lambda slot, x: F.struct(slot.cast("int").alias("slot"), x.cast("double").alias("x"))
        missing = F.raise_error(F.lit("a number is missing in a row to encode"))
        cells, at = [cell(F.lit(i), F.coalesce(F.col(f"`num_{c}`"), missing)) for i, c in enumerate(self.numeric)], len(self.numeric)
        for c in self.categorical:
            cells.append(cell(F.col(f"`code_{c}`") + at, F.lit(1.0)))  # an unknown category has no code
            at += self.sizes[c]
        stored = F.filter(F.array(*cells), lambda c: c["slot"].isNotNull() & (c["x"] != 0))
        vector = F.struct(F.lit(0).alias("type"), F.lit(at).alias("size"), stored["slot"].alias("indices"), stored["x"].alias("values"))
        return F.from_json(F.to_json(F.struct(vector.alias("v"))), StructType([StructField("v", VectorUDT())]))["v"]

    def width(self) -> int:
        return len(self.numeric) + (len(self.categorical) if self.config.encoder == "label"
                                    else sum(self.sizes[c] for c in self.categorical))

    def to_columns(self, df: DataFrame, keep: list[str]) -> DataFrame:
        """`keep` and one named column per feature; for results too wide for columns use `transform`."""
        if self.width() > WIDE_COLUMNS:
            raise ValueError(f"{self.width()} features are too many for columns; use the feature vector")
        out = self.encode(df, keep)
        named = [F.col(f"`num_{c}`").alias(c) for c in self.numeric]
        for c in self.categorical:
            code = F.col(f"`code_{c}`")
            if self.config.encoder == "label":
                named.append(F.coalesce(code, F.lit(-1)).cast("double").alias(c))
            else:
                named += [F.coalesce((code == k).cast("double"), F.lit(0.0)).alias(f"{c}_{v}")
                          for k, v in enumerate(self._values(c))]
        return out.select(*[col(k) for k in keep], *named)

    def _values(self, c: str) -> list[str]:
        if c in self.inline:
            return self.inline[c]
        return [r["value"] for r in self.vocab.where(F.col("column") == c).orderBy("code").collect()]

    def feature_names(self, spark: SparkSession) -> DataFrame:
        """(position, name) in vector order; built from the vocabulary table, whatever its size."""
        first = [(i, c) for i, c in enumerate(self.numeric)]
        if self.config.encoder == "label":
            first += [(len(self.numeric) + i, c) for i, c in enumerate(self.categorical)]
        names = small_table(spark, first, "position bigint, name string")
        if self.config.encoder == "label" or not self.categorical:
            return names
        offsets, at = [], len(self.numeric)
        for c in self.categorical:
            offsets.append((c, at))
            at += self.sizes[c]
        starts = F.broadcast(small_table(spark, offsets, "column string, start bigint"))  # a row per column
        slots = self.vocab.join(starts, "column").select(
            (F.col("start") + F.col("code")).alias("position"), F.concat("column", F.lit("_"), "value").alias("name"))
        return names.unionAll(slots)

    def input_columns(self) -> list[str]:
        """Raw columns that scoring needs: the configured features first, else those the chain was fitted on."""
        return list(self.config.feature_columns or self.numeric + self.categorical)

    # --- storing

    def save(self, spark: SparkSession, path: str) -> None:
        state = {k: getattr(self, k) for k in ("numeric", "categorical", "fills", "caps", "scales", "sizes", "inline",
                                               "rows")}
        state["config"] = asdict(self.config)
        small_table(spark, [(json.dumps(state),)], "state string").coalesce(1).write.mode("overwrite").text(
            f"{path}/state")
        if self.vocab is not None:
            self.vocab.write.mode("overwrite").parquet(f"{path}/vocabulary")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Preparation:
        state = json.loads(spark.read.text(f"{path}/state").first()[0])
        state["config"] = PrepConfig(**state["config"])
        self = cls(**state)
        if self.categorical:
            self.vocab = spark.read.parquet(f"{path}/vocabulary")
        return self


def remove_outlier_rows(df: DataFrame, columns: list[str], multiplier: float = 1.5) -> tuple[DataFrame, int]:
    """Drop rows with a value outside the fences of any column; missing values stay."""
    df = nan_to_null(df)
    if not columns:
        return df, 0
    keep = F.lit(True)
    for c, (q1, q3) in exact_quantiles(df, {c: [0.25, 0.75] for c in columns}).items():
        if q1 is not None:
            reach = multiplier * (q3 - q1)
            keep = keep & (col(c).isNull() | col(c).between(F.lit(q1 - reach), F.lit(q3 + reach)))
    return df.where(keep), df.where(~keep).count()


@dataclass
class Prepared:
    train: DataFrame
    test: DataFrame
    preparation: Preparation
    removed_outlier_rows: int
    dropped_targets: int


def split_raw(df: DataFrame, config: PrepConfig, ids: list[str], types: dict[str, str] | None = None):
    """Outlier removal and split: (rows marked `is_test`, numeric, categorical, removed, dropped)."""
    features = features_of(df.drop(*ids), config.target, config.feature_columns)
    resolved = resolve_types(features, types)
    stored = {f.name: f.dataType for f in df.schema}
    numeric = [c for c, t in resolved.items() if t == "numeric" and is_numeric(stored[c])]
    categorical = [c for c, t in resolved.items() if t == "categorical"]
    text = [c for c, t in resolved.items() if t == "numeric" and not is_numeric(stored[c])]
    if text:
        raise TypeError("declared numeric but stored as text: " + ", ".join(text))
    # what is neither key, target nor feature is not read, whatever its type
    rows, removed = df.select(*[col(c) for c in dict.fromkeys([*ids, config.target, *features.columns])]), 0
    if config.outlier_handling == "remove":
        rows, removed = remove_outlier_rows(df, numeric, config.iqr_multiplier)
    marked, dropped = mark_test(rows, ids, config.target, config.test_size, config.stratify, SEED)
    return marked, numeric, categorical, removed, dropped


def preprocess(df: DataFrame, config: PrepConfig, ids: list[str], types: dict[str, str] | None = None) -> Prepared:
    """Subset, type, remove, split, fit on the training rows, apply to both sides.

    Both sides are written to the shared folder in one pass, a folder each, since models read them many times.
    """
    marked, numeric, categorical, removed, dropped = split_raw(df, config, ids, types)
    fitted = Preparation.fit(marked.where(~F.col("is_test")), config, numeric, categorical)
    ready = durable(fitted.transform(marked, [*ids, config.target, "is_test"]), "prepared", ["is_test"])
    return Prepared(ready.where(~F.col("is_test")).drop("is_test"), ready.where("is_test").drop("is_test"),
                    fitted, removed, dropped)
