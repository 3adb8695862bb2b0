"""Gaussian naive Bayes over feature vectors of any width, as tables.

What is learned is a table with a row per slot (place in the vector) that holds a number other than zero in some training row: the mean
and the population variance of every class there. Zeros are counted, never stored. Scoring starts from the score of a row of zeros and
corrects it for the numbers that are there, which are looked up by slot and added up per row. Only figures per class reach the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tabwright.functions.exprs import col
from tabwright.operators.lookup import left_lookup
from tabwright.sources.shared import durable

LEAST_VARIANCE = 1e-300  # stands for zero where nothing smooths it, so that a constant feature rules out other values
CELLS_PER_ROW = 10       # a lookup row of more classes counts as several when its table is sized for a broadcast


def entries(df: DataFrame, *keep: Column) -> DataFrame:
    """`keep`, `slot` and `x` for every number other than zero in `features`, dense or sparse."""
    v = F.unwrap_udt(F.col("features"))
    places = F.coalesce(v["indices"], F.sequence(F.lit(0), F.size(v["values"]) - 1))
    cells = F.when(F.size(v["values"]) > 0, F.arrays_zip(places.alias("slot"), v["values"].alias("x")))
    return df.select(*keep, F.inline(cells).alias("slot", "x")).where("x <> 0")


def _merged(parts: Column, mean: str = "mean", var: str = "var") -> tuple[Column, Column, Column]:
    """Count, mean and variance of all rows of an array of struct(n, mean, var) together."""
    total = lambda f: F.aggregate(parts, F.lit(0.0), lambda a, p: a + f(p))
    n = total(lambda p: p["n"])
    middle = total(lambda p: p["n"] * p[mean]) / n
    return n, middle, total(lambda p: p["n"] * (p[var] + (p[mean] - middle) * (p[mean] - middle))) / n


def _numbers(values: Iterable[float]) -> str:
    """An array of doubles as SQL."""
    return "array(" + ", ".join(f"{v!r}D" if math.isfinite(v) else f"double('{v}')" for v in map(float, values)) + ")"


@dataclass
class GaussianBayes:
    """A fitted model, or one per group: `table` has (key, m, v, n), with key = slot * groups + group, means and variances by class."""

    table: DataFrame
    sizes: list[list[int]]      # rows per group and class
    width: int                  # length of the feature vectors
    slots: list[int]            # slots with a row in the table, per group
    entries: int                # stored numbers of the training rows of all groups
    largest: list[float]        # largest variance of a feature over all classes, per group

    @classmethod
    def fit(cls, rows: DataFrame, n_classes: int, fold: str | None = None, folds: int = 1, known: list[int] | None = None) -> GaussianBayes:
        """From `features`, all of one length, and `label` (a class index). With `fold`, group f learns from the rows of all folds but f.

        `known` has the rows per class where they are counted already.
        """
        part = F.col(fold).cast("int") if fold else F.lit(0)
        v = F.unwrap_udt(F.col("features"))
        one = rows.select(F.coalesce(v["size"], F.size(v["values"])).alias("width")).first()
        width = one["width"] if one else 0
        sizes = [[0] * n_classes for _ in range(folds)]
        if known and not fold:
            sizes = [list(known)]
        else:
            for r in rows.groupBy(part.alias("part"), F.col("label").cast("int").alias("label")).count().collect():
                for g in ([g for g in range(folds) if g != r["part"]] if fold else [0]):
                    sizes[g][r["label"]] += r["count"]
        cells = entries(rows, part.alias("part"), F.col("label").cast("int").alias("label")).groupBy("part", "label", "slot").agg(
            F.count("*").cast("double").alias("n"), F.avg("x").alias("mean"), F.var_pop("x").alias("var"))
        if fold:
            groups = F.filter(F.sequence(F.lit(0), F.lit(folds - 1)), lambda g: g != F.col("part"))
            spread = durable(cells, "moments").withColumn("group", F.explode(groups))
            n, mean, var = _merged(F.col("parts"))
            cells = spread.groupBy("group", "label", "slot").agg(F.collect_list(F.struct("n", "mean", "var")).alias("parts")).select(
                "group", "label", "slot", n.alias("n"), mean.alias("mean"), var.alias("var"))  # a part per fold
        else:
            cells = cells.withColumnRenamed("part", "group")
        rows_of = F.array(*[F.array(*[F.lit(float(n)) for n in s]) for s in sizes])
        all_of = F.array(*[F.lit(float(sum(s))) for s in sizes])
        # zeros join the stored numbers of a class
        size = F.get(F.get(rows_of, F.col("group")), F.col("label"))
        mean = F.col("n") * F.col("mean") / size
        var = (F.col("n") * (F.col("var") + (F.col("mean") - mean) * (F.col("mean") - mean)) + (size - F.col("n")) * mean * mean) / size
        cells = cells.select("group", "slot", F.struct("label", F.struct(size.alias("n"), mean.alias("mean"), var.alias("var"), F.col("n").alias("stored"))).alias("cell"))
        # a row per slot: classes that store nothing there have mean and variance zero
        by_slot = cells.groupBy("group", "slot").agg(F.collect_list("cell").alias("cells")).withColumn("by_class", F.map_from_entries("cells"))  # at most one per class
        at = lambda f: F.expr(f"transform(sequence(0, {n_classes - 1}), c -> coalesce(try_element_at(by_class, c).{f}, 0D))")
        parts = F.transform("cells", lambda c: c.getField("col2"))
        everyone = F.get(all_of, F.col("group"))
        shown = F.aggregate(parts, F.lit(0.0), lambda a, p: a + p["n"])
        middle = F.aggregate(parts, F.lit(0.0), lambda a, p: a + p["n"] * p["mean"]) / everyone
        spread = F.aggregate(parts, F.lit(0.0), lambda a, p: a + p["n"] * (p["var"] + (p["mean"] - middle) * (p["mean"] - middle)))
        table = durable(by_slot.select(
            (F.col("slot").cast("long") * folds + F.col("group")).alias("key"), "group",
            at("mean").alias("m"), at("var").alias("v"),
            F.aggregate(parts, F.lit(0.0), lambda a, p: a + p["stored"]).cast("long").alias("n"),
            ((spread + (everyone - shown) * middle * middle) / everyone).alias("overall")), "slots")
        facts = {r["group"]: r for r in table.groupBy("group").agg(
            F.count("*").alias("slots"), F.sum("n").alias("stored"), F.max("overall").alias("largest")).collect()}
        take = lambda g, f, none: facts[g][f] if g in facts else none
        return cls(table, sizes, width, [take(g, "slots", 0) for g in range(folds)],
                   sum(take(g, "stored", 0) for g in range(folds)) // max(folds - 1, 1), [take(g, "largest", 0.0) for g in range(folds)])

    def moments(self) -> DataFrame:
        """(class, slot, n, mean, variance) of the first group, for slots and classes with any row in the table."""
        groups = len(self.sizes)
        rows = self.table.where("group = 0").select((F.col("key") / groups).cast("int").alias("slot"), F.posexplode(F.arrays_zip("m", "v")).alias("class", "c"))
        size = F.get(F.array(*[F.lit(n) for n in self.sizes[0]]), F.col("class"))
        return rows.select("class", "slot", size.cast("long").alias("n"), F.col("c.m").alias("mean"), F.col("c.v").alias("variance"))

    def _epsilon(self, smoothing: float) -> str:
        return f"get({_numbers(smoothing * v for v in self.largest)}, group)"

    def baselines(self, smoothings: list[float]) -> list[list[list[float]]]:
        """By smoothing, group and class: the log score of a row of zeros; a class without rows has minus infinity."""
        cells = self.table.select("group", F.posexplode(F.arrays_zip("m", "v")).alias("class", "c")).select("group", "class", "c.m", "c.v")
        terms = []
        for i, s in enumerate(smoothings):
            var = f"greatest(v + {self._epsilon(s)}, {LEAST_VARIANCE!r}D)"
            terms.append(F.expr(f"sum(-0.5D * ln({2 * math.pi!r}D * {var}) - m * m / (2D * {var}))").alias(f"b{i}"))
        rows = {(r["group"], r["class"]): r for r in cells.groupBy("group", "class").agg(*terms).collect()}
        out = []
        for i, s in enumerate(smoothings):
            out.append([])
            for g, sizes in enumerate(self.sizes):
                rest = (self.width - self.slots[g]) * -0.5 * math.log(2 * math.pi * max(s * self.largest[g], LEAST_VARIANCE))
                out[i].append([math.log(n / sum(sizes)) + rest + (rows[g, c][f"b{i}"] if (g, c) in rows else 0.0) if n else -math.inf for c, n in enumerate(sizes)])
        return out

    def score(self, df: DataFrame, smoothings: list[float], baselines: list[list[list[float]]], group: Column | None = None) -> DataFrame:
        """`df` with `outcome`, an array of struct(winner, probability), one per smoothing; `group` picks the model of a row.

        Ties go to the first class. Numbers beyond the trained width are not looked at, and neither is a slot that no training row fills.
        """
        groups, classes = len(self.sizes), range(len(self.sizes[0]))
        g = group.cast("int") if group is not None else F.lit(0)
        rows = durable(df.withColumn("_row", F.monotonically_increasing_id()).withColumn("group", g), "to_score")
        cells = entries(rows, F.col("_row"), F.col("group")).where(F.col("slot") < self.width).select(
            "_row", "group", "x", (F.col("slot").cast("long") * groups + F.col("group")).alias("key"))
        table = self.table.select("key", F.struct("m", "v").alias("_of"), "n")
        n_rows = sum(self.slots) * math.ceil(len(classes) / CELLS_PER_ROW)
        found = left_lookup(cells, table, "key", "_of", "n", n_rows, max(self.entries, 1))
        added = found.where("_of is not null").groupBy("_row").agg(*[
            F.expr(f"sum(x * (2D * get(_of.m, {c}) - x) / (2D * greatest(get(_of.v, {c}) + {self._epsilon(s)}, {LEAST_VARIANCE!r}D)))").alias(f"s{i}_{c}")
            for i, s in enumerate(smoothings) for c in classes])
        logs = F.expr("array(" + ", ".join("array(" + ", ".join(
            f"get({_numbers(b[c] for b in baselines[i])}, group) + coalesce(s{i}_{c}, 0D)" for c in classes) + ")" for i in range(len(smoothings))) + ")")
        outcome = F.expr("""transform(_logs, l -> transform(array(array_max(l)), top -> struct(
            cast(array_position(l, top) - 1 as int) as winner,
            transform(l, v -> exp(v - top) / aggregate(l, 0D, (a, w) -> a + exp(w - top))) as probability))[0])""")
        out = rows.join(added, "_row", "left").withColumn("_logs", logs)
        return out.select(*[col(c) for c in df.columns], outcome.alias("outcome"))
