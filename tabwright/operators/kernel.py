"""Support vector machines over any number of classes: landmarks stand in for the kernel, pairs of classes vote.

The RBF kernel is replaced by inner products with landmark rows (Nystroem): phi(x) = k(x, landmarks) K^-1/2, where K is the kernel between
landmarks. A row keeps |phi(x)|^2 of its own kernel value, which is 1; what it loses is its residual. By Cauchy and Schwarz the kernel of any
two rows is off by at most the root of the product of their residuals, so the mean residual bounds the mean error over all pairs of rows.
Landmarks are added in growing rounds, drawn with a chance in proportion to the residual, until that mean is small enough.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from itertools import combinations
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.ml.classification import LinearSVC, LinearSVCModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tabwright.functions.exprs import row_hash
from tabwright.operators.split import SEED
from tabwright.sources.local import small_table
from tabwright.sources.shared import durable

FIRST_ROUND = 32
GROWTH = 4
CELLS = 8_000_000   # numbers in all landmarks together; what a task holds stays below 64 MB at any width
PARALLEL = 4        # pairs of classes fitted at a time
WORKING_ROWS = 10_000  # of each class that a machine is fitted on at first
ROWS_A_TASK = 40_000   # of these; a step over so few rows is shorter than the start of a task
ROUNDS = 8          # of rows added to these before all are taken
GAP = 0.01         # share of what a machine minimises that the rows left out may add to it


def _kernel(x: np.ndarray, points: np.ndarray, gamma: float) -> np.ndarray:
    squares = (x * x).sum(axis=1)[:, None] + (points * points).sum(axis=1)[None, :] - 2.0 * (x @ points.T)
    return np.exp(-gamma * np.maximum(squares, 0.0))


def _root(points: np.ndarray, gamma: float) -> np.ndarray:
    """The inverse root of the landmarks' kernel, without directions that rounding alone fills."""
    values, vectors = np.linalg.eigh(_kernel(points, points, gamma))
    good = values > 1e-9 * values.max()
    return vectors[:, good] / np.sqrt(values[good])


@dataclass
class Landmarks:
    """Landmark rows of a bounded number, the inverse root of their kernel, its width and the mean residual of the training rows."""

    points: np.ndarray
    root: np.ndarray
    gamma: float
    error: float = float("nan")

    @classmethod
    def fit(cls, rows: DataFrame, key: str, gamma: float, error: float, limit: int) -> Landmarks:
        """Landmarks from `rows` (key, features) until the mean residual is at most `error` or `limit` of them are taken."""
        arrays = rows.select(row_hash([key], SEED).alias("_h"), vector_to_array("features").alias("_x"))
        first = arrays.orderBy("_h", "_x").limit(min(FIRST_ROUND, limit)).collect()
        points = np.unique(np.array([r["_x"] for r in first]), axis=0)
        limit = min(limit, max(1, CELLS // points.shape[1]))
        points = points[:limit]
        while True:
            self = cls(points, _root(points, gamma), gamma)
            left = arrays.withColumn("_r", self._udf(rows.sparkSession, residual=True)("_x"))
            self.error = left.agg(F.avg("_r")).first()[0]
            if self.error <= error or len(points) >= limit:
                return self
            # the smallest of exponential times with rates _r are a draw in proportion to _r
            chance = (F.conv("_h", 16, 10).cast("double") + 0.5) / float(1 << 32)
            more = min(limit, GROWTH * max(len(points), FIRST_ROUND // GROWTH)) - len(points)
            drawn = left.where("_r > 1e-9").orderBy(-F.log(chance) / F.col("_r"), "_x").limit(more).collect()
            grown = np.unique(np.vstack([points, *(np.array([r["_x"]]) for r in drawn)]), axis=0)
            if len(grown) == len(points):  # only copies are left
                return self
            points = grown

    def _udf(self, spark: SparkSession, residual: bool = False):
        held = spark.sparkContext.broadcast((self.points, self.root, self.gamma))

        @F.pandas_udf("double" if residual else "array<double>")
        def phi(v: pd.Series) -> pd.Series:
            if not len(v):
                return pd.Series([], dtype=float if residual else object)
            points, root, gamma = held.value
            out = _kernel(np.stack(v.to_numpy()), points, gamma) @ root
            return pd.Series(np.maximum(1.0 - (out * out).sum(axis=1), 0.0) if residual else list(out))

        return phi

    def save(self, spark: SparkSession, path: str) -> None:
        """A row per landmark, with its row of the root: machines are only right for the root that they were fitted with."""
        rows = [(i, x.tolist(), r.tolist(), self.gamma, self.error) for i, (x, r) in enumerate(zip(self.points, self.root, strict=True))]
        small_table(spark, rows, "place int, x array<double>, root array<double>, gamma double, error double").write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Landmarks:
        rows = spark.read.parquet(path).orderBy("place").collect()
        return cls(np.array([r["x"] for r in rows]), np.array([r["root"] for r in rows]), rows[0]["gamma"], rows[0]["error"])

    def mapped(self, df: DataFrame) -> DataFrame:
        """`df` with features whose inner products approach the kernel."""
        return df.withColumn("features", array_to_vector(self._udf(df.sparkSession)(vector_to_array("features"))))


def _machine(rows: DataFrame, sizes: list[float], counts: list[int], c: float, max_iter: int, a: int, b: int) -> LinearSVCModel:
    """The machine of two classes, fitted on the rows that hold it: those drawn first and all that came to lie inside its margin since.

    A row beyond the margin adds nothing to what is minimised, so leaving it out changes nothing. What the rows left out add all the same is
    summed up over every one of them, and is the most by which the sum misses its least value; the machine is taken once that is at most GAP of
    the sum. If half of the rows are needed, all are taken.
    """
    def fit(part: DataFrame, size: float) -> LinearSVCModel:
        return LinearSVC(regParam=1.0 / (c * size), standardization=False, maxIter=max_iter, weightCol="weight").fit(part)

    two = rows.where(F.col("label").isin(float(a), float(b))).withColumn("label", (F.col("label") == b).cast("double"))
    n = counts[a] + counts[b]
    share = F.when(F.col("label") == 0, WORKING_ROWS / counts[a]).otherwise(WORKING_ROWS / counts[b])
    known, inside = two, F.col("draw") < share
    for i in range(ROUNDS if n > 4 * WORKING_ROWS else 0):
        part = durable(known.where(inside).select("features", "weight", "label"), "working")
        held, size = part.agg(F.count("*"), F.sum("weight")).first()
        if 2 * held > n:
            break
        model = fit(part.coalesce(math.ceil(held / ROWS_A_TASK)), size)
        # beside the columns the machine's loss of every row
        known = model.copy().setPredictionCol("").setRawPredictionCol("_raw").transform(known)
        known = known.withColumn(f"_loss{i}", F.greatest(F.lit(0.0), 1 - (2 * F.col("label") - 1) * vector_to_array("_raw")[1])).drop("_raw")
        loss = F.col("weight") * F.col(f"_loss{i}")
        seen, left = known.agg(F.sum(F.when(inside, loss)), F.sum(F.when(~inside, loss))).first()
        w = model.coefficients.toArray()
        if (left or 0.0) <= GAP * ((seen or 0.0) + float(w @ w) / (2 * c)):
            return model
        inside = inside | (F.col(f"_loss{i}") > 0)
    return fit(two, sizes[a] + sizes[b])


@dataclass
class Pairs:
    """A linear machine for every two classes; the class with most votes wins, the first one of equals."""

    models: list[LinearSVCModel]
    n_classes: int

    @classmethod
    def fit(cls, rows: DataFrame, sizes: list[float], counts: list[int], c: float, max_iter: int) -> Pairs:
        """From rows with label, features, weight and draw (even from 0 to 1); sizes and counts: weights and rows by class. A machine reads the rows
        of its two classes only."""
        pairs = list(combinations(range(len(sizes)), 2))
        work = lambda pair: _machine(rows, sizes, counts, c, max_iter, *pair)
        with ThreadPool(min(PARALLEL, len(pairs))) as pool:
            return cls(pool.map(inheritable_thread_target(rows.sparkSession)(work), pairs), len(sizes))

    def winner(self, df: DataFrame) -> tuple[DataFrame, Column]:
        """`df` with one more column per pair, and the winning class as an expression over them; a margin of zero is a vote for the first."""
        votes = [F.lit(0)] * self.n_classes
        for i, (a, b) in enumerate(combinations(range(self.n_classes), 2)):
            df = self.models[i].copy().setPredictionCol(f"_vote{i}").setRawPredictionCol("").transform(df)
            said = F.col(f"_vote{i}").cast("int")
            votes[a], votes[b] = votes[a] + 1 - said, votes[b] + said
        counts = F.array(*votes)
        return df, (F.array_position(counts, F.array_max(counts)) - 1).cast("int")

    def save(self, path: str) -> None:
        for i, model in enumerate(self.models):
            model.write().overwrite().save(f"{path}/{i}")

    @classmethod
    def load(cls, path: str, n_classes: int) -> Pairs:
        return cls([LinearSVCModel.load(f"{path}/{i}") for i in range(n_classes * (n_classes - 1) // 2)], n_classes)
