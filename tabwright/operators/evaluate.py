"""Metrics from confusion counts, model comparison and ranking."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tabwright.functions.exprs import col
from tabwright.operators.ordered import running_totals
from tabwright.sources.local import small_table

METRICS = ("accuracy", "precision", "recall", "f1_score")


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction", by: list[str] | None = None
              ) -> DataFrame:
    """(label, prediction, count): at most classes squared rows, combined before the shuffle."""
    return df.groupBy(*(by or []), col(label).cast("string").alias("label"),
                      col(prediction).cast("string").alias("prediction")).agg(F.count("*").alias("count"))


def metrics_from(counts: DataFrame, by: list[str] | None = None) -> DataFrame:
    """accuracy and support-weighted precision, recall and F1 from confusion counts."""
    by = by or []
    hit = F.when(F.col("label") == F.col("prediction"), F.col("count")).otherwise(0)
    sides = counts.select(*by, F.inline(F.array(
        F.struct(F.col("label").alias("class"), F.col("count").alias("real"), F.lit(0).cast("bigint").alias("said"),
                 hit.cast("bigint").alias("hit")),
        F.struct(F.col("prediction").alias("class"), F.lit(0).cast("bigint").alias("real"),
                 F.col("count").alias("said"), F.lit(0).cast("bigint").alias("hit")))))
    classes = sides.groupBy(*by, "class").agg(*[F.sum(c).alias(c) for c in ("real", "said", "hit")])
    ratio = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0))
    precision, recall = ratio(F.col("hit"), F.col("said")), ratio(F.col("hit"), F.col("real"))
    f1 = ratio(2.0 * F.col("hit"), F.col("said") + F.col("real"))
    weighted = lambda v: F.sum(v * F.col("real")) / F.sum("real")
    return classes.groupBy(*by).agg(
        (F.sum("hit") / F.sum("real")).alias("accuracy"), weighted(precision).alias("precision"),
        weighted(recall).alias("recall"), weighted(f1).alias("f1_score"))


def metrics(df: DataFrame, label: str = "label", prediction: str = "prediction", by: list[str] | None = None
            ) -> DataFrame:
    return metrics_from(confusion(df, label, prediction, by), by)


def compare_models(results: dict[str, DataFrame | str], seconds: dict[str, dict[str, float]] | None = None,
                   spark: SparkSession | None = None) -> DataFrame:
    """One row per model: its metrics, or the error that kept it from having any; metrics are null if no model has some."""
    spark = spark or SparkSession.active()
    rows = small_table(spark, [], "model string, " + ", ".join(f"{m} double" for m in METRICS))
    for model, result in results.items():
        if isinstance(result, DataFrame):
            row = result.select(F.lit(model).alias("model"), *METRICS)
        else:
            row = small_table(spark, [(model, str(result))], "model string, error string")
        for name, value in (seconds or {}).get(model, {}).items():
            row = row.withColumn(name, F.lit(float(value)))
        rows = rows.unionByName(row, allowMissingColumns=True)
    return rows


def rank_models(comparison: DataFrame, metric: str) -> DataFrame:
    """Rank 1..n by the metric, failed models last, ties by name."""
    if metric not in comparison.columns:
        raise KeyError(f"no column {metric!r} to rank by; there are {', '.join(comparison.columns)}")
    w = Window.partitionBy(F.lit(0)).orderBy(F.desc_nulls_last(metric), "model")  # one row per model
    return comparison.withColumn("rank", F.row_number().over(w))


def best_model(ranked: DataFrame) -> DataFrame:
    """The best-ranked model; without ranks, the first by name."""
    order = "rank" if "rank" in ranked.columns else "model"
    return ranked.agg(F.min_by("model", order).alias("best_model"))


def roc_points(df: DataFrame, label: str, score: str) -> DataFrame:
    """(score, tpr, fpr) at every distinct score, from running totals of the two classes; label is 0 or 1."""
    steps = df.groupBy(col(score).alias("score")).agg(
        F.sum(col(label).cast("bigint")).alias("pos"), F.sum(1 - col(label).cast("bigint")).alias("neg"))
    placed = running_totals(steps, "score", {"pos": "pos_before", "neg": "neg_before"}, descending=True)
    total = placed.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N")).first()
    return placed.select(
        "score", "pos", "neg", "pos_before", "neg_before",
        F.try_divide(F.col("pos_before") + F.col("pos"), F.lit(total["P"])).alias("tpr"),
        F.try_divide(F.col("neg_before") + F.col("neg"), F.lit(total["N"])).alias("fpr"))


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Area under the ROC curve by trapezoids between distinct scores."""
    p = roc_points(df, label, score)
    area = F.sum(F.col("neg").cast("double") * (F.col("pos_before") + F.col("pos") / 2.0))
    return p.agg(F.try_divide(area, F.sum("pos").cast("double") * F.sum("neg")).alias("auc"),
                 F.count("*").alias("n_thresholds"))
