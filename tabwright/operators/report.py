"""Report tables: sections in reading order and the data behind the figures."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from tabwright.operators.evaluate import METRICS, best_model
from tabwright.operators.prep import PrepConfig
from tabwright.operators.table import shape
from tabwright.sources.local import small_table

MAX_ROWS = 25      # longest table in a report section
FIGURE_BARS = 20   # most bars in a per-column figure
SHOWN_COLUMNS = 5  # columns summarised in the distribution section


def _section(df: DataFrame, number: int, name: str, order: list, limit: int | None, item, cells: list[tuple]) -> DataFrame:
    """(section, name, position, item, measure, value, text) rows from one small table."""
    w = Window.partitionBy(F.lit(0)).orderBy(*order)  # a row per column, model or warning
    placed = df.withColumn("_at", F.row_number().over(w))
    if limit:
        placed = placed.where(F.col("_at") <= limit)
    structs = [F.struct(F.lit(measure).alias("measure"),
                        (F.round(value.cast("double"), 4) if value is not None else F.lit(None).cast("double"))
                        .alias("value"),
                        (text.cast("string") if text is not None else F.lit(None).cast("string")).alias("text"))
               for measure, value, text in cells]
    return placed.select(F.lit(number).alias("section"), F.lit(name).alias("name"), F.col("_at").alias("position"),
                         item.alias("item"), F.inline(F.array(*structs)))


def report_sections(profile: dict, ranked: DataFrame | None, metric: str | None = None) -> DataFrame:
    """Warnings, missing values, outliers, correlations, distributions, comparison with the best model."""
    spark = profile["missing"].sparkSession
    parts = []
    if profile["warnings"]:
        notes = small_table(spark, list(enumerate(profile["warnings"])), "at int, note string")
        parts.append(_section(notes, 1, "warnings", ["at"], None, F.lit(""), [("warning", None, F.col("note"))]))
    parts.append(_section(profile["missing"], 2, "missing_values",
                          [F.desc("missing_percent"), F.desc("missing_count"), "column"], MAX_ROWS, F.col("column"),
                          [("missing_count", F.col("missing_count"), None),
                           ("missing_percent", F.col("missing_percent"), None)]))
    parts.append(_section(profile["outliers"], 3, "outliers",
                          [F.desc("outlier_count"), F.desc("outlier_percent"), "column"], MAX_ROWS, F.col("column"),
                          [("outlier_count", F.col("outlier_count"), None),
                           ("outlier_percent", F.col("outlier_percent"), None)]))
    size = profile["correlations"].agg(F.count("*").alias("pairs")).withColumn(
        "size", (F.lit(1) + F.sqrt(F.lit(1) + 8 * F.col("pairs"))) / 2)
    parts.append(_section(size, 4, "correlations", ["size"], None, F.lit("matrix"),
                          [("columns", F.col("size"), None)]))
    shown = profile["numeric_columns"][:SHOWN_COLUMNS]
    if shown:
        order = F.array_position(F.array(*[F.lit(c) for c in shown]), F.col("column"))
        parts.append(_section(profile["numeric_stats"].where(F.col("column").isin(shown)), 5, "distributions", [order],
                              None, F.col("column"),
                              [("mean", F.col("mean"), None), ("std", F.col("std"), None)]))
    if ranked is not None:
        parts.append(_section(best_model(ranked), 6, "best_model", ["best_model"], None, F.lit(metric or ""),
                              [("best_model", None, F.col("best_model"))]))
        parts.append(_section(ranked, 7, "comparison", ["rank"], MAX_ROWS, F.col("model"),
                              [(m, F.col(m), None) for m in METRICS]))
    return reduce(DataFrame.unionAll, parts)


def overview_sections(df: DataFrame, issues: DataFrame, config: PrepConfig, ranked: DataFrame | None) -> DataFrame:
    """Dataset overview, issue findings, preparation steps and the recommended model."""
    spark = df.sparkSession
    steps = [("numeric_imputer", config.numeric_imputer), ("outliers", config.outlier_handling),
             ("scaler", config.scaler), ("categorical_imputer", config.categorical_imputer),
             ("encoder", config.encoder), ("test_size", str(config.test_size))]
    planned = small_table(spark, [(i, *s) for i, s in enumerate(steps)], "at int, step string, choice string")
    parts = [
        _section(shape(df), 1, "overview", ["n_rows"], None, F.lit("dataset"),
                 [("rows", F.col("n_rows"), None), ("columns", F.col("n_columns"), None)]),
        _section(issues, 2, "issues", ["issue", "subject", "detail"], None, F.col("subject"),
                 [("finding", F.col("value"), F.concat_ws(": ", "issue", "detail"))]),
        _section(planned, 3, "preparation", ["at"], None, F.col("step"), [("choice", None, F.col("choice"))]),
    ]
    if ranked is not None:
        parts.append(_section(best_model(ranked), 4, "recommendation", ["best_model"], None, F.lit("model"),
                              [("use", None, F.col("best_model"))]))
    return reduce(DataFrame.unionAll, parts)


def figure_data(profile: dict, max_histograms: int | None = None) -> DataFrame:
    """(figure, x, y): bars, heat-map cells and histogram centres, as text labels and numbers."""
    def bars(df: DataFrame, name: str, value: str, tie: str) -> DataFrame:
        w = Window.partitionBy(F.lit(0)).orderBy(F.desc(value), F.desc(tie), "column")  # a row per column
        return (df.withColumn("_at", F.row_number().over(w)).where(F.col("_at") <= FIGURE_BARS)
                .select(F.lit(name).alias("figure"), F.col("column").alias("x"), F.col(value).alias("y")))

    parts = [bars(profile["missing"], "missingness", "missing_percent", "missing_count"),
             # outlier rows come sorted by count
             profile["outliers"].withColumn("_at", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(
                 F.desc("outlier_count"), F.desc("outlier_percent"), "column"))).where(F.col("_at") <= FIGURE_BARS)
             .select(F.lit("outliers"), "column", "outlier_percent"),
             profile["correlations"].select(F.lit("correlations"), F.concat_ws(" / ", "col_a", "col_b"), "corr")]
    ordered = profile["numeric_columns"] + profile["categorical_columns"]
    wanted = ordered if max_histograms is None else ordered[:max(0, max_histograms)]
    parts.append(profile["histograms"].where(F.col("column").isin(wanted)).select(
        F.concat(F.lit("hist_"), "column"), F.col("bin").cast("string"), F.col("count").cast("double")))
    parts.append(profile["histograms"].where(F.col("column").isin(wanted)).select(
        F.concat(F.lit("centre_"), "column"), F.col("bin").cast("string"), (F.col("lower") + F.col("upper")) / 2))
    parts.append(profile["category_counts"].where(F.col("column").isin(wanted)).select(
        F.concat(F.lit("bar_"), "column"), "value", F.col("count").cast("double")))
    return reduce(DataFrame.unionAll, parts)
