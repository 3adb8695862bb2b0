"""Writers for prepared tables, predictions and report tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tabwright.functions.exprs import col
from tabwright.sources.shared import fresh_path


def write_prepared(prepared: DataFrame, flag: str, path: str | None = None, format: str = "parquet") -> str:
    """Training and test rows in one pass, a folder per side."""
    path = path or fresh_path(prepared.sparkSession, "prepared")
    (prepared.withColumn("split", F.when(col(flag), "test").otherwise("train")).drop(flag)
     .write.format(format).partitionBy("split").option("header", True).mode("overwrite").save(path))
    return path


def read_prepared(spark: SparkSession, path: str, ids: list[str]) -> DataFrame:
    """The whole prepared table in row-key order, with the side it belongs to."""
    return spark.read.parquet(path).orderBy(*[col(i) for i in ids])


def write_predictions(scored: DataFrame, ids: list[str], path: str | None = None, format: str = "parquet") -> str:
    """Row key, prediction and class probabilities, sorted by row key across the files."""
    path = path or fresh_path(scored.sparkSession, "predictions")
    kept = [c for c in scored.columns if c in ids or c == "prediction" or c.startswith("proba_")]
    (scored.select(*[col(c) for c in kept]).orderBy(*[col(i) for i in ids])
     .write.format(format).option("header", True).mode("overwrite").save(path))
    return path


def write_report(tables: dict[str, DataFrame], spark: SparkSession, path: str | None = None) -> str:
    """One folder per report table."""
    path = path or fresh_path(spark, "report")
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}")
    return path


def read_report(spark: SparkSession, path: str, names: list[str]) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{path}/{name}") for name in names}


def table_sizes(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, n_rows) for a bundle."""
    out = None
    for name, df in tables.items():
        row = df.agg(F.lit(name).alias("table"), F.count("*").alias("n_rows"))
        out = row if out is None else out.unionAll(row)
    return out
