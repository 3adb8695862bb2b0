"""Session settings the operators are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution re-plans joins, partition counts and skewed partitions from measured sizes.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cores: int | str = 8, name: str = "tabwright", memory: str = "8g", **extra: str) -> SparkSession:
    """A session on this machine; on a cluster, pass SETTINGS to the submitted job instead."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    local = {"spark.sql.shuffle.partitions": str(cores), "spark.ui.enabled": "false", "spark.driver.memory": memory}
    for key, value in {**SETTINGS, **local, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
