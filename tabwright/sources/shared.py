"""The folder that every executor can reach."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_folders: dict[str, str] = {}
_written: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a fresh temporary one only for a local master."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="tabwright-")
    return _local_folders[app]


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/tabwright-{spark.sparkContext.applicationId}"


def fresh_path(spark: SparkSession, label: str) -> str:
    path = f"{_own_folder(spark)}/{label}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def _delete(spark: SparkSession, path: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def forget(spark: SparkSession) -> None:
    """Delete what this application wrote to the shared folder; its DataFrames are unusable afterwards."""
    _delete(spark, _own_folder(spark))


@contextmanager
def temporary(spark: SparkSession):
    """Delete at the end what is written to the shared folder inside, once its results are collected or stored elsewhere.

    Gives a function that writes a table which stays.
    """
    before, kept = len(_written), set()

    def keep(df: DataFrame, label: str) -> DataFrame:
        out = durable(df, label)
        kept.add(_written[-1])
        return out

    try:
        yield keep
    finally:
        gone = [p for p in _written[before:] if p not in kept]
        _written[before:] = [p for p in _written[before:] if p in kept]
        for path in gone:
            _delete(spark, path)


def durable(df: DataFrame, label: str = "stage", by: list[str] | None = None) -> DataFrame:
    """Write a table to the shared folder, in a folder per value of `by` if given, and read it back.

    Cuts the lineage, survives lost executors, and gives the planner true sizes.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.partitionBy(*(by or [])).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def release(*tables: DataFrame) -> None:
    """Delete tables that `durable` gave and that nothing reads any more."""
    for df in tables:
        _delete(df.sparkSession, df.written_to)
        _written.remove(df.written_to)


@contextmanager
def spent_shuffles(spark: SparkSession):
    """Let Spark delete the shuffle files of what is run inside as soon as its result is there."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)
