"""The queries of this package, one per operator, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.llm import (collocations, decontamination, hyperminhash, importance, langid, line_dedup, nearest, oracles, pii, pitman_yor, quality_rules, secret_scan,
                           sentencepiece_codec, suffix_dedup)
from tabwright.llm.documents import HELD_OUT_HASH

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame] | None = None, sql: str | None = None):
    """Register a query under its name, with the SQL that must give the same rows where there is one."""
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql
        return fn
    return add(fn) if fn else add


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


@query
def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.digests(read(spark, sf_dir, "documents"), ["doc_id"])


@query(sql=oracles.PII)
def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(read(spark, sf_dir, "documents"), ["doc_id"])


@query
def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(read(spark, sf_dir, "documents"))


@query
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = line_dedup.dedup_lines(read(spark, sf_dir, "documents"))
    return lines.select("doc_id", "n_lines", "n_removed", F.array_join("removed", ",").alias("removed"), F.sha2("text", 256).alias("kept_sha256"))


@query
def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    held_out = F.coalesce(F.expr(HELD_OUT_HASH.format(id="doc_id") + " % 3 = 1"), F.lit(False))
    trees = langid.train(docs.where(~held_out & F.col("doc_id").isNotNull()).select("text", "lang", "doc_id"))  # the id only tells copies apart when documents are drawn
    return langid.predict(docs, trees, ["doc_id"]).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "bits_per_byte")


@query(sql=oracles.QUALITY)
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(read(spark, sf_dir, "documents"), ["doc_id"]).drop("rejected_by")


@query(sql=oracles.NEAR)
def op8_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hyperminhash.near_duplicates(read(spark, sf_dir, "documents"), shingle=2, percent=80)


@query
def op9_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitman_yor.score(read(spark, sf_dir, "documents"))


@query(sql=oracles.REPEATS)
def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(read(spark, sf_dir, "documents"), with_kept=False)


@query
def op11_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.search(read(spark, sf_dir, "embeddings"))


@query(sql=oracles.PHRASES)
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read(spark, sf_dir, "documents"))


@query(sql=oracles.RESAMPLED)
def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
