"""Documents to training tokens: five stages, each written and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.llm import decontamination, hyperminhash, langid, line_dedup, sentencepiece_codec
from tabwright.llm.documents import quoted
from tabwright.sources.shared import temporary

#: A document goes if its language cannot be told: no letters, or no language that holds half of the probability.
LEAST_SCORE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose language is recognised; the languages are learned from the labelled documents of the input."""
    trees = langid.train(docs.select("text", "lang"))
    return langid.recognised(docs, trees, LEAST_SCORE)


def _free(docs: DataFrame, *names: str) -> list[str]:
    """The names, lengthened until no column of the documents has them (Spark does not tell upper from lower case)."""
    taken = {c.lower() for c in docs.columns}
    return [next(n + "_" * i for i in range(len(taken) + 1) if (n + "_" * i).lower() not in taken) for n in names]


def _one_each(docs: DataFrame) -> DataFrame:
    """Documents with an id, one row each, as the operators see them; the texts are only shuffled if an id repeats."""
    if docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").isEmpty():
        return docs.where("doc_id is not null")
    first = F.min(F.struct(F.col("text").isNotNull(), *map(quoted, ["text", *(c for c in docs.columns if c not in ("doc_id", "text"))])))
    return docs.where("doc_id is not null").groupBy("doc_id").agg(first.alias("least")).select(*(F.col("doc_id") if c == "doc_id" else F.col("least").getField(c).alias(c) for c in docs.columns))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Delete blocks of lines that earlier documents have; documents without any word left go, as do rows without an id.

    One row stays of an id that repeats. `n_chars` follows the text where there is such a column. An empty table stays empty.
    """
    docs = _one_each(docs)
    of, text = _free(docs, "_of", "_kept")
    kept = line_dedup.dedup_lines(docs).select(F.col("doc_id").alias(of), F.col("text").alias(text))
    out = docs.join(kept, F.col(of) == F.col("doc_id")).where(F.col(text).rlike(r"[^\s]"))
    changed = {"text": F.col(text)}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.char_length(text).cast(docs.schema["n_chars"].dataType)
    return out.select(*(changed[c].alias(c) if c in changed else quoted(c) for c in docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that five-word shingles link at 0.8 or more, directly or over others, the one with the least id stays.

    Documents without a word are linked with nothing and stay; rows without an id go, and one row stays of an id that repeats.
    """
    docs = _one_each(docs)
    of, = _free(docs, "_of")
    gone = hyperminhash.near_duplicates(docs).where("not kept").select(F.col("doc_id").alias(of))
    return docs.join(gone, F.col(of) == F.col("doc_id"), "left_anti")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage like a benchmark item go."""
    return decontamination.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with the ids of their tokens, which replace a column of that name; a null text has none."""
    return sentencepiece_codec.encode(docs.drop("token_ids"))


STAGES = [("language", language), ("lines", lines), ("near_duplicates", near_duplicates), ("decontaminate", decontaminate), ("tokenize", tokenize)]

# Alignment, fingerprints, trained trees and a tokenizer are beyond SQL; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        with temporary(spark) as keep:  # what a stage writes on its way goes once its result is written
            docs = keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
