"""What the operators share about a table of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HELD_OUT_HASH = "crc32(cast({id} as string))"


def quoted(name: str):
    """A column by its exact name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def one_row_per_id(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Two columns, doc_id and text, with one row per id.

    Rows without an id are left out; of rows that repeat an id, the one with the smallest text stays (null first).
    The ids alone are counted, so the texts are only shuffled if an id does repeat.
    """
    two = docs.select(quoted(id).alias("doc_id"), quoted(text).alias("text")).where("doc_id is not null")
    if two.groupBy("doc_id").count().where("count > 1").isEmpty():
        return two
    return two.groupBy("doc_id").agg(F.min(F.struct(F.col("text").isNotNull(), "text")).alias("least")).select("doc_id", "least.text")
