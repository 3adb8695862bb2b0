"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.sources.shared import durable


def _towards_least(links: DataFrame, ends: str) -> DataFrame:
    """Link every neighbour `ends` picks to the least neighbour of its middle; one aggregate, one join, no neighbour lists."""
    least = links.groupBy(F.col("a").alias("m")).agg(F.min("b").alias("low")).withColumn("low", F.least("m", "low"))
    return links.join(least, F.col("a") == F.col("m")).select(F.expr(ends).alias("b"), F.col("low").alias("a"), F.col("a").alias("m"))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of a link; component is the least node that can be reached.

    Each round writes its links to the shared folder, so that lineage stays short. Stars are settled from the start, chains in about log n rounds.
    Links with a null end are ignored; an empty table gives an empty result.
    """
    now = durable(links.select(F.greatest(a, b).alias("b"), F.least(a, b).alias("a")).where(f"`{a}` <> `{b}`").distinct(), "links")
    while not _stars(now):
        both = now.select("a", "b").union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _towards_least(both, "b").where("b > m and b <> a").select("a", "b")
        linked = _towards_least(large.select(F.col("b").alias("a"), F.col("a").alias("b")), "struct(a, b)")
        now = durable(linked.select(F.explode(F.array("b.a", "b.b")).alias("b"), F.col("a")).where("a <> b").distinct(), "links")
    return now.select(F.col("b").alias("node"), F.col("a").alias("component")).union(now.select("a", "a").distinct())


def _stars(links: DataFrame) -> bool:
    """Whether every b has one a, and no a is a b: then a is the least of its component."""
    ends = links.select(F.col("b").alias("node"), F.lit(1).alias("low"), F.lit(0).alias("high")).union(links.select("a", F.lit(0), F.lit(1)))
    return ends.groupBy("node").agg(F.sum("low").alias("low"), F.max("high").alias("high")).where("low > 1 or low = 1 and high = 1").isEmpty()
