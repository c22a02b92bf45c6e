"""Connected components of a graph that lies in tables: stars are formed round the smallest node until nothing moves."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfspark.llm.common import stored


def _linked_to_least(edges: DataFrame, larger_only: bool) -> DataFrame:
    """Each node's neighbours tied to the least node of its neighbourhood: the larger ones, or it and the smaller ones."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if not larger_only:
        both = both.filter("b < a")
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    tied = both.join(least, "a")
    out = tied.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")) if larger_only else (
        tied.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    )
    return out.filter("a != b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b) that isn't the least of its component.

    Alternating large-star and small-star steps, each written to the shared folder; the number of rounds grows with the
    logarithm of the largest component. Only a count and a checksum of each round reach the driver.
    """
    now = stored(edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = mark
        now = stored(_linked_to_least(_linked_to_least(now, True), False), "edges")
