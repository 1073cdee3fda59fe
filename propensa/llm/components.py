"""Connected components of an edge table, by alternating stars in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensa.session import written


def components(edges: DataFrame) -> DataFrame:
    """node, root (the lowest node of its component) for all nodes of
    ``edges`` (a bigint, b bigint).

    Each round links every neighbour of a node to the lowest of them, first
    those above the node, then those below.  A hot node's links are combined
    before the shuffle, and the join has one row per node on its other side.
    Rounds end when the links no longer change.
    """
    pair = [F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")]
    links = written(edges.where("a != b").select(pair).distinct(), "links")
    state = None
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        larger = both.join(lowest, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        larger = larger.where("a != b").distinct()
        lowest = larger.groupBy("a").agg(F.min("b").alias("low"))
        smaller = larger.join(lowest, "a").where("b != low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        links = written(smaller.unionByName(lowest.withColumnRenamed("low", "b")).distinct(), "links")
        new = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if new == state:
            break
        state = new
    roots = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
