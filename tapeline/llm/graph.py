"""Connected components of a graph of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeline.llm.common import cut


def smallest_reachable(links: DataFrame) -> DataFrame:
    """node, root for each node of the links (a, b): the smallest node reachable.

    Stars are made by turns out of each node and its larger neighbours, and of each
    node and its smaller ones, until nothing moves; the links between distinct nodes
    never grow in number, and a task sees a node's smallest neighbour, not all."""
    links = links.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    links = cut(links.distinct())
    before = None
    while before != (now := fingerprint(links)):
        before = now
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m"))
        low = low.select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(low, "a")
        large = large.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(
            F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")
        )
        links = cut(small.select("e.*").filter("a <> b").distinct())
    roots = links.select(F.col("b").alias("node")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        roots.select("node", F.col("node").alias("root"))
    )


def fingerprint(links: DataFrame) -> tuple:
    """Number and sum of hashes of distinct rows: equal for equal rows."""
    both = F.struct(F.xxhash64("a", "b").alias("x"), F.crc32(F.concat("a", "b")).alias("y"))
    total = links.select(both.alias("h")).agg(
        F.count("*"), F.sum(F.col("h.x").cast("decimal(38,0)")), F.sum("h.y")
    )
    return tuple(total.collect()[0])
