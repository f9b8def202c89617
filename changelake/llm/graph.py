"""Connected components of a table of links, by alternating large-star and small-star steps on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .scratch import Scratch


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component) for every node of links (a, b), whose two ends may be in any order; component is the least node reachable.

    Edges (u, v) with v < u. In a round, the large star links u to the least neighbour of v, then the small star links u, and all to which u
    has links, to the least of those; until nothing changes, in rounds that grow with the logarithm of the longest chain. Nothing is
    collected but a count and a checksum for each round. The least node of a large component is the v of many edges; it is a key of the
    join alone, whose skewed partitions adaptive execution splits, and not of a group, since nodes have links to few lesser ones.
    """
    edges = scratch.table(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    mark = None
    while True:
        least = edges.groupBy(F.col("u").alias("v")).agg(F.min("v").alias("m"))
        large = edges.join(least, "v", "left").select("u", F.coalesce("m", "v").alias("v"))
        down = large.withColumn("m", F.min("v").over(Window.partitionBy("u")))
        pair = lambda c: F.struct(F.col(c).alias("u"), F.col("m").alias("v"))
        small = down.select(F.explode(F.array(pair("u"), pair("v"))).alias("e")).select("e.*").where("u <> v").distinct()
        new = scratch.table(small, "edges")
        now = tuple(new.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        scratch.drop(edges)
        edges = new
        if now == mark:
            break
        mark = now
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
