"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import attach_by_key, materialize

#: Parts into which the neighbours of one node are dealt.
NODE_SALTS = 64


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of links (a, b): component is the smallest node it can reach.

    Alternates two star steps, in which each node hangs its larger, then its smaller neighbours on the smallest node it
    sees, until every node hangs on its smallest. Each step is one aggregation and one join; what it makes is written
    down, so lineage stays short and nothing but a count comes to the driver.
    """
    stars = materialize(links.where("a <> b").select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("to")).distinct(), "links")
    while True:
        both = stars.union(stars.select("to", "node"))
        least = both.groupBy("node").agg(F.min("to").alias("m")).select("node", F.least("m", "node").alias("m"))
        large = attach_by_key(both.where("to > node"), ["node"], least, ["to"], NODE_SALTS).select(F.col("to").alias("node"), F.col("m").alias("to")).where("node <> to").distinct()
        large = materialize(large, "links")
        least = large.groupBy("node").agg(F.min("to").alias("m"))
        small = attach_by_key(large, ["node"], least, ["to"], NODE_SALTS)
        small = small.select("node", F.col("m").alias("to")).union(small.where("to <> m").select(F.col("to").alias("node"), F.col("m").alias("to"))).distinct()
        small = materialize(small, "links")
        # done when no node has two parents and no parent has one
        if not small.groupBy("node").agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).count() and not small.join(small.select(F.col("node").alias("to")), "to", "left_semi").limit(1).count():
            stars = small
            break
        stars = small
    return stars.select("node", F.col("to").alias("component")).union(stars.select(F.col("to").alias("node"), F.col("to").alias("component")).distinct())
