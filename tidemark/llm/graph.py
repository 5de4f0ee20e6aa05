"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared


def components(links: DataFrame) -> DataFrame:
    """node and component (the smallest node that it reaches), for every node of the links a, b.

    Each round joins the links with the smallest neighbour of each node. The smallest neighbours are
    written, so that the join has a shuffle on either side and Spark can split a node with very many
    links. Rounds grow with the logarithm of the longest path. Links of a node with itself and null
    ends are left out, repeated links count once.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = shared.written(edges, "links")
    before = None
    while True:
        with shared.scratch():
            # Large star: the greater neighbours of each node are hung on its smallest neighbour.
            both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
            least = shared.written(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
            large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
            large = shared.written(large, "large")
            # Small star: a node and its smaller neighbours are hung on the smallest of them.
            least = shared.written(large.groupBy("u").agg(F.min("v").alias("m")), "least")
            hung = large.join(least, "u")
            small = hung.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).distinct()
            after = shared.written(small, "links", lasting=True)
        shared.drop_written(edges)
        edges = after
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if state == before:
            break
        before = state
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
