"""Connected components of a table of links, without bringing them to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tierwatch.session import materialize


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of the links ``a, b``; the component is its smallest node.

    Alternates two steps, each of which hangs the neighbours of a node on the smallest of them:
    first the larger ones, then the smaller ones, until nothing changes. Every round is stored,
    so a lost executor costs the current round only. Rounds grow with the logarithm of the
    longest chain of links.
    """
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    edges, before = materialize(edges, "links"), None
    while True:
        both = edges.union(edges.select("b", "a"))
        smallest = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
        edges = (both.filter("b > a").join(smallest, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
                 .filter("a <> b").distinct())
        smallest = edges.groupBy("a").agg(F.min("b").alias("least"))
        hung = edges.join(smallest, "a")
        edges = (hung.select(F.col("b").alias("a"), F.col("least").alias("b"))
                 .union(hung.select("a", F.col("least"))).filter("a <> b").distinct())
        edges = materialize(edges, "links")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                edges.select(F.col("b"), F.col("b"))).distinct()
        before = state
