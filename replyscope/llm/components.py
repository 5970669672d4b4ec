"""Connected components by alternating star contraction.

Every round hangs the neighbours of a node onto the smallest of them, first the
larger ones (large star), then the smaller ones (small star); the number of rounds
grows with the logarithm of the longest path (Kiveris and others, "Connected
Components in MapReduce and Beyond", 2014). A node's minimum is a grouped
aggregate, combined before the shuffle; its edges are then joined to that one row,
so a node with very many neighbours is never gathered in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replyscope.llm.common import own_scratch, stored


@own_scratch
def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the undirected edges (a, b); the
    component is the smallest node reachable. Nulls and self-loops are ignored,
    repeated edges count once; without edges the result is empty."""
    now = edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    now = stored(now.distinct(), "edges")
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        low = stored(low, "low")  # a plain table on both sides lets Spark split the rows of a hot node
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stored(large, "large")
        low = stored(large.groupBy("u").agg(F.min("v").alias("m")), "low")
        small = large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = stored(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
        rows, nodes = now.agg(F.count("u"), F.countDistinct("u")).first()
        if rows == nodes and now.join(now.select(F.col("v").alias("u")), "u", "left_semi").isEmpty():
            break
    roots = now.select(F.col("v").alias("node")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots.select("node", F.col("node").alias("component")))
