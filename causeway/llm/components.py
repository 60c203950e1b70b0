"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from causeway.session import cut_lineage


def min_labels(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, label) of every node of ``edges``; the label is the smallest node of its component.

    Each round links every node's larger, then its smaller neighbours to its least neighbour, until
    the edges are stars; rounds grow with the logarithm of the graph's size. The least neighbour
    comes from a combined aggregate, so a node with very many edges does not meet in one task.
    """
    pairs = edges.select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v")).filter("u != v").distinct()
    pairs = cut_lineage(pairs)
    while True:
        # large star: of each node, the strictly larger neighbours go to its least neighbour or itself
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("m").alias("u"), "v").filter("u != v").distinct()
        # small star: of each node, the smaller neighbours and itself go to its least neighbour
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(least, "v").select(F.col("m").alias("u"), F.col("u").alias("w")).filter("u != w").select(
            "u", F.col("w").alias("v")).unionByName(least.select(F.col("m").alias("u"), "v")).distinct()
        small = cut_lineage(small)
        # stars: no node is both a centre and a leaf, and no leaf has two centres
        centres = small.select("u").distinct()
        mixed = small.join(centres.withColumnRenamed("u", "c"), F.col("v") == F.col("c"), "left_semi")
        if mixed.isEmpty() and small.groupBy("v").count().filter("count > 1").isEmpty():
            break
        pairs = small
    return small.select(F.col("v").alias("node"), F.col("u").alias("label")).unionByName(
        centres.select(F.col("u").alias("node"), F.col("u").alias("label")))
