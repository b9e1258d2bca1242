"""Connected components of a graph given as edges, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldbook.session import split_skewed_joins, stored

PARTS = 64


def with_least(pairs: DataFrame, neighbours: DataFrame) -> DataFrame:
    """``pairs`` (a, b) with ``m``, the least neighbour of a by ``neighbours`` (a, b), which hold every pair of a.

    A hub's pairs are dealt over ``PARTS`` parts by their other end: the least of each part comes first, then the
    least of a hub's parts, and pairs meet their own part's row. So no task holds a hub's pairs.
    """
    part = F.pmod(F.xxhash64("b"), F.lit(PARTS)).alias("part")
    parts = neighbours.groupBy("a", part).agg(F.min("b").alias("m"))
    least = parts.withColumn("m", F.min("m").over(Window.partitionBy("a")))
    return pairs.select("a", "b", part).join(least, ["a", "part"]).select("a", "b", "m")


def components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest node) for every node of the edges (a, b); nulls and loops link nothing.

    In a round every node hands its larger neighbours, then its smaller ones, to its smallest
    neighbour, until the edges are stars. Distances halve, so the rounds grow with the logarithm of the
    longest path. The pairs of a hub are spread over parts (``with_least``). Each round's edges are written to the shared folder.
    """
    split_skewed_joins(edges.sparkSession)
    a, b = F.col("a"), F.col("b")
    edges = edges.where("a <> b").select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct()
    edges, before = stored(edges, "edges"), None
    while True:
        turned = edges.select(b.alias("a"), a.alias("b"))
        # Large star: a's larger neighbours go to the smallest of a and its neighbours.
        large = with_least(turned, edges.unionByName(turned)).select(b.alias("a"), F.least("a", "m").alias("b")).distinct()
        # Small star: a and its smaller neighbours go to the smallest of them.
        small = with_least(large, large).select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(b.alias("a"), F.col("m").alias("b")))).alias("e"))
        edges = stored(small.select("e.*").where("a <> b").distinct(), "edges")
        after = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
