"""Distributed union-find: connected components by randomised contraction of an edge table.

Each round every node hooks onto the neighbour with the smallest hash, if smaller than its
own, edges are relabelled and deduplicated, and about half of the remaining nodes go. Two rounds
share their hashes: in the second, what is left of a star hooks onto its smallest node at once. Rounds
are written tables in the shared folder; nothing but a count reaches the driver.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmark.llm.common import handover, release


def _simple(edges: DataFrame) -> DataFrame:
    return edges.where(F.col("a") != F.col("b")).select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _relabel(edges: DataFrame, moved: DataFrame, end: str) -> DataFrame:
    other = "b" if end == "a" else "a"
    m = moved.select(F.col("node").alias(end), "parent")
    return edges.join(m, end, "left").select(F.coalesce("parent", end).alias(end), other)


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b: long); component is the smallest node.

    Null ends are ignored; self loops alone give no row; no edges give an empty table.
    """
    spark = edges.sparkSession
    current = handover(_simple(edges.where(F.col("a").isNotNull() & F.col("b").isNotNull())), "cc-edges")
    first, rounds = current, []
    while not current.isEmpty():
        seed = F.lit(len(rounds) // 2 + 1)
        both = current.select(F.col("a").alias("node"), F.col("b").alias("next")).union(
            current.select(F.col("b").alias("node"), F.col("a").alias("next")))
        best = both.groupBy("node").agg(
            F.min_by("next", F.xxhash64("next", seed)).alias("parent"), F.min(F.xxhash64("next", seed)).alias("h"))
        moved = handover(best.where(F.col("h") < F.xxhash64("node", seed)).select("node", "parent"), "cc-moved")
        rounds.append(moved)
        after = handover(_simple(_relabel(_relabel(current, moved, "a"), moved, "b")), "cc-edges")
        if current is not first:
            release(spark, current)
        current = after
    nodes = first.select(F.col("a").alias("node")).union(first.select(F.col("b").alias("node"))).distinct()
    at = nodes.withColumn("root", F.col("node"))
    for moved in rounds:
        m = moved.select(F.col("node").alias("root"), "parent")
        at = at.join(m, "root", "left").select("node", F.coalesce("parent", "root").alias("root"))
    at = handover(at, "cc-roots")
    smallest = at.groupBy("root").agg(F.min("node").alias("component"))
    out = handover(at.join(smallest, "root").select("node", "component"), "cc-components")
    for df in (first, at, *rounds):
        release(spark, df)
    return out
