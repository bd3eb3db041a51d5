"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from releasekit.llm.base import stored


def _oriented(edges: DataFrame, u: Column, v: Column) -> DataFrame:
    return stored(edges.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).where("u <> v").distinct(), "edges")


def _looked_up(rows: DataFrame, column: str, parent: DataFrame, into: str) -> DataFrame:
    """``rows`` with the parent of ``column`` (itself if it has none) in ``into``.  A hub stands in
    many rows and once in ``parent``, a stored table, so adaptive execution can split it."""
    return rows.join(parent.select(F.col("u").alias(column), F.col("p").alias("__p")), column, "left").withColumn(into, F.coalesce("__p", F.col(column))).drop("__p")


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node of the component) for every node of ``edges`` (``u,
    v``, longs; loops and repeated edges allowed).

    Each round hangs every node that has smaller neighbours below the smallest of them (a
    minimum per node, summed up before the shuffle), shortens the paths to their roots by
    doubling, and puts the roots in the edges' places, until no edge is left.  Every round
    joins all nodes but local minima; the stars around least nodes that the callers give need
    two or three.  Neighbourhoods are never gathered.  All steps are written as tables in the shared folder."""
    edges = _oriented(edges, F.col("u"), F.col("v"))
    named = edges.select(F.col("u").alias("node")).unionByName(edges.select(F.col("v").alias("node"))).distinct().withColumn("component", F.col("node"))
    while not edges.isEmpty():
        parent = stored(edges.groupBy("u").agg(F.min("v").alias("p")), "parents")
        while True:
            higher = stored(_looked_up(parent, "p", parent, "g"), "parents")
            parent = higher.select("u", F.col("g").alias("p"))
            if higher.where("g <> p").isEmpty():
                break
        named = stored(_looked_up(named, "component", parent, "root").select("node", F.col("root").alias("component")), "named")
        edges = _oriented(_looked_up(_looked_up(edges, "u", parent, "a"), "v", parent, "b"), F.col("a"), F.col("b"))
    return named
