"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.plans.scratch import freed, stored


def _star(pairs: DataFrame, large: bool) -> DataFrame:
    """Link neighbours of each node to its least neighbour: the larger ones, or the smaller ones and itself.

    Least neighbours are a map-side combined aggregate; the join that follows is plain, so AQE may
    split a node with very many neighbours.
    """
    if large:
        pairs = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        pairs = pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("n"), F.least("u", "m").alias("m"))
    joined = pairs.join(least, F.col("u") == F.col("n"))
    if large:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select(F.col("n").alias("u"), F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def _settled(pairs: DataFrame) -> bool:
    """Whether every node is linked with one smaller node, which is linked with no smaller one: stars around least nodes.

    A node's links are counted where they are read, so a node with very many is one row of each task.
    """
    ends = pairs.selectExpr("u AS n", "1 AS up", "0 AS down").unionByName(pairs.selectExpr("v AS n", "0 AS up", "1 AS down"))
    nodes = ends.groupBy("n").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return not nodes.agg(F.bool_or(F.expr("up > 1 OR up > 0 AND down > 0"))).first()[0]


def stars(edges: DataFrame) -> DataFrame:
    """(u, v): each node of ``edges`` (u, v: bigint) but the least of its component, with that least one.

    Loops, repeated edges and nulls are ignored. Every round is written to the shared folder, so lineage
    stays short, and the round before is removed. Rounds grow with the logarithm of a component's diameter, not with its size.
    What is stars already takes no round. The result is stored; see ``freed``.
    """
    pairs = stored(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    while not _settled(pairs):
        before, pairs = pairs, stored(_star(_star(pairs, True), False), "edges")
        freed(before)
    return pairs


def rooted(pairs: DataFrame) -> DataFrame:
    """(node, root) for each node of ``stars``; a root is its own."""
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of ``edges`` (u, v: bigint); root is the least node it is connected with."""
    return rooted(stars(edges))
