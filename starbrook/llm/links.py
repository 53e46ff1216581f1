"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starbrook.session import cut_lineage


def _state(edges: DataFrame) -> tuple:
    """Number of edges and a fingerprint of them all."""
    both = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u")))
    return tuple(both.first())


def _least(edges: DataFrame, name: str) -> DataFrame:
    """The smallest neighbour of every ``u``. Counted apart, so that a node with very many
    neighbours is combined before the shuffle and its rows can be split in the join."""
    return edges.groupBy("u").agg(F.min("v").alias(name))


def _large_star(edges: DataFrame) -> DataFrame:
    """Hangs the larger neighbours of a node on the smallest of its neighbourhood."""
    near = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _least(near, "m").withColumn("m", F.least("m", "u"))
    return (
        near.filter(F.col("v") > F.col("u"))
        .join(least, "u")
        .filter("v != m")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Hangs a node and its smaller neighbours on the smallest of them. ``u`` > ``v`` holds."""
    least = _least(edges, "m")
    moved = edges.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``component`` (its smallest node) of every node of the links ``u``, ``v``.

    An empty table has no nodes. Loops and repeated links change nothing.
    """
    ordered = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    current = cut_lineage(ordered.filter("u != v").distinct())
    before = None
    while (now := _state(current)) != before and now[0]:
        before = now
        current = cut_lineage(_small_star(_large_star(current)))
    members = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return members.unionByName(roots)
