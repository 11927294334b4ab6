"""Connected components of a distributed edge table, to the fixed point."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfuse.session import dropped, saved


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's smallest neighbour (or itself)."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (both.join(least, "u").where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and all its smaller neighbours are tied to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    return (down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct())


def _stars(edges: DataFrame) -> bool:
    """Whether every node of a larger end has one edge and is no smaller end: the smaller ends are then the components."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select("v", F.lit(0), F.lit(1)))
    held = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return held.where("up > 1 OR up = 1 AND down = 1").isEmpty()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node``, ``component`` (the smallest node reachable) of every node with a link to another.

    Alternates two star operations, each a join on a node and its smallest neighbour,
    until all edges form stars; the number of rounds grows with the logarithm of the longest
    chain, and there is no cap on it. Each round is a written table, so a lost executor
    costs one round. Edges may repeat, point either way, or tie a node to itself; edges
    with a null end are ignored. The edge count never grows.
    """
    now = saved(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct(), "edges")
    while not _stars(now):
        large = saved(_large_star(now), "large-star")
        before, now = now, saved(_small_star(large), "small-star")
        dropped(before)
        dropped(large)
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        now.select(F.col("v"), F.col("v")).distinct())
