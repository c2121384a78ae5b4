"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def smallest_reachable(links: DataFrame) -> DataFrame:
    """node and root (the smallest node reachable) of every node of links (a, b), two longs.

    Large-star and small-star steps in turn: every node hands its larger
    neighbours, then its smaller ones, to the smallest of them, until all links
    point at roots. Each step shuffles the links once by node, pre-aggregates
    the smallest neighbour, and is written to the checkpoint folder, so a lost
    executor costs one step and lineage stays short. Nothing is collected but
    one count per round.
    """
    links = links.where("a <> b").select(F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high"))
    links = links.distinct().checkpoint()
    before = None
    while True:
        links = _small_star(_large_star(links)).checkpoint()
        # the links as a set are a fixed point exactly when no link changes; sums of hashes tell
        row = links.agg(F.count("*"), F.sum(F.xxhash64("low", "high").cast("decimal(38,0)"))).first()
        if tuple(row) == before:
            break
        before = tuple(row)
    roots = links.groupBy(F.col("high").alias("node")).agg(F.min("low").alias("root"))
    return roots.union(links.select(F.col("low").alias("node"), F.col("low").alias("root")).distinct())


def _large_star(links: DataFrame) -> DataFrame:
    """Every node hands its larger neighbours to the smallest of its neighbours and itself."""
    both = links.union(links.select(F.col("high"), F.col("low"))).toDF("node", "other")
    least = both.groupBy("node").agg(F.min("other").alias("least")).select("node", F.least("node", "least").alias("least"))
    return (
        both.where("other > node").join(least, "node")
        .select(F.col("least").alias("low"), F.col("other").alias("high")).distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    """Every node hands its smaller neighbours, and itself, to the smallest of them."""
    least = links.groupBy("high").agg(F.min("low").alias("least"))
    moved = (
        links.join(least, "high").where("low <> least")
        .select(F.col("least").alias("low"), F.col("low").alias("high"))
    )
    return moved.union(least.select(F.col("least").alias("low"), "high")).distinct()
