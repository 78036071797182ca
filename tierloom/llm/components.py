"""Connected components of a link table by alternating large and small stars, one staged table per round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierloom.sources.staging import stage


def _large_star(edges: DataFrame) -> DataFrame:
    """Links each node's greater neighbours to the smallest node among it and its neighbours."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where(
        "u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Links each node, and its smaller neighbours, to the smallest of these."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """node, root: root is the smallest node reachable, for every node of links (columns u, v of one long type each).

    Each round joins the links with the smallest neighbour per node, so a hub is a skewed join side that adaptive
    execution splits, never one list. Rounds end when the links no longer change (logarithmic in practice).
    """
    edges = stage(links.where("u <> v").select("u", "v").distinct(), "links")

    def mark(df):
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    before = mark(edges)
    while before[0]:
        edges = stage(_small_star(_large_star(edges)), "links")
        after = mark(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
