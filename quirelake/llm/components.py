"""Connected components of a graph whose edges are a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirelake.session import release, stage


def components(edges: DataFrame, most_rounds: int = 40) -> DataFrame:
    """``node`` and ``component``, the least node that it is connected with, for every node of ``edges``.

    ``edges`` has ``a`` and ``b``; loops and repeats do no harm. Alternating large-star and
    small-star steps: each halves the distance to the least neighbour, so a path of n nodes takes about
    log n rounds; a node with many neighbours is a group of rows in a shuffled aggregate, never a
    list in one task. Every round is written, which cuts the lineage, and the one before is deleted. No rows give no rows.
    """
    edges = stage(edges.select("a", "b"))
    pairs = stage(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    last = None
    for _ in range(most_rounds):
        both = pairs.union(pairs.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")).where("u <> v")
        before, pairs = pairs, stage(small.union(low.select("u", F.col("m").alias("v"))).distinct())
        release(before)
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == last:
            break
        last = tuple(now)
    else:
        raise RuntimeError("components did not settle")
    return nodes.join(pairs.select(F.col("u").alias("node"), F.col("v").alias("component")), "node", "left").select("node", F.coalesce("component", "node").alias("component"))
