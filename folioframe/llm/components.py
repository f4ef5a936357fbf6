"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioframe.scratch import Scratch


def components(edges: DataFrame, scratch: Scratch, rounds: int = 60) -> DataFrame:
    """(node, component) for every node with an edge; the component is its smallest node.

    ``edges`` has long columns a and b in either direction. Each round replaces edges by at most as many edges to
    local minima and is written out, so a hub's neighbours are only ever counted by a partial minimum.
    """
    now = scratch.save(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct())
    before = None
    for _ in range(rounds):
        both = now.select("u", "v").union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        after = scratch.save(small.where("u > v").distinct())
        sums = [x.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).head() for x in (now, after)]
        if before is not None:
            scratch.drop(before)
        before, now = now, after
        if tuple(sums[0]) == tuple(sums[1]):
            break
    else:
        raise RuntimeError(f"components are not settled after {rounds} rounds")
    # All edges are now stars: each node points to the smallest of its component.
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
