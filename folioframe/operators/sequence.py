"""Ordered-sequence operators: runs, carries, ranges and tiered matches, each within a key.

No window here lacks a partition key; every order must be total within a key for a defined result.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec


def ordered(keys: Sequence[str], order: Sequence[str | Column]) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(*order)


def running(keys: Sequence[str], order: Sequence[str | Column]) -> WindowSpec:
    return ordered(keys, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def islands(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], starts: Column, name: str = "island") -> DataFrame:
    """Numbers the runs of rows of a key: a row where ``starts`` holds begins a new one."""
    return df.withColumn(name, F.sum(F.coalesce(starts.cast("int"), F.lit(0))).over(running(keys, order)))


def islands_after(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], ends: Column, name: str = "island") -> DataFrame:
    """As ``islands``, but a row where ``ends`` holds is the last of its run."""
    window = ordered(keys, order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn(name, F.coalesce(F.sum(ends.cast("int")).over(window), F.lit(0)))


def change_islands(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], value: Column, name: str = "island") -> DataFrame:
    """Runs of equal values."""
    marked = df.withColumn("__value", value)
    changed = ~F.col("__value").eqNullSafe(F.lag("__value").over(ordered(keys, order)))
    return islands(marked.withColumn("__changed", changed), keys, order, F.col("__changed"), name).drop("__value", "__changed")


def gap_islands(df: DataFrame, keys: Sequence[str], position: str, tolerance: int, name: str = "island") -> DataFrame:
    """Runs of positions of which neighbours lie at most ``tolerance`` apart."""
    marked = df.withColumn("__gap", F.col(position) - F.lag(position).over(ordered(keys, [position])) > tolerance)
    return islands(marked, keys, [position], F.col("__gap"), name).drop("__gap")


def forward_fill(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], value: Column, name: str) -> DataFrame:
    """The last non-null value up to and with each row."""
    return df.withColumn(name, F.last(value, ignorenulls=True).over(running(keys, order)))


def asof_backward(left: DataFrame, right: DataFrame, keys: Sequence[str], at: str, value: str, name: str) -> DataFrame:
    """For each row of ``left`` the ``value`` of the latest row of ``right`` at or before it: one shuffle of the union by
    key instead of a range join."""
    columns = left.columns
    both = left.withColumn("__right", F.lit(0)).withColumn("__v", F.lit(None).cast(right.schema[value].dataType)).unionByName(
        right.select(*keys, at, F.lit(1).alias("__right"), F.col(value).alias("__v")), allowMissingColumns=True
    )
    filled = both.withColumn(name, F.last("__v", ignorenulls=True).over(running(keys, [at, F.desc("__right")])))
    return filled.where("__right = 0").select(*columns, name)


def next_bound(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], start: str, last: Column, name: str = "end") -> DataFrame:
    """The end of each row's range: one before the next start, never before its own; the last row ends at ``last``."""
    following = F.lead(start).over(ordered(keys, order))
    return df.withColumn(name, F.when(following.isNotNull(), F.greatest(F.col(start), following - 1)).otherwise(last))


def range_owner(points: DataFrame, ranges: DataFrame, keys: Sequence[str], at: str, start: str, end: str, owner: str, order: str, width: int = 64) -> DataFrame:
    """Each point with the last range in ``order`` that holds it, null if none does. Positions are whole numbers; points
    and ranges meet by key and by stretch of ``width`` positions, which a range enters once for each that it touches.
    Points of a key and position are joined once, however many rows they have."""
    places = points.select(*keys, at).distinct().withColumn("__part", F.floor(F.col(at) / width))
    r = ranges.where(F.col(start) <= F.col(end)).select(*[F.col(k).alias(f"__{k}") for k in keys], F.col(start).alias("__s"), F.col(end).alias("__e"), F.col(owner).alias("__owner"), F.col(order).alias("__o"))
    r = r.withColumn("__r", F.explode(F.sequence(F.floor(F.col("__s") / width), F.floor(F.col("__e") / width))))
    same = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"__{k}") for k in keys]) & (F.col("__part") == F.col("__r"))
    owned = places.join(r, same & F.col(at).between(F.col("__s"), F.col("__e"))).groupBy(*keys, at).agg(F.max_by("__owner", "__o").alias(owner))
    return points.join(owned, [*keys, at], "left")


def first_match_by_tier(queries: DataFrame, key: str, tiers: Sequence[DataFrame]) -> DataFrame:
    """The matches of the first tier that has any for a key; later tiers see only keys without a match so far.

    Each tier has the columns key, and equal others; ``tier`` numbers them from 1.
    """
    out, left = None, queries.select(key).distinct()
    for n, tier in enumerate(tiers, 1):
        hit = tier.join(left, key, "left_semi").withColumn("tier", F.lit(n))
        out = hit if out is None else out.unionByName(hit)
        left = left.join(tier.select(key).distinct(), key, "left_anti")
    return out
