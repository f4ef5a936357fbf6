"""Jobs of very unlike cost over tasks: the longest first, each to the task with the least to do.

Jobs that alone make up a part of a task's share are few, whatever the number of all jobs, and are dealt one by one. The
others are summed in some hash buckets for each task and dealt by bucket, among the large ones by their cost. So the
driver sees a number of rows that follows the tasks, not the jobs. Each task then takes its rows by its number, without
the collisions of a hash, the dearest first.

Defined results: null and negative costs count as 0; jobs of one key go together, with the sum of their costs; without
jobs there is nothing to place.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LARGE_SHARE = 8
BUCKETS = 32


def dealt(costs: list[float], tasks: int) -> list[int]:
    """The task of each item, the dearest items first, each to the task with the least so far."""
    heap = [(0.0, k) for k in range(tasks)]
    out = [0] * len(costs)
    for at in sorted(range(len(costs)), key=lambda k: -costs[k]):
        load, task = heapq.heappop(heap)
        out[at] = task
        heapq.heappush(heap, (load + costs[at], task))
    return out


def placed(jobs: DataFrame, key: str, cost: Column, tasks: int) -> DataFrame:
    """(key, task, cost) of each job of ``jobs``, a job being the rows of a key."""
    known = jobs.groupBy(key).agg(F.sum(F.greatest(F.coalesce(cost.cast("double"), F.lit(0.0)), F.lit(0.0))).alias("cost"))
    total = known.agg(F.coalesce(F.sum("cost"), F.lit(0.0)).alias("t")).head()["t"]
    large = F.col("cost") * tasks * LARGE_SHARE > F.lit(total)
    bucket = F.when(~large, F.pmod(F.xxhash64(key), F.lit(tasks * BUCKETS)))
    # One row for each large job and each bucket.
    items = known.groupBy(bucket.alias("bucket"), F.when(large, F.col(key)).alias("own")).agg(F.sum("cost").alias("cost")).orderBy("bucket", "own").collect()
    tasks_of = dealt([r["cost"] for r in items], tasks)
    kind = known.schema[key].dataType.simpleString()
    table = known.sparkSession.createDataFrame([(r["bucket"], r["own"], t) for r, t in zip(items, tasks_of, strict=True)], f"__bucket long, __own {kind}, task int")
    match = F.col("__bucket").eqNullSafe(bucket) & F.col("__own").eqNullSafe(F.when(large, F.col(key)))
    return known.join(F.broadcast(table), match).select(key, "task", "cost")


def by_cost(rows: DataFrame, places: DataFrame, key: str, tasks: int) -> DataFrame:
    """``rows`` in their tasks, the dearest first in each."""
    at = places.select(F.col(key).alias("__key"), F.col("task").alias("__task"), F.col("cost").alias("__cost"))
    mine = rows.join(at, F.col(key).eqNullSafe(F.col("__key")))
    return mine.repartitionById(tasks, F.col("__task")).sortWithinPartitions(F.desc("__cost"), "__key").drop("__key", "__task", "__cost")
