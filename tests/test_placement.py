"""Jobs by cost over tasks."""

import random

import pytest
from pyspark.sql import functions as F

from folioframe.operators import placement


def loads(places, tasks):
    got = {r["task"]: r["c"] for r in places.groupBy("task").agg(F.sum("cost").alias("c")).collect()}
    return [got.get(k, 0.0) for k in range(tasks)]


@pytest.mark.parametrize(("n", "tasks", "spread"), [(200, 7, "even"), (3000, 16, "long"), (40, 8, "long"), (20_000, 5, "even")])
def test_fullest_task(spark, n, tasks, spread):
    """The fullest task has at most 4/3 of the mean, or the dearest job alone."""
    r = random.Random(n)
    costs = [r.paretovariate(1.1) if spread == "long" else r.uniform(1, 3) for _ in range(n)]
    jobs = spark.createDataFrame([(f"job {k}", c) for k, c in enumerate(costs)], "path string, cost double").repartition(5)
    places = placement.placed(jobs, "path", F.col("cost"), tasks)
    assert places.count() == n and {c.name for c in places.schema} == {"path", "task", "cost"}
    assert max(loads(places, tasks)) <= max(4 / 3 * sum(costs) / tasks, max(costs) * 1.001)


def test_tasks_by_number_and_dearest_first(spark):
    jobs = spark.createDataFrame([(f"j{k}", float(k)) for k in range(30)] + [("j3", 100.0), (None, 2.0), ("n", None), ("m", -4.0)], "path string, cost double")
    places = placement.placed(jobs, "path", F.col("cost"), 4)
    rows = placement.by_cost(jobs.select("path", F.col("cost").alias("x"), F.lit(1).alias("task")), places, "path", 4)
    assert rows.columns == ["path", "x", "task"] and rows.count() == jobs.count()
    cost = {r["path"]: r["cost"] for r in places.collect()}
    assert cost["j3"] == 103.0 and cost["n"] == cost["m"] == 0.0
    per_task = rows.rdd.glom().collect()
    task = {r["path"]: r["task"] for r in places.collect()}
    for k, part in enumerate(per_task):
        assert {task[r["path"]] for r in part} <= {k}
        assert [cost[r["path"]] for r in part] == sorted((cost[r["path"]] for r in part), reverse=True)


def test_no_jobs(spark):
    none = spark.createDataFrame([], "path string, cost double")
    places = placement.placed(none, "path", F.col("cost"), 3)
    assert places.count() == 0 and placement.by_cost(none, places, "path", 3).count() == 0


def test_equal_costs():
    assert sorted(placement.dealt([1.0] * 9, 3)) == [0, 0, 0, 1, 1, 1, 2, 2, 2]
    assert placement.dealt([5, 1, 4, 3], 2) in ([0, 1, 1, 0], [0, 0, 1, 1])
