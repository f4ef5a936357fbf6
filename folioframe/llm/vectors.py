"""Usable vectors of a table, and what searches over them share."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def usable(table: DataFrame, id_col: str, vector_col: str, zero: bool) -> DataFrame:
    """(vec_id, v array<double>): vectors without null or non-finite components, all of the commonest length, of the
    zero vectors only if ``zero``. Rows without an id, and vectors of another length, take no part."""
    v = table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    v = v.where("vec_id is not null and size(v) > 0 and forall(v, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))")
    if not zero:
        v = v.where("exists(v, x -> x != 0)")
    common = v.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    return v.where(F.size("v") == (common[0]["d"] if common else 0))


def one_per_id(rows: DataFrame) -> DataFrame:
    """Queries: of several rows of one id the least vector."""
    return rows.groupBy("vec_id").agg(F.min("v").alias("v"))


def ranked(found: DataFrame, k: int, score_type: str) -> DataFrame:
    """The k best (query_id, vec_id, score) of each query, ties to the smaller id."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    out = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return out.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", F.col("score").cast(score_type).alias("score"))
