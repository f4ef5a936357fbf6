"""Mixing sources to target weights by hash-threshold histograms.

Words are summed by source and hash bucket; a running sum finds the bucket in which a source's budget ends; only
that boundary bucket is split further, level by level, until the threshold separates single hash values. Documents
are then filtered by comparing their hash with their source's threshold. Nothing is sorted by document.

Defined results: a null text has size 0 and is never taken; a null source is a source of its own, ranked last; rows
of one document id share a hash and are taken together; an empty table gives an empty result; other columns of the
input are ignored by the plan and kept by ``apply_plan``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folioframe.scratch import Scratch

HASH_BITS, LEVEL_BITS = 60, 12


def word_count(text: Column) -> Column:
    """Number of maximal runs without ASCII white space; a null text has none."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def id_hash(key: Column) -> Column:
    """60 bits of the MD5 of the key written as text."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def source_targets(sized: DataFrame, weights: tuple[int, ...], share: float, cap: float) -> DataFrame:
    """One row per source: its size, weight and target words.

    A target is the source's part of ``share`` times all sizes by weight, at most ``cap`` times its size; what a
    capped source leaves is shared again by weight. In order of cap per weight the capped sources are a prefix, so
    running sums over the table of sources (one row each) give the fixed point in one step.
    """
    sums = sized.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    ranked = sums.select("source", "source_size", w.alias("weight"))
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    caps = (
        ranked.withColumn("most", F.lit(cap) * F.col("source_size"))
        .withColumn("ratio", F.col("most") / F.col("weight"))
        .withColumn("budget", F.lit(share) * F.sum("source_size").over(everything))
    )
    upto = Window.orderBy("ratio").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    own = Window.partitionBy("ratio")
    caps = (
        caps.withColumn("caps_below", F.sum("most").over(upto) - F.sum("most").over(own))
        .withColumn("weight_from", F.sum("weight").over(everything) - F.sum("weight").over(upto) + F.sum("weight").over(own))
        .withColumn("capped", F.col("most") * F.col("weight_from") < (F.col("budget") - F.col("caps_below")) * F.col("weight"))
    )
    left = F.col("budget") - F.sum(F.when(F.col("capped"), F.col("most")).otherwise(0.0)).over(everything)
    free = F.sum(F.when(F.col("capped"), 0.0).otherwise(F.col("weight"))).over(everything)
    target = F.when(F.col("capped"), F.col("most")).otherwise(F.col("weight") * left / free)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    return (
        caps.withColumn("target", target)
        .withColumn("whole", whole)
        .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
        .select(F.monotonically_increasing_id().alias("source_no"), "source", "source_size", "target", "whole", "rest")
    )


def mix_plan(
    spark: SparkSession,
    documents: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = (5, 2, 1),
    share: float = 1.5,
    cap: float = 2.0,
) -> tuple[DataFrame, DataFrame]:
    """(plan, sized): the plan has ``whole`` repeats of each document of a source, and one more where hash < threshold."""
    scratch = Scratch(spark, "mixing")
    sized = scratch.save(
        documents.select(
            F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), word_count(F.col(text_col)).alias("size"), id_hash(F.col(id_col)).alias("hash")
        )
    )
    targets = scratch.save(source_targets(sized, weights, share, cap))
    # Per source: the threshold so far, a multiple of the current bucket's width, and the budget left from there on.
    state = targets.select("source_no", "source", F.lit(0).cast("long").alias("threshold"), "rest", F.lit(True).alias("open"))
    for shift in range(HASH_BITS - LEVEL_BITS, -1, -LEVEL_BITS):
        live = state.where("open").select("source_no", "source", "threshold", "rest")
        wide = 1 << (shift + LEVEL_BITS)
        inside = sized.join(live, sized["source"].eqNullSafe(live["source"])).where(
            (F.col("hash") >= F.col("threshold")) & (F.col("hash") - F.col("threshold") < F.lit(wide))
        )
        histogram = inside.groupBy("source_no", "threshold", "rest", F.shiftright("hash", shift).alias("bucket")).agg(
            F.sum("size").cast("long").alias("words"), F.min("hash").alias("lo"), F.max("hash").alias("hi")
        )
        running = Window.partitionBy("source_no").orderBy("bucket")
        over = histogram.withColumn("upto", F.sum("words").over(running)).where(F.col("upto") > F.col("rest"))
        boundary = over.groupBy("source_no").agg(F.min_by(F.struct("bucket", "words", "upto", "lo", "hi"), "bucket").alias("b"))
        state = scratch.save(
            state.join(boundary, "source_no", "left").select(
                "source_no",
                "source",
                # Without a boundary all that is left fits: the threshold passes the last bucket.
                F.when(~F.col("open"), F.col("threshold"))
                .when(F.col("b").isNull(), F.col("threshold") + F.lit(wide))
                .otherwise(F.shiftleft(F.col("b.bucket"), shift))
                .alias("threshold"),
                F.when(F.col("open") & F.col("b").isNotNull(), F.col("rest") - (F.col("b.upto") - F.col("b.words"))).otherwise(F.col("rest")).alias("rest"),
                (F.col("open") & F.col("b").isNotNull() & (F.col("b.lo") < F.col("b.hi"))).alias("open"),
            )
        )
        if not state.where("open").head(1):
            break
    plan = scratch.save(targets.drop("rest").join(state.select("source_no", "threshold"), "source_no").drop("source_no"))
    return plan, sized


def apply_plan(documents: DataFrame, plan: DataFrame, *, id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """``documents`` with source_size, target and ``repeats``: how often the mix takes the whole document (0 to the cap)."""
    p = plan.select(*[F.col(c).alias(f"__{c}") for c in plan.columns])
    joined = documents.join(p, documents[source_col].cast("string").eqNullSafe(p["__source"]), "left")
    more = (id_hash(documents[id_col]) < F.col("__threshold")).cast("long")
    return joined.select(
        *[documents[c] for c in documents.columns],
        F.col("__source_size").alias("__mix_source_size"),
        F.col("__target").alias("__mix_target"),
        (F.col("__whole") + more).alias("__mix_repeats"),
    )


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan, sized = mix_plan(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))
    mixed = apply_plan(sized, plan)
    return mixed.select(
        "doc_id",
        "size",
        F.col("__mix_source_size").alias("source_size"),
        F.col("__mix_target").alias("target"),
        (F.col("size") * F.col("__mix_repeats")).cast("long").alias("taken"),
    )


OP8_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS hash
  FROM documents),
sums AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
ranked AS (
  SELECT *, CAST([5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INT)] AS DOUBLE) AS weight,
         2.0::DOUBLE * source_size AS most, 1.5::DOUBLE * CAST(sum(source_size) OVER () AS DOUBLE) AS budget
  FROM sums),
caps AS (
  SELECT r.*, r.most / r.weight AS ratio,
         coalesce((SELECT sum(b.most) FROM ranked b WHERE b.most / b.weight < r.most / r.weight), 0.0) AS caps_below,
         (SELECT sum(b.weight) FROM ranked b WHERE b.most / b.weight >= r.most / r.weight) AS weight_from
  FROM ranked r),
marked AS (SELECT *, most * weight_from < (budget - caps_below) * weight AS capped FROM caps),
targets AS (
  SELECT source, source_size,
         CASE WHEN capped THEN most ELSE weight * (budget - sum(CASE WHEN capped THEN most ELSE 0.0::DOUBLE END) OVER ())
              / sum(CASE WHEN capped THEN 0.0::DOUBLE ELSE weight END) OVER () END AS target
  FROM marked),
parts AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM targets),
summed AS (
  SELECT doc_id, source, size, sum(size) OVER (PARTITION BY source ORDER BY hash RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM sized)
SELECT s.doc_id, s.size, p.source_size, p.target,
       CAST(s.size * (p.whole + CASE WHEN s.upto <= p.target - p.whole * p.source_size THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM summed s JOIN parts p ON s.source IS NOT DISTINCT FROM p.source
"""
