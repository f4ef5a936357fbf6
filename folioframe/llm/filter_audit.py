"""How filters of a corpus overlap, in every order in which they might run.

One aggregation sums, for each set S of filters, the product of the failure flags in S: the documents that fail all of
S together. Inclusion and exclusion over these joint failures (a Moebius inversion over the lattice of sets) gives what
survives any set of filters, and from that come, for each of the orders, what each step removes and what it would have
removed had an earlier step not done so. The game "documents removed by the filters of R" has the Harsanyi dividend
``(-1)^(|S|+1) * joint failures of S`` for each set S, and a filter's Shapley value is the sum of the dividends of the
sets that hold it, each shared evenly among its members.

Each document costs one row of flags, whatever the number of orders. Copies meet in a join on a hash of the text, whose
skewed side Spark may split; parts are summed in the task first.

Defined results: a null text is an empty one; a null part is the empty string; a document without an id has no labels
and is neither an earlier copy nor a later one; rows of one id are documents of their own and not earlier than one
another; of several labels of an id each mark counts if any row has it; an empty table has no parts and gives no rows.
Texts are compared by their SHA-256. Other columns, also of clashing names, are ignored.
"""

from __future__ import annotations

from functools import reduce
from itertools import permutations
from math import factorial
from operator import mul

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioframe.scratch import Scratch

SPACE = r"[\x20\x09-\x0D]+"


def text_flags(text: Column) -> dict[str, Column]:
    """Failure of the filters on a document's own text, by letter: too few words, repeated words, capitals, symbols."""
    words = F.filter(F.split(text, SPACE), lambda w: w != "")
    n = F.size(words)
    return {
        "A": n < 200,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * n,
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")) > 3 * F.length(text),
        "D": text.rlike(r"[#$%&*|]"),
    }


def later_copies(rows: DataFrame, *, id_col: str, hash_col: str) -> DataFrame:
    """``rows`` with ``later_copy``: whether a row of the same hash has a smaller id.

    The first ids of the hashes with copies are written out, so that both sides of the join come from exchanges of
    their own and Spark can split the side that holds many copies of one text."""
    first = rows.groupBy(hash_col).agg(F.min(id_col).alias("__first"), F.max(id_col).alias("__last")).where("__first < __last")
    first = Scratch(rows.sparkSession, "copies").save(first)
    joined = rows.join(first.select(F.col(hash_col).alias("__hash"), "__first"), F.col(hash_col) == F.col("__hash"), "left")
    return joined.select(*rows.columns, F.coalesce(F.col(id_col) > F.col("__first"), F.lit(False)).alias("later_copy"))


def joint_failures(flagged: DataFrame, filters: list[str], *, part_col: str, marks: dict[str, Column]) -> DataFrame:
    """One row per part: for each mark an array of the joint failures of all sets of filters, a set being the bits of its
    place; a filter's flag is the column of its name. ``marks``: names and conditions of the documents that count."""
    sums = []
    for mark, condition in marks.items():
        products = [reduce(mul, [F.col(f).cast("long") for k, f in enumerate(filters) if s >> k & 1], condition.cast("long")) for s in range(1 << len(filters))]
        sums.append(F.array(*[F.sum(p) for p in products]).alias(mark))
    return flagged.groupBy(F.col(part_col).alias("part")).agg(*sums)


def _signed(counts: str, s: str) -> str:
    return f"(if(bit_count({s}) % 2 = 0, 1L, -1L) * {counts}[{s}])"


def survivors(counts: str, n_filters: int) -> Column:
    """What passes each set of filters: the sum over its subsets of the joint failures, by turns added and taken off."""
    sets = f"sequence(0, {(1 << n_filters) - 1})"
    inner = f"aggregate({sets}, 0L, (total, s) -> total + if((s & r) = s, {_signed(counts, 's')}, 0L))"
    return F.expr(f"transform({sets}, r -> {inner})")


def dividends(counts: str, n_filters: int) -> Column:
    """For each filter, the sum over all orders of what it removes: dividends of the sets that hold it, shared evenly."""
    sets = f"sequence(1, {(1 << n_filters) - 1})"
    held = f"if((s & shiftleft(1, f)) != 0, -{_signed(counts, 's')} * cast({factorial(n_filters)} div bit_count(s) AS bigint), 0L)"
    return F.expr(f"transform(sequence(0, {n_filters - 1}), f -> aggregate({sets}, 0L, (total, s) -> total + {held}))")


def orders(filters: list[str]) -> Column:
    """Each step of each order: (filter_order, step, filter, earlier), sets of earlier filters as bits."""
    steps = []
    for order in permutations(range(len(filters))):
        name, earlier = "".join(filters[k] for k in order), 0
        for step, k in enumerate(order, 1):
            steps.append(f"{name} {step} {k} {earlier}")
            earlier |= 1 << k
    split = F.transform(F.array(*[F.lit(s) for s in steps]), lambda s: F.split(s, " "))
    return F.transform(split, lambda x: F.struct(x[0].alias("filter_order"), x[1].cast("int").alias("step"), x[2].cast("int").alias("filter"), x[3].cast("int").alias("earlier")))


def audit(joint: DataFrame, filters: list[str]) -> DataFrame:
    """One row per part, order and step from ``joint_failures`` with the marks ``every``, ``good`` and ``toxic``."""
    n, everyone = len(filters), (1 << len(filters)) - 1
    passed = joint.select("part", "every", *[survivors(m, n).alias(f"{m}_left") for m in ("every", "good", "toxic")], dividends("every", n).alias("shared"))
    steps = passed.select("*", F.explode(orders(filters)).alias("at")).select("*", "at.*", F.expr("shiftleft(1, at.filter)").alias("own"))
    left = lambda mark, of: F.expr(f"{mark}_left[{of}]")
    gone = lambda mark: left(mark, "earlier") - left(mark, "earlier | own")
    return steps.select(
        "part",
        "filter_order",
        "step",
        left("every", "earlier | own").alias("kept"),
        gone("every").alias("removed"),
        (F.expr("every[own]") - gone("every")).alias("redundant"),
        (left("every", f"{everyone} - own") - left("every", str(everyone))).alias("unique_fails"),
        gone("good").alias("good_lost"),
        gone("toxic").alias("toxic_lost"),
        F.expr("shared[filter]").alias("shapley"),
    )


def audit_documents(documents: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """The audit of the five filters A to E (E: a later copy) by part."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = documents.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("hash"), *[f.alias(k) for k, f in text_flags(text).items()]
    )
    marked = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("__doc")).agg(F.max(F.expr("quality = 1")).alias("__good"), F.max(F.expr("toxic = 1")).alias("__toxic"))
    copies = later_copies(rows, id_col="doc_id", hash_col="hash").withColumnRenamed("later_copy", "E").drop("hash")
    flagged = copies.join(marked, F.col("doc_id") == F.col("__doc"), "left")
    seen = {"every": F.lit(True), "good": F.coalesce("__good", F.lit(False)), "toxic": F.coalesce("__toxic", F.lit(False))}
    return audit(joint_failures(flagged, list("ABCDE"), part_col="part", marks=seen), list("ABCDE"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


# Removes documents order by order and step by step, without sums over sets.
OP13_SQL = r"""
WITH texts AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
split AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, min(doc_id) OVER (PARTITION BY t) AS first FROM texts),
marks AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
flags AS (
  SELECT s.part, coalesce(m.good, 0) AS good, coalesce(m.toxic, 0) AS toxic,
         (CASE WHEN len(w) < 200 THEN 1 ELSE 0 END) + (CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END)
         + (CASE WHEN 100 * len(regexp_extract_all(t, '[A-Z]')) > 3 * length(t) THEN 4 ELSE 0 END)
         + (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END) + (CASE WHEN s.doc_id > s.first THEN 16 ELSE 0 END) AS mask
  FROM split s LEFT JOIN marks m ON s.doc_id = m.doc_id),
counts AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM flags GROUP BY part, mask),
letters AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS v(letter, bit)),
orders AS (
  SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM letters a JOIN letters b ON b.bit <> a.bit JOIN letters c ON c.bit NOT IN (a.bit, b.bit) JOIN letters d ON d.bit NOT IN (a.bit, b.bit, c.bit)
  JOIN letters e ON e.bit NOT IN (a.bit, b.bit, c.bit, d.bit)),
steps AS (
  SELECT filter_order, k AS step, bits[k] AS own, CASE WHEN k = 1 THEN 0 ELSE list_sum(bits[1:k - 1]) END AS earlier
  FROM (SELECT filter_order, bits, unnest([1, 2, 3, 4, 5]) AS k FROM orders) x),
stepped AS (
  SELECT c.part, s.filter_order, s.step, s.own,
         sum(CASE WHEN c.mask & CAST(s.earlier + s.own AS INTEGER) = 0 THEN c.n ELSE 0 END) AS kept,
         sum(CASE WHEN c.mask & CAST(s.earlier AS INTEGER) = 0 AND c.mask & s.own <> 0 THEN c.n ELSE 0 END) AS removed,
         sum(CASE WHEN c.mask & CAST(s.earlier AS INTEGER) <> 0 AND c.mask & s.own <> 0 THEN c.n ELSE 0 END) AS redundant,
         sum(CASE WHEN c.mask = s.own THEN c.n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN c.mask & CAST(s.earlier AS INTEGER) = 0 AND c.mask & s.own <> 0 THEN c.good ELSE 0 END) AS good_lost,
         sum(CASE WHEN c.mask & CAST(s.earlier AS INTEGER) = 0 AND c.mask & s.own <> 0 THEN c.toxic ELSE 0 END) AS toxic_lost
  FROM counts c CROSS JOIN steps s GROUP BY c.part, s.filter_order, s.step, s.own)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM stepped
"""
