"""Checks of rendered leaves against their source, allow-lists, status and reports."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType

from folioframe.operators.alignment import matching_blocks

DEFAULT_THRESHOLD = 0.9
MIN_CHARS_PER_PAGE = 800


def completeness(expected_keys: DataFrame, counts: DataFrame, key: str) -> DataFrame:
    """(key, expected, actual, delta, code): what is counted against what is announced; absent keys count 0."""
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    j = expected_keys.join(counts, key, "left").select(key, zero("expected"), zero("actual")).withColumn("delta", F.col("actual") - F.col("expected"))
    return j.withColumn("code", F.when(F.col("delta") == 0, "OK").when(F.col("delta") < 0, "MISSING").otherwise("EXTRA"))


def apply_errata(flags: DataFrame, allowed: DataFrame, on: list[str]) -> DataFrame:
    """``flags`` with the reason of the allow-list, a short literal table, and whether it makes an erratum of them."""
    return flags.join(F.broadcast(allowed), on, "left").withColumn("erratum", F.col("reason").isNotNull())


def leaf_status(leaves: DataFrame, flags: DataFrame, key: str, threshold: float | None = None) -> DataFrame:
    """``leaves`` with n_notes, n_errata and status; a coverage below ``threshold`` needs review too."""
    n = flags.groupBy(key).agg(F.count_if(~F.col("erratum")).alias("n_notes"), F.count_if("erratum").alias("n_errata"))
    j = leaves.join(n, key, "left").withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in ("n_notes", "n_errata")})
    low = F.lit(False) if threshold is None else F.col("coverage") < threshold
    return j.withColumn("status", F.when((F.col("n_notes") > 0) | low, "REVIEW").when(F.col("n_errata") > 0, "ERRATUM").otherwise("OK"))


def worst_first(leaves: DataFrame, order: list[str], n: int) -> DataFrame:
    """The n leaves of least coverage; the order must be total."""
    return leaves.orderBy(*order).limit(n)


def report_counts(leaves: DataFrame, keys: list[str]) -> DataFrame:
    s = F.col("status")
    return leaves.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.count_if(s == "OK").alias("n_ok"), F.count_if(s == "ERRATUM").alias("n_erratum"), F.count_if(s == "REVIEW").alias("n_review"))


def _coverage(source: str | None, rendered: str | None) -> float:
    """Share of the source's words in matching blocks."""
    a, b = (source or "").split(), (rendered or "").split()
    return sum(k for _, _, k in matching_blocks(a, b)) / len(a) if a else 1.0


@pandas_udf(DoubleType())
def _coverage_udf(source: pd.Series, rendered: pd.Series) -> pd.Series:
    return pd.Series([_coverage(a, b) for a, b in zip(source, rendered, strict=True)], dtype="float64")


def coverage(source: Column, rendered: Column) -> Column:
    """How much of the source text the rendered text keeps, in order; 1 for an empty source."""
    return _coverage_udf(source, rendered)
