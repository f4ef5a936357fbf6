"""Readers of the tables that the queries bind to, and shared SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lines(spark: SparkSession, sf_dir: str, by_document: bool = False) -> DataFrame:
    """(doc_id, line_no, line) of all documents.

    ``by_document`` deals whole documents over the tasks first: windows by document then need no other shuffle, and the
    costly work on lines is spread evenly however few files there are.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    docs = docs.repartition("doc_id") if by_document else docs
    return docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))


LINES_SQL = """raw_lines AS (
  SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents),
lines AS (
  SELECT doc_id, CAST(unnest(generate_series(0, len(parts) - 1)) AS INTEGER) AS line_no, unnest(parts) AS line FROM raw_lines)"""


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")
