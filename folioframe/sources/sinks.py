"""Rendered leaves read back from a tree of files, and JSON results (the tree itself: ``tree``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioframe.sources.layout import read_markdown


def read_leaves(spark: SparkSession, folder: str) -> DataFrame:
    """(path, text) of the leaves of a tree; a path begins at the folder of its document."""
    return within_tree(read_markdown(spark, folder)).where(F.col("path").rlike("^document_[^/]+/part_"))


def within_tree(files: DataFrame) -> DataFrame:
    """``files`` with paths as they are in the tree, whatever folder that lies in; '' for what is no document's."""
    return files.withColumn("path", F.regexp_extract("path", r"^.*/(document_[^/]+/.*)$", 1))


def write_json(manifests: DataFrame, folder: str, column: str = "json") -> None:
    manifests.select(F.col(column).alias("value")).write.mode("overwrite").text(folder)

