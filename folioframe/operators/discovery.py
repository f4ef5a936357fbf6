"""Where leaves begin and end: headings, categories, stories."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioframe.functions import text as t
from folioframe.operators import sequence as seq

HEADING_TOP, HEADING_BOTTOM, LAST_LEAF_PAGES = 40.0, 250.0, 4


def heading_blocks(lines: DataFrame) -> DataFrame:
    """(doc_id, page, block_idx, y0, x0, text): blocks in the upper part of a page as one line of text each."""
    g = lines.groupBy("doc_id", "page", "block_idx").agg(F.min("line_y0").alias("y0"), F.min("line_x0").alias("x0"), F.array_sort(F.collect_list(F.struct("line_idx", t.strip(F.col("raw")).alias("raw")))).alias("l"))
    whole = t.clean_spaces(F.array_join(F.transform("l", lambda x: x.raw), " "))
    return g.where(F.col("y0").between(HEADING_TOP, HEADING_BOTTOM)).select("doc_id", "page", "block_idx", "y0", "x0", whole.alias("text"))


def stories(lines: DataFrame, last_page: int) -> DataFrame:
    """(doc_id, number, title, category, start_page, end_page) of the numbered headings, with the last category before.

    A story ends on the page before the next begins, never before its own start; the last one some pages on.
    """
    h = heading_blocks(lines).withColumn("c", t.clean_category_title(F.col("text"))).withColumn("s", t.clean_story_title(F.col("text")))
    order = ["page", "y0", "x0", "block_idx"]
    filled = seq.forward_fill(h, ["doc_id"], order, F.col("c.title"), "category").where("s is not null")
    ended = seq.next_bound(filled, ["doc_id"], order, "page", F.least(F.col("page") + LAST_LEAF_PAGES, F.lit(last_page)), "end_page")
    return ended.select("doc_id", F.col("s.number").alias("number"), F.col("s.title").alias("title"), "category", F.col("page").alias("start_page"), "end_page")
