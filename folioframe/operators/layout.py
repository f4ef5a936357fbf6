"""Page layout: lines from spans, bands of a page, verse.

Tables (one row each): ``spans(doc_id, page, block_idx, block_type, block_x0, block_y0, line_idx, line_x0, line_y0,
line_x1, span_idx, text, size, font)`` and ``drawings(doc_id, page, draw_idx, x0, y0, width, height)``. Every result is
keyed by document and page, so that documents never meet in a task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folioframe.functions import text as t
from folioframe.operators import sequence as seq

PAGE = ["doc_id", "page"]


@dataclass(frozen=True)
class Layout:
    """Thresholds of a page, in points."""

    min_header_y: float = 60.0
    max_footer_y: float = 745.0
    footer_fallback_y: float = 680.0
    superscript_size: float = 10.0
    verse_min_x0: float = 130.0
    verse_italic_share: float = 0.8
    verse_margin_max_x1: float = 420.0
    verse_margin_min_run: int = 2


NOTE_START = rf"^\s*[0-9]+[.\s]+[{t.UPPER_RANGE}]"


def separators(drawings: DataFrame) -> DataFrame:
    """(doc_id, page, separator_y): the first drawn rule that can part notes from the body."""
    rule = "height < 3 and width > 30 and x0 < 120 and y0 > 200 and y0 < 745"
    return drawings.where(rule).groupBy(*PAGE).agg(F.min_by("y0", "draw_idx").alias("separator_y"))


def is_italic(font: Column) -> Column:
    return font.rlike("(?i)italic|oblique") & ~font.rlike("(?i)bold")


def lines(spans: DataFrame, drawings: DataFrame, layout: Layout = Layout()) -> DataFrame:
    """One row per text line: its raw text, its text with footnote markers, its share of italic letters, its band.

    ``ord`` is the reading order within the page: blocks by (y0, x0), lines as they stand in a block.
    """
    letters = F.length(F.regexp_replace("text", r"[^\p{L}]", ""))
    small = F.col("size") < layout.superscript_size
    s = spans.where("block_type = 0").join(separators(drawings), PAGE, "left")
    body_max = F.coalesce(F.col("separator_y") - 5.0, F.lit(layout.footer_fallback_y))
    plain = t.normalize_encoding(F.col("text"))
    marked = F.when(small & (F.col("line_y0") < body_max), F.coalesce(t.superscript_marker(plain), plain)).otherwise(plain)
    part = F.struct("span_idx", F.col("text").alias("raw"), marked.alias("marked"))
    g = s.groupBy(*PAGE, "block_idx", "block_y0", "block_x0", "line_idx", "line_x0", "line_y0", "line_x1", "separator_y").agg(
        F.array_sort(F.collect_list(part)).alias("parts"),
        F.sum(F.when(~small, letters).otherwise(0)).alias("letters"),
        F.sum(F.when(~small & is_italic(F.col("font")), letters).otherwise(0)).alias("italic"),
    )
    g = g.withColumn("raw", F.array_join(F.transform("parts", lambda p: p.raw), "")).withColumn("text", t.clean_spaces(F.array_join(F.transform("parts", lambda p: p.marked), "")))
    y, sep = F.col("line_y0"), F.col("separator_y")
    footer = (y > layout.max_footer_y) | F.coalesce(y >= sep - 5.0, (y > layout.footer_fallback_y) & F.col("raw").rlike(NOTE_START))
    band = F.when(y < layout.min_header_y, "header").when(y > layout.max_footer_y, "margin").when(footer, "footer").otherwise("body")
    order = Window.partitionBy(*PAGE).orderBy("block_y0", "block_x0", "block_idx", "line_idx")
    out = g.withColumn("band", band).withColumn("italic_share", F.coalesce(F.try_divide(F.col("italic").cast("double"), F.col("letters").cast("double")), F.lit(0.0)))
    return out.withColumn("ord", F.row_number().over(order)).select(*PAGE, "ord", "block_idx", "line_idx", "line_x0", "line_y0", "line_x1", "raw", "text", "italic_share", "band")


def mark_verse(rows: DataFrame, layout: Layout = Layout()) -> DataFrame:
    """``lines`` with ``is_verse``: italic lines past the indent, and runs of short italic lines at the margin."""
    text = t.strip(F.col("raw"))
    plain = (text != "") & ~text.rlike(r"^\s*\p{Nd}") & ~(F.startswith(text, F.lit("(")) & F.endswith(text, F.lit(")"))) & ~t.is_all_caps(text)
    candidate = plain & (F.col("italic_share") >= layout.verse_italic_share)
    indented = candidate & (F.col("line_x0") >= layout.verse_min_x0)
    margin = candidate & ~indented & (F.col("line_x1") < layout.verse_margin_max_x1)
    marked = rows.withColumn("__indented", indented).withColumn("__margin", margin)
    runs = seq.change_islands(marked, PAGE, ["ord"], F.col("__margin"), "__run")
    size = F.count(F.lit(1)).over(Window.partitionBy(*PAGE, "__run"))
    return runs.withColumn("is_verse", F.col("__indented") | (F.col("__margin") & (size >= layout.verse_margin_min_run))).drop("__indented", "__margin", "__run")


def poem_runs(rows: DataFrame) -> DataFrame:
    """(doc_id, page, band, first, n): runs of verse lines of one band; blank lines do not part them."""
    kept = rows.where(t.strip(F.col("raw")) != "").withColumn("__kind", F.struct("band", "is_verse"))
    runs = seq.change_islands(kept, PAGE, ["ord"], F.col("__kind"), "__run").where("is_verse")
    return runs.groupBy(*PAGE, "band", "__run").agg(F.min_by("text", "ord").alias("first"), F.count(F.lit(1)).alias("n")).drop("__run")
