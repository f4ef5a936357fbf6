"""Introductions and essays of a part: leaves that begin and end within a page, bounded by printed headings.

Body lines get a class each (section, essay, capitals, text); a heading with the capitals below it is a run in a window,
and a leaf reaches from below its heading to the top of the next one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folioframe.functions import text as t
from folioframe.operators import sequence as seq
from folioframe.operators.toc import PART_HEADING, ROMAN_SECTION

ESSAY = r"^\[?([0-9]+)\]?\s*\.\s*(.+)$"
CAPS_SHARE = 0.9
BELOW = 1.0  # a line lies below a heading if its top is this far under the top of the heading's last line


def mostly_caps(c: Column) -> Column:
    """At least two letters, nine tenths of them capitals: one stray small letter does no harm."""
    return (F.length(F.regexp_replace(c, r"[^\p{L}]", "")) >= 2) & (t.caps_ratio(c) >= CAPS_SHARE)


def heading_text(c: Column) -> Column:
    """Without footnote digits and the closing period."""
    c = F.regexp_replace(t.strip(c), r"[0-9]+\s*$", "")
    return F.regexp_replace(t.clean_spaces(F.regexp_replace(c, rf"([{t.UPPER_RANGE}])[0-9]+(\s+)", "$1$2")), r"[. ]+$", "")


def is_section(c: Column) -> Column:
    return c.rlike(ROMAN_SECTION) & t.is_all_caps(F.regexp_extract(c, ROMAN_SECTION, 2))


def essay_heading(c: Column) -> Column:
    """struct(number, title) of a numbered line in capitals, else null; mixed case is a list, Roman numbers are sections."""
    clean = t.clean_spaces(c)
    title = heading_text(F.regexp_extract(clean, ESSAY, 2))
    return F.when(~is_section(clean) & clean.rlike(ESSAY) & mostly_caps(title), F.struct(F.regexp_extract(clean, ESSAY, 1).cast("int").alias("number"), title.alias("title")))


def headings(lines: DataFrame, parts: DataFrame) -> DataFrame:
    """(doc_id, part, ord, page, kind, roman, number, title, top, bottom) in reading order.

    ``lines`` as ``layout.lines`` gives them; ``parts``: doc_id, part, start_page, end_page, romans array<string>.
    """
    body = lines.where("band = 'body' and text <> ''").join(parts, "doc_id").where(F.col("page").between(F.col("start_page"), F.col("end_page")))
    plain = F.regexp_replace("text", t.MARKER, "")
    roman = F.regexp_extract("text", ROMAN_SECTION, 1)
    kind = F.when(is_section(F.col("text")) & F.array_contains("romans", roman), "section").when(essay_heading(F.col("text")).isNotNull(), "essay").when(mostly_caps(plain) | plain.rlike(PART_HEADING), "caps").otherwise("text")
    keys, order = ["doc_id", "part"], ["page", "line_y0", "ord"]
    marked = body.withColumn("kind", kind).withColumn("first", F.row_number().over(Window.partitionBy(*keys, "page").orderBy("line_y0", "ord")) == 1)
    # A run is a heading with the capitals below it on its page; on a part's first page the run from the top is its title.
    runs = seq.islands(marked, keys, order, (F.col("kind") != "caps") | F.col("first"), "run")
    one = runs.groupBy(*keys, "run").agg(
        F.min(F.struct("page", "line_y0", "ord", "kind", "first", "text", "start_page")).alias("h"), F.max("line_y0").alias("low"), F.array_sort(F.collect_list(F.struct("line_y0", "ord", heading_text(F.col("text")).alias("x")))).alias("l")
    )
    title_run = F.col("h.first") & (F.col("h.page") == F.col("h.start_page")) & (F.col("h.kind") == "caps")
    lines_of = F.transform("l", lambda x: x.x)
    essay = essay_heading(F.col("h.text"))
    whole = t.clean_spaces(F.array_join(F.concat(F.array(essay["title"]), F.slice(lines_of, F.lit(2), F.greatest(F.size("l") - 1, F.lit(0)))), " "))
    kept = one.withColumn("kind", F.when(title_run, "title").otherwise(F.col("h.kind"))).where("kind in ('title', 'section', 'essay')")
    bottom = F.when(F.col("kind") == "section", F.col("h.line_y0")).otherwise(F.col("low")) + BELOW
    return kept.select(
        *keys, F.col("run").alias("ord"), F.col("h.page").alias("page"), "kind", F.when(F.col("kind") == "section", F.regexp_extract("h.text", ROMAN_SECTION, 1)).alias("roman"),
        F.when(F.col("kind") == "essay", essay["number"]).alias("number"), F.when(F.col("kind") == "essay", whole).alias("title"), F.col("h.line_y0").alias("top"), bottom.alias("bottom"),
    )


def leaves(lines: DataFrame, parts: DataFrame) -> DataFrame:
    """(doc_id, part, kind, roman, number, title, start_page, end_page, body_top, body_bottom) of the introduction and the
    essays that hold any text. A next heading at the very top of its page ends the leaf on the page before."""
    keys, order = ["doc_id", "part"], ["ord"]
    h = headings(lines, parts)
    after = F.lead(F.struct("page", "top")).over(seq.ordered(keys, order))
    h = seq.forward_fill(h.withColumn("next", after), keys, order, F.col("roman"), "section")
    body = lines.where("band = 'body' and text <> ''")
    tops = body.groupBy("doc_id", "page").agg(F.min("line_y0").alias("page_top"))
    h = h.join(tops.select("doc_id", F.col("page").alias("__p"), "page_top"), (h["doc_id"] == tops["doc_id"]) & (F.col("next.page") == F.col("__p")), "left").select(h["*"], "page_top")
    inside = F.col("page_top") < F.col("next.top")
    h = h.join(parts.select("doc_id", "part", F.col("end_page").alias("part_end")), keys)
    h = h.withColumn("end_page", F.when(F.col("next").isNull(), F.col("part_end")).when(inside, F.col("next.page")).otherwise(F.col("next.page") - 1)).withColumn("body_bottom", F.when(inside, F.col("next.top")))
    h = h.where((F.col("kind") == "title") | ((F.col("kind") == "essay") & F.col("section").isNotNull())).where(F.col("end_page") >= F.col("page"))
    b = body.select(F.col("doc_id").alias("__d"), F.col("page").alias("__page"), F.col("line_y0").alias("__y"))
    spread = h.withColumn("__page", F.explode(F.sequence("page", "end_page")))
    above = (spread["__page"] == F.col("page")) & (F.col("__y") < F.col("bottom"))
    below = (spread["__page"] == F.col("end_page")) & F.coalesce(F.col("__y") >= F.col("body_bottom"), F.lit(False))
    held = spread.join(b, (F.col("doc_id") == F.col("__d")) & (spread["__page"] == b["__page"]) & ~above & ~below, "left_semi")
    some = held.select(*keys, "ord").distinct()
    return h.join(some, [*keys, "ord"], "left_semi").select(
        *keys, F.when(F.col("kind") == "title", "introduction").otherwise("essay").alias("kind"), F.col("section").alias("roman"), "number", "title", F.col("page").alias("start_page"), "end_page", F.col("bottom").alias("body_top"), "body_bottom"
    )
