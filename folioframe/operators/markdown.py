"""Rendered Markdown read back: title, body, footnotes, and checks of its structure."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folioframe.functions import text as t
from folioframe.operators import sequence as seq

# Scaffolding of the rendered files.
HEADING, RULE, QUOTE, CONTINUED = r"^\s{0,3}#{1,6}\s+", r"^\s*-{3,}\s*$", r"^\s{0,3}>\s?", r"^(?: {4}|\t)"
DEFINITION = r"^\[\^([0-9]+)\]:\s*(?:\((?:Trang|p\.)\s*([0-9]+)(?:\s*[-–]\s*([0-9]+))?\)\s*)?"
VARIANTS, NOTES = "### KHẢO DỊ", "### CHÚ THÍCH"


def prose(markdown: Column) -> Column:
    """The text without headings, rules, quote marks, note prefixes and markers."""
    kept = F.filter(F.split(markdown, "\n"), lambda l: ~l.rlike(RULE) & ~l.rlike(HEADING))
    bare = F.transform(kept, lambda l: F.regexp_replace(F.regexp_replace(F.regexp_replace(t.strip(l), QUOTE, ""), DEFINITION, ""), t.MARKER, ""))
    return F.array_join(F.filter(bare, lambda l: t.strip(l) != ""), "\n")


def parse(files: DataFrame, key: str = "path", text: str = "text") -> DataFrame:
    """(key, title, category, body, has_variants, notes array<struct<num, page, end_page, text>>).

    Lines get a kind each; a note takes the indented or blank lines after its definition, which is a run in a window.
    """
    lines = files.select(key, F.posexplode(F.split(F.coalesce(text, F.lit("")), "\n")).alias("n", "line")).withColumn("s", t.strip(F.col("line")))
    defined = F.col("s").rlike(DEFINITION)
    goes_on = (F.col("s") == "") | F.col("line").rlike(CONTINUED)
    # A line belongs to the note above it as long as only continuing lines lie between.
    group = seq.islands(lines.withColumn("starts", defined | ~goes_on), [key], ["n"], F.col("starts"), "run")
    first = F.first("s").over(Window.partitionBy(key, "run").orderBy("n").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    marked = group.withColumn("in_note", first.rlike(DEFINITION)).withColumn("def", F.when(F.col("in_note"), first))
    unquoted = F.regexp_replace(F.regexp_replace(F.col("s"), QUOTE, ""), t.MARKER, "")
    note_line = F.when(defined, F.regexp_replace(F.regexp_replace(F.col("s"), DEFINITION, ""), t.MARKER, "")).otherwise(unquoted)
    in_note = marked.where("in_note").withColumn("nl", note_line)
    notes = in_note.groupBy(key, "run", "def").agg(F.array_sort(F.collect_list(F.struct("n", "nl"))).alias("l"))
    page = F.expr("try_cast(nullif(regexp_extract(def, r'" + DEFINITION + "', 2), '') as int)")
    end = F.expr("try_cast(nullif(regexp_extract(def, r'" + DEFINITION + "', 3), '') as int)")
    body_of_note = t.strip(F.array_join(F.filter(F.transform("l", lambda x: x.nl), lambda x: x != ""), "\n"))
    one = F.struct(F.col("run").alias("ord"), F.regexp_extract("def", DEFINITION, 1).cast("int").alias("num"), page.alias("page"), F.coalesce(end, page).alias("end_page"), body_of_note.alias("text"))
    listed = notes.select(key, one.alias("note")).groupBy(key).agg(F.array_sort(F.collect_list("note")).alias("notes"))
    s = F.col("s")
    title, category = s.rlike(r"^## ") & ~F.col("in_note"), s.rlike(r"^# ") & ~F.col("in_note")
    plain = ~F.col("in_note") & ~s.rlike("^#") & ~F.col("line").rlike(RULE) & (F.regexp_replace(s, QUOTE, "") != "")
    whole = marked.groupBy(key).agg(
        F.min_by(F.when(title, F.regexp_replace(F.substring(s, 4, 10**6), r"^\s*[0-9]+\.\s*", "")), F.when(title, F.col("n"))).alias("title"),
        F.min_by(F.when(category, t.strip(F.substring(s, 3, 10**6))), F.when(category, F.col("n"))).alias("category"),
        F.array_sort(F.collect_list(F.when(plain, F.struct("n", F.regexp_replace(s, QUOTE, "").alias("x"))))).alias("b"),
        F.bool_or(F.startswith(F.upper("s"), F.lit(VARIANTS))).alias("has_variants"),
    )
    empty = F.expr("cast(array() as array<struct<ord:bigint,num:int,page:int,end_page:int,text:string>>)")
    return whole.join(listed, key, "left").select(key, "title", "category", F.array_join(F.transform("b", lambda x: x.x), "\n").alias("body"), "has_variants", F.coalesce("notes", empty).alias("notes"))


def structure_flags(parsed: DataFrame, key: str = "path", min_chars: int = 1) -> DataFrame:
    """(key, flag): what is wrong with a leaf's structure, each flag once."""
    body_markers = F.array_distinct(F.regexp_extract_all("body", F.lit(t.MARKER), F.lit(1)))
    nums = F.transform("notes", lambda n: n["num"].cast("string"))
    pages = F.filter(F.transform("notes", lambda n: n["page"]), lambda p: p.isNotNull())
    flag = lambda cond, name: F.when(cond, F.array(F.lit(name))).otherwise(F.array())
    each = lambda values, name: F.transform(values, lambda v: F.concat(F.lit(f"{name}:"), v))
    flags = F.concat(
        flag(F.coalesce("title", F.lit("")) == "", "NO_TITLE"),
        flag(F.length("body") < min_chars, "EMPTY_BODY"),
        each(F.array_except(body_markers, nums), "ORPHAN_MARKER"),
        each(F.array_except(nums, body_markers), "ORPHAN_DEFINITION"),
        F.transform(F.filter("notes", lambda n: n["text"] == ""), lambda n: F.concat(F.lit("EMPTY_FOOTNOTE:"), n["num"].cast("string"))),
        flag(F.exists(F.split("body", "\n"), lambda l: l.rlike("^[-–—]$")), "BARE_DASH"),
        flag(pages != F.array_sort(pages), "FOOTNOTE_ORDER"),
    )
    return parsed.select(key, F.explode(F.array_distinct(flags)).alias("flag"))
