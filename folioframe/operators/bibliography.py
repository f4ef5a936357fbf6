"""Bibliography pages: an introduction and sections of entries with hanging indents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioframe.functions import text as t
from folioframe.operators import sequence as seq
from folioframe.operators.toc import ROMAN_SECTION

# The heading, the indent that opens an entry, and section numbers in order.
HEADING, ENTRY_X0 = "THƯ MỤC THAM KHẢO", 94.0
ROMANS = ["I", "II", "III", "IV", "V", "VI", "VII", "VIII", "IX", "X"]


def headings(rows: DataFrame) -> DataFrame:
    """(doc_id, page, ord, section, roman, title) of the headings among indented lines in capitals whose number is the
    next one: a fold over the document's candidates, whose state is the number of sections so far."""
    title = t.strip(F.regexp_extract("text", ROMAN_SECTION, 2))
    found = rows.where((F.col("line_x0") >= ENTRY_X0) & F.col("text").rlike(ROMAN_SECTION) & t.is_all_caps(title))
    number = F.array_position(F.array(*map(F.lit, ROMANS)), F.regexp_extract("text", ROMAN_SECTION, 1)).cast("int")
    found = found.select("doc_id", F.struct("page", "ord", number.alias("section"), title.alias("title")).alias("h"))
    listed = found.groupBy("doc_id").agg(F.array_sort(F.collect_list("h")).alias("h"))
    kept = F.expr("aggregate(h, filter(h, x -> false), (a, x) -> if(x.section = size(a) + 1, array_append(a, x), a))")
    roman = F.element_at(F.array(*map(F.lit, ROMANS)), F.col("x.section"))
    return listed.select("doc_id", F.explode(kept).alias("x")).select("doc_id", "x.page", "x.ord", "x.section", roman.alias("roman"), "x.title")


def bibliography(lines: DataFrame) -> DataFrame:
    """(doc_id, section (0: introduction), roman, title, ord, page, text) of the lines of bibliography pages.

    An indented line begins a run, which the lines at the margin go on; a run that begins by closing a parenthesis which
    the runs above left open goes on with them.
    """
    place = ["page", "ord"]
    rows = lines.where("text <> ''").select("doc_id", *place, "line_x0", "text")
    first = F.min("page").over(seq.Window.partitionBy("doc_id"))
    rows = rows.withColumn("first", first).where(~F.col("text").rlike(r"^\p{Nd}+$") & ~((F.col("page") == F.col("first")) & (F.upper("text") == HEADING))).drop("first")
    heads = headings(rows)
    rows = rows.join(heads, ["doc_id", *place], "left")
    for c in ("section", "roman", "title"):
        rows = seq.forward_fill(rows.withColumnRenamed(c, f"__{c}"), ["doc_id"], place, F.col(f"__{c}"), c)
    rows = rows.where("__section is null").withColumn("section", F.coalesce("section", F.lit(0)))
    # Runs of lines with their open parentheses: those of the first line and of all.
    rows = seq.islands(rows, ["doc_id", "section"], place, F.col("line_x0") >= ENTRY_X0, "run")
    depth = F.length(F.regexp_replace("text", r"[^(]", "")) - F.length(F.regexp_replace("text", r"[^)]", ""))
    line = F.struct(*place, "text", depth.alias("depth"), (F.col("line_x0") >= ENTRY_X0).alias("indented"))
    runs = rows.groupBy("doc_id", "section", "roman", "title", "run").agg(F.array_sort(F.collect_list(line)).alias("l"))
    run = F.expr("struct(l[0].page as page, l[0].ord as ord, l[0].indented and l[0].depth < 0 as closing, aggregate(l, 0, (a, x) -> a + x.depth) as depth, transform(l, x -> x.text) as parts)")
    # Runs into blocks: the state is the blocks so far, the last of which may be open.
    entries = runs.groupBy("doc_id", "section", "roman", "title").agg(F.array_sort(F.collect_list(run)).alias("runs"))
    blocks = F.expr("""aggregate(runs, filter(runs, x -> false), (a, x) -> if(x.closing and size(a) > 0 and element_at(a, -1).depth > 0,
      array_append(slice(a, 1, size(a) - 1), struct(element_at(a, -1).page as page, element_at(a, -1).ord as ord, false as closing, element_at(a, -1).depth + x.depth as depth, concat(element_at(a, -1).parts, x.parts) as parts)),
      array_append(a, x)))""")
    out = entries.select("doc_id", "section", "roman", "title", F.explode(blocks).alias("b"))
    number = F.row_number().over(seq.ordered(["doc_id"], ["section", "b.page", "b.ord"])) - 1
    return out.select("doc_id", "section", "roman", "title", number.cast("int").alias("ord"), F.col("b.page").alias("page"), t.clean_spaces(F.array_join("b.parts", " ")).alias("text"))


def render(entries: DataFrame) -> DataFrame:
    """(doc_id, section, markdown): list items, works of one author nested below; prose until a line ends with a colon in
    the introduction."""
    rows = entries.groupBy("doc_id", "section", "roman", "title").agg(F.array_sort(F.collect_list(F.struct("ord", "text"))).alias("e"))
    texts = F.transform("e", lambda x: x.text)
    item = lambda x, i: F.when(F.startswith(x, F.lit("- ")) & (i > 0), F.concat(F.lit("  "), x)).otherwise(F.concat(F.lit("- "), x))
    key_at = F.array_position(F.transform(texts, lambda x: F.endswith(x, F.lit(":"))), True)
    intro = lambda x, i: F.when((key_at > 0) & (i >= key_at), F.concat(F.lit("- "), x)).otherwise(F.concat(x, F.lit("\n")))
    head = F.concat(F.lit(f"# {HEADING}\n\n"), F.when(F.col("section") > 0, F.concat(F.lit("## "), "roman", F.lit(". "), "title", F.lit("\n\n"))).otherwise(F.lit("")))
    body = F.when(F.col("section") > 0, F.transform(texts, item)).otherwise(F.transform(texts, intro))
    return rows.select("doc_id", "section", F.concat(head, F.array_join(body, "\n"), F.lit("\n")).alias("markdown"))


def heading_range(entries_: DataFrame, last_page: int) -> DataFrame:
    """(doc_id, start_page, end_page): from the heading's entry to the page before the next entry that is no section."""
    at = entries_.where(F.upper("title") == HEADING).select("doc_id", F.col("ord").alias("__at"), F.col("page").alias("start_page"))
    roman = F.col("title").rlike(ROMAN_SECTION) & t.is_all_caps(F.regexp_extract("title", ROMAN_SECTION, 2))
    after = entries_.join(at, "doc_id").where((F.col("ord") > F.col("__at")) & ~roman).groupBy("doc_id").agg(F.min_by("page", "ord").alias("next"))
    return at.join(after, "doc_id", "left").select("doc_id", "start_page", F.coalesce(F.col("next") - 1, F.lit(last_page)).alias("end_page"))
