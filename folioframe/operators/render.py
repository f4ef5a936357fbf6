"""Markdown and JSON of assembled leaves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def manifest(sections: DataFrame, leaves: DataFrame, kind: str) -> DataFrame:
    """(section, json): name, ``total_<kind>`` and the leaves in order, grouped by category in first-seen order."""
    leaf = F.struct("ord", "title", "category")
    grouped = leaves.groupBy("section").agg(F.array_sort(F.collect_list(leaf)).alias("leaves"))
    empty = F.expr("cast(array() as array<struct<ord:bigint,title:string,category:string>>)")
    j = sections.join(grouped, "section", "left").withColumn("leaves", F.coalesce("leaves", empty))
    kinds = F.array_distinct(F.transform("leaves", lambda l: l.category))
    by_kind = F.transform(kinds, lambda c: F.struct(c.alias("category"), F.filter(F.col("leaves"), lambda l: l.category == c).alias(kind)))
    return j.select("section", F.to_json(F.struct("name", F.size("leaves").alias(f"total_{kind}"), by_kind.alias("categories"))).alias("json"))


def paragraph_markdown(p: Column) -> Column:
    """A paragraph struct (kind, text, lines) as Markdown; verse is a block quote, a line each."""
    quoted = F.array_join(F.transform(p["lines"], lambda l: F.concat(F.lit("> "), l)), "\n")
    return F.when(p["kind"] == "verse", quoted).otherwise(p["text"])


def _parted(prefix: Column, parts: Column) -> Column:
    """A note with verse: prose at its head stands on the first line, the other parts are indented blocks."""
    first = F.get(parts, F.lit(0))
    led = first["kind"] == "text"
    indented = lambda p: F.array_join(F.transform(F.split(paragraph_markdown(p), "\n"), lambda l: F.concat(F.lit("    "), l)), "\n")
    head = F.when(led, F.concat(prefix, F.lit(" "), first["text"])).otherwise(prefix)
    return F.array_join(F.concat(F.array(head), F.transform(F.filter(parts, lambda p, k: ~led | (k > 0)), indented)), "\n\n")


def leaf_markdown(title: Column, paragraphs: Column, notes: Column, category: Column | None = None, number: Column | None = None, variants: Column | None = None, with_parts: bool = False) -> Column:
    """A leaf: category, numbered title, paragraphs, variants and footnotes, with a blank line between them.
    ``notes``: array of struct(num, page, end_page, text), and ``parts`` if ``with_parts``. What is null or empty has no heading."""
    pages = lambda n: F.when(n["end_page"] > n["page"], F.concat(n["page"].cast("string"), F.lit("-"), n["end_page"].cast("string"))).otherwise(n["page"].cast("string"))
    prefix = lambda n: F.concat(F.lit("[^"), n["num"].cast("string"), F.lit("]: (Trang "), pages(n), F.lit(")"))
    plain = lambda n: F.rtrim(F.concat(prefix(n), F.lit(" "), n["text"]))
    note = (lambda n: F.when(F.size(n["parts"]) > 0, _parted(prefix(n), n["parts"])).otherwise(plain(n))) if with_parts else plain
    none = F.array().cast("array<string>")
    given = lambda c, mark: F.when(F.coalesce(c, F.lit("")) != "", F.array(F.concat(F.lit(mark), c))).otherwise(none)
    under = lambda blocks, heads: F.when(F.size(blocks) > 0, F.concat(F.array(*map(F.lit, heads)), blocks)).otherwise(none)
    named = title if number is None else F.concat(F.coalesce(F.concat(number.cast("string"), F.lit(". ")), F.lit("")), title)
    blocks = [
        none if category is None else given(category, "# "),
        given(named, "## "),
        F.transform(paragraphs, paragraph_markdown),
        none if variants is None else under(F.transform(variants, paragraph_markdown), ["### KHẢO DỊ"]),
        under(F.transform(notes, note), ["---", "### Chú thích"]),
    ]
    return F.concat(F.array_join(F.concat(*blocks), "\n\n"), F.lit("\n"))
