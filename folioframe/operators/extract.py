"""The whole extraction: leaves of every kind with their bounds, paragraphs, own footnotes and Markdown; manifests and jobs.

Leaves are stories of the numbered sections, and introductions and essays of the other parts. A leaf is rendered from
the lines within its bounds; a note of a shared page whose marker stands only in a neighbour's lines is the neighbour's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folioframe.functions import text as t
from folioframe.operators import assemble, bibliography, discovery, essays, footnotes, layout, render, toc, validate

LEAF = ["doc_id", "part", "section", "roman", "category", "kind", "number", "title", "start_page", "end_page", "body_top", "body_bottom"]
STORY_PART = 2
ESSAY_PARTS = (1, 3)


def story_leaves(lines: DataFrame, sections: DataFrame, last_page: int) -> DataFrame:
    """The stories of the sections of the story part, cut at the pages where they must stop."""
    own = sections.where(F.col("part") == STORY_PART).select("doc_id", "part", "section", "roman", F.col("start_page").alias("s"), F.col("end_page").alias("e"), "hard_stops")
    stories = discovery.stories(lines, last_page)
    inside = (stories["doc_id"] == own["doc_id"]) & stories["start_page"].between(own["s"], own["e"])
    placed = stories.join(own, inside).select(stories["doc_id"], "part", "section", "roman", "category", "number", "title", "start_page", F.least("end_page", "e").alias("end_page"), "hard_stops")
    stop = F.array_min(F.filter("hard_stops", lambda p: (p > F.col("start_page")) & (p <= F.col("end_page"))))
    cut = placed.withColumn("end_page", F.least("end_page", F.coalesce(stop - 1, F.col("end_page"))))
    none = F.lit(None).cast("double")
    return cut.withColumns({"kind": F.lit("story"), "body_top": none, "body_bottom": none}).select(*LEAF)


def essay_leaves(lines: DataFrame, sections: DataFrame) -> DataFrame:
    """The introductions and essays of the parts around the stories."""
    wanted = sections.where(F.col("part").isin(*ESSAY_PARTS))
    parts = wanted.groupBy("doc_id", "part").agg(F.max("part_title").alias("part_title"), F.min("part_start").alias("start_page"), F.max("part_end").alias("end_page"), F.array_compact(F.collect_list("roman")).alias("romans"))
    named = wanted.where("section is not null").select("doc_id", "part", "section", "roman", F.concat(F.col("roman"), F.lit(". "), F.col("title")).alias("category"))
    found = essays.leaves(lines, parts.select("doc_id", "part", "start_page", "end_page", "romans"))
    found = found.join(named, ["doc_id", "part", "roman"], "left").join(parts.select("doc_id", "part", "part_title"), ["doc_id", "part"])
    title = F.coalesce("title", "part_title")
    return found.withColumn("title", title).select(*LEAF)


def own_notes(lines: DataFrame, leaves: DataFrame, key: str = "leaf") -> DataFrame:
    """(doc_id, leaf, page, num, end_page, text, parts) of the notes of each leaf's pages, but those whose marker is only
    in the lines of a page outside the leaf's bounds. A note that no marker names stays, and so does what goes on from a
    note before the leaf."""
    of = leaves.select("doc_id", F.col(key).alias("leaf"), "start_page", "end_page")
    notes = footnotes.merge_notes(footnotes.page_notes(lines), of).select("doc_id", F.col("leaf").alias(key), "page", "num", "end_page", "text", "parts")
    pages = leaves.select("doc_id", key, "start_page", "end_page", "body_top", "body_bottom", F.explode(F.sequence("start_page", "end_page")).alias("page"))
    marked = lines.where("band = 'body'").select("doc_id", "page", "line_y0", F.explode(F.regexp_extract_all("text", F.lit(t.MARKER), F.lit(1))).alias("num"))
    above = F.coalesce((F.col("page") == F.col("start_page")) & (F.col("line_y0") < F.col("body_top")), F.lit(False))
    below = F.coalesce((F.col("page") == F.col("end_page")) & (F.col("line_y0") >= F.col("body_bottom")), F.lit(False))
    seen = pages.join(marked, ["doc_id", "page"]).groupBy("doc_id", key, "page", F.expr("try_cast(num as int)").alias("num")).agg(F.bool_and(above | below).alias("elsewhere"))
    others = seen.where("elsewhere").select("doc_id", key, "page", "num")
    return notes.join(others, ["doc_id", key, "page", "num"], "left_anti")


def chosen(leaves: DataFrame, part: int | None, sections: list[int] | None) -> DataFrame:
    """The leaves of a part and of sections of it; all if neither is given."""
    out = leaves if part is None else leaves.where(F.col("part") == part)
    return out.where(F.col("section").isin(sections)) if sections else out


def leaf_path() -> Column:
    """document_D/part_N/roman_category/NNN_title.md, in letters and digits alone. Leaves of one section, number and title
    (which a document should not have) are told apart by their place."""
    number = F.when(F.col("number").isNotNull(), F.concat(F.lpad(F.col("number").cast("string"), 3, "0"), F.lit("_"))).otherwise(F.lit(""))
    folder = F.concat_ws("/", F.concat(F.lit("document_"), F.col("doc_id").cast("string")), F.concat(F.lit("part_"), F.col("part").cast("string")), F.when(F.col("section").isNotNull(), F.concat_ws("_", "roman", t.slug(F.regexp_replace("category", r"^[IVX]+\. ", "")))))
    name = F.concat(folder, F.lit("/"), number, t.slug(F.col("title")))
    again = F.row_number().over(Window.partitionBy("doc_id", name).orderBy("leaf"))
    return F.concat(name, F.when(again > 1, F.concat(F.lit("_"), again.cast("string"))).otherwise(F.lit("")), F.lit(".md"))


def extract(spans: DataFrame, drawings: DataFrame, pages: DataFrame, last_page: int, part: int | None = None, sections: list[int] | None = None) -> DataFrame:
    """One row per leaf: LEAF, ``leaf`` (its place in the document), ``path``, ``has_variants``, ``n_notes`` and ``markdown``."""
    lines = layout.lines(spans, drawings)
    found = toc.sections(toc.entries(pages))
    every = story_leaves(lines, found.where("section is not null"), last_page).unionByName(essay_leaves(lines, found))
    place = F.row_number().over(Window.partitionBy("doc_id").orderBy("part", F.col("section").asc_nulls_first(), "start_page", F.col("number").asc_nulls_first(), "title"))
    leaves = chosen(every.withColumn("leaf", place), part, sections)
    paragraphs = assemble.assemble(spans, drawings, leaves.select("doc_id", "leaf", "start_page", "end_page", "body_top", "body_bottom"))
    p = F.struct("ord", "kind", "text", F.col("verse").alias("lines"))
    grouped = paragraphs.groupBy("doc_id", "leaf").agg(F.array_sort(F.array_compact(F.collect_list(F.when(F.col("part") == "text", p)))).alias("p"), F.array_sort(F.array_compact(F.collect_list(F.when(F.col("part") != "text", p)))).alias("v"))
    noted = own_notes(layout.mark_verse(lines), leaves).groupBy("doc_id", "leaf").agg(F.array_sort(F.collect_list(F.struct("page", "num", "end_page", "text", "parts"))).alias("n"))
    whole = leaves.join(grouped, ["doc_id", "leaf"], "left").join(noted, ["doc_id", "leaf"], "left")
    for c, kind in (("p", grouped.schema["p"].dataType), ("v", grouped.schema["v"].dataType), ("n", noted.schema["n"].dataType)):
        whole = whole.withColumn(c, F.coalesce(c, F.array().cast(kind)))
    text = render.leaf_markdown(F.col("title"), F.col("p"), F.col("n"), F.col("category"), F.col("number"), F.col("v"), with_parts=True)
    return whole.select(*LEAF, "leaf", leaf_path().alias("path"), (F.size("v") > 0).alias("has_variants"), F.size("n").alias("n_notes"), text.alias("markdown"))


MANIFEST = "table_of_contents.json"
LISTED = "array<struct<leaf:int,number:int,title:string,kind:string,path:string,pages:array<int>,has_khao_di:boolean,footnotes_count:int>>"
SECTION = f"struct<doc_id:bigint,part:int,section:int,roman:string,title:string,total:int,leaves:{LISTED}>"


def section_manifests(leaves: DataFrame) -> DataFrame:
    """(path, text): a manifest in the folder of each section, and of each part for its leaves of no section."""
    one = F.struct("leaf", "number", "title", "kind", "path", F.array("start_page", "end_page").alias("pages"), F.col("has_variants").alias("has_khao_di"), F.col("n_notes").alias("footnotes_count"))
    folder = F.regexp_replace("path", r"/[^/]*$", "")
    by_folder = leaves.groupBy("doc_id", "part", "section", "roman", F.col("category").alias("title"), folder.alias("folder")).agg(F.array_sort(F.collect_list(one)).alias("leaves"))
    # A folder that sections share (one without a name) has one file: a line for each.
    line = F.to_json(F.struct("doc_id", "part", "section", "roman", "title", F.size("leaves").alias("total"), "leaves"))
    lines = by_folder.select("folder", F.struct("section", line.alias("json")).alias("x")).groupBy("folder").agg(F.array_sort(F.collect_list("x")).alias("x"))
    return lines.select(F.concat("folder", F.lit(f"/{MANIFEST}")).alias("path"), F.concat(F.array_join(F.transform("x", lambda x: x.json), "\n"), F.lit("\n")).alias("text"))


def root_manifests(found: DataFrame) -> DataFrame:
    """(path, text): a manifest of each document from those of its sections (path, text), in order of part and section.
    ``found`` holds all that are in the tree, so that a run over some sections keeps the others."""
    of = found.where(F.col("path").rlike(rf"/part_[^/]+/(?:[^/]+/)?{MANIFEST}$"))
    lines = of.select(F.explode(F.split("text", "\n")).alias("line")).where("trim(line) <> ''")
    s = lines.select(F.from_json("line", SECTION).alias("s")).where("s.doc_id is not null").select("s.*")
    section = F.struct("section", "roman", "title", "total", "leaves")
    parts = s.groupBy("doc_id", "part").agg(F.sum("total").alias("total"), F.array_sort(F.collect_list(section)).alias("sections"))
    whole = parts.groupBy("doc_id").agg(F.sum("total").alias("total"), F.array_sort(F.collect_list(F.struct("part", "total", "sections"))).alias("parts"))
    bib = found.where(F.col("path").rlike(rf"/bibliography/{MANIFEST}$")).select(F.regexp_extract("path", r"^document_([^/]+)/", 1).cast("long").alias("doc_id"), F.from_json("text", BIBLIOGRAPHY).alias("bibliography"))
    j = whole.join(bib, "doc_id", "left")
    return j.select(F.concat(F.lit("document_"), F.col("doc_id").cast("string"), F.lit(f"/{MANIFEST}")).alias("path"), F.concat(F.to_json(F.struct("doc_id", "total", "parts", "bibliography")), F.lit("\n")).alias("text"))


def jobs(leaves: DataFrame) -> DataFrame:
    """What a validation checks: (path, doc_id, part, section, start_page, end_page)."""
    return leaves.select("path", "doc_id", "part", "section", "start_page", "end_page")


def drift(pages: DataFrame, leaves: DataFrame) -> DataFrame:
    """(path, doc_id, part, section, expected, actual, delta, flag): sections whose stories are not as many as the contents
    list, or none. ``path`` names a section by document, part and number."""
    entries = toc.part_entries(toc.entries(pages)).where(F.col("part") == STORY_PART)
    listed = entries.where(F.col("title").rlike(toc.LEAF)).select("doc_id", "page")
    found = toc.sections(toc.entries(pages)).where((F.col("part") == STORY_PART) & F.col("section").isNotNull()).select("doc_id", "part", "section", "start_page", "end_page")
    expected = found.join(listed, "doc_id", "left").groupBy("doc_id", "part", "section").agg(F.count(F.when(F.col("page").between(F.col("start_page"), F.col("end_page")), 1)).alias("expected"))
    actual = leaves.where("kind = 'story'").groupBy("doc_id", "part", "section").agg(F.count(F.lit(1)).alias("actual"))
    both = expected.join(actual, ["doc_id", "part", "section"], "left").withColumn("actual", F.coalesce("actual", F.lit(0)))
    flag = F.when(F.col("actual") == 0, "MISSING_SECTION").when(F.col("actual") < F.col("expected"), "MISSING_LEAVES").when(F.col("actual") > F.col("expected"), "EXTRA_LEAVES")
    path = F.format_string("document_%s/part_%s/%s", *[F.col(c).cast("string") for c in ("doc_id", "part", "section")])
    return both.withColumns({"flag": flag, "path": path, "delta": F.col("actual") - F.col("expected")}).where("flag is not null").select("path", "doc_id", "part", "section", "expected", "actual", "delta", "flag")


DRIFT_ERRATA = "path string, flag string, delta long, reason string"


def known_drift(drifted: DataFrame, allowed: DataFrame) -> DataFrame:
    """``drifted`` with ``reason`` and ``erratum``: what a short list (path, flag, delta, reason) says is the contents' own
    fault. Another number of leaves too many or too few than listed stays a flag."""
    return validate.apply_errata(drifted, allowed, ["path", "flag", "delta"])


BIBLIOGRAPHY = "struct<start_page:int,end_page:int,sections:array<struct<section:int,markdown_file:string,entry_count:int>>>"


def bibliography_files(spans: DataFrame, drawings: DataFrame, pages: DataFrame, last_page: int) -> DataFrame:
    """(path, text) of the bibliography: a file per section, and a manifest of them."""
    bounds = bibliography.heading_range(toc.entries(pages), last_page)
    lines = layout.lines(spans, drawings).where("band = 'body'").join(bounds, "doc_id").where(F.col("page").between(F.col("start_page"), F.col("end_page")))
    entries = bibliography.bibliography(lines)
    folder = F.concat(F.lit("document_"), F.col("doc_id").cast("string"), F.lit("/bibliography/"))
    name = F.format_string("%02d.md", "section")
    files = bibliography.render(entries).select(F.concat(folder, name).alias("path"), F.col("markdown").alias("text"))
    one = F.struct(F.col("section").cast("int").alias("section"), name.alias("markdown_file"), F.col("n").cast("int").alias("entry_count"))
    counted = entries.groupBy("doc_id", "section").agg(F.count(F.lit(1)).alias("n")).groupBy("doc_id").agg(F.array_sort(F.collect_list(one)).alias("sections")).join(bounds, "doc_id")
    manifest = counted.select(F.concat(folder, F.lit(MANIFEST)).alias("path"), F.concat(F.to_json(F.struct("start_page", "end_page", "sections")), F.lit("\n")).alias("text"))
    return files.unionByName(manifest)
