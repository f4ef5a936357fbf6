"""Leaves from lines: paragraphs, turns of dialogue and verse, in order, as windows over the blocks of a leaf.

A block is a run of prose or of verse lines of one layout block. What joins blocks is decided by looking at neighbours:

* A *spoken* block leads with a dash, holds one after a colon or full stop, or is a numbered point. It *runs on* into the
  next block if its last turn is a bare dash, or unfinished at the foot of a page, unless the next one leads with a dash.
* What a spoken block runs on into is spoken as well; so the blocks after it, up to the first that does not run on, form
  a chain, and what its first block is holds for all of it.
* Other prose goes on in the next block that is not spoken as long as its sentence is not finished.

Blocks that are joined are one text, which is then split into turns and narrative. A bare dash at the end of one belongs
to the verse that follows, or is the dash of the next turn. Verses without text between them are one verse.

Defined results: headings on the first page of a leaf and marks of continuation are left out, scene dividers only part
what stands around them; blank lines are ignored; a leaf without lines has no paragraphs. A numbered point stays a point
also where an unfinished narrative runs on into it over a page break.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folioframe.functions import text as t
from folioframe.operators import sequence as seq
from folioframe.operators.layout import Layout, lines, mark_verse

NOTE_HEADING = "KHẢO DỊ"  # fixed value: the heading of the notes on variants
LEAF, ORDER = ["doc_id", "leaf"], ["page", "run"]


def _spoken(text: Column) -> Column:
    return F.startswith(text, F.lit("-")) | F.contains(text, F.lit(": -")) | F.contains(text, F.lit(". -")) | text.rlike(r"^[0-9]+\.\s+")


def blocks(body: DataFrame) -> DataFrame:
    """(doc_id, leaf, page, run, kind, text, rows): the blocks of each leaf but those that are left out; kind is prose,
    verse, divider or variants (the heading of the notes on variants). ``body``: doc_id, leaf, page, ord, block_idx, text,
    is_verse."""
    runs = seq.change_islands(body, [*LEAF, "page"], ["ord"], F.struct("is_verse", "block_idx"), "run")
    g = runs.groupBy(*LEAF, "page", "run").agg(F.first("is_verse").alias("is_verse"), F.array_sort(F.collect_list(F.struct("ord", "text"))).alias("l"))
    g = g.select("*", F.transform("l", lambda x: x.text).alias("rows")).withColumn("text", F.array_join("rows", " "))
    g = g.withColumn("page_ends", F.col("run") == F.max("run").over(Window.partitionBy(*LEAF, "page")))
    first = F.col("page") == F.min("page").over(Window.partitionBy(*LEAF))
    text = F.col("text")
    heading = first & (t.clean_category_title(text).isNotNull() | t.clean_story_title(text).isNotNull())
    kind = (
        F.when(F.col("is_verse"), "verse")
        .when(heading | t.is_continuation_marker(text), "left out")
        .when(F.upper(t.strip(text)) == NOTE_HEADING, "variants")
        .when(t.is_scene_divider(t.strip(text)), "divider")
        .otherwise("prose")
    )
    return g.withColumn("kind", kind).where("kind <> 'left out'").drop("l", "is_verse")


def joined(marked: DataFrame) -> DataFrame:
    """``blocks`` with ``utterance``, which numbers what belongs together, and ``dash``: whether a bare dash at the end
    belongs to the block after it."""
    at = seq.ordered(LEAF, ORDER)
    prose = F.col("kind") == "prose"
    b = marked.withColumn("last", F.when(prose, F.element_at(t.split_dialogues(F.col("text")), -1)))
    b = b.withColumns({"spoken": prose & _spoken(F.col("text")), "led": prose & F.startswith("text", F.lit("-")), "finished": t.ends_sentence(F.col("text"))})
    b = b.withColumn("runs_on", prose & ((F.col("last") == "-") | (F.col("page_ends") & ~t.ends_sentence(F.col("last")))))
    b = b.withColumn("met", prose & F.coalesce(F.lag("runs_on").over(at), F.lit(False)) & ~F.col("led"))
    b = seq.islands(b, LEAF, ORDER, ~F.col("met") | F.col("spoken"), "chain")
    chain = seq.ordered([*LEAF, "chain"], ORDER)
    begins = F.row_number().over(chain) == 1
    b = b.withColumn("voice", F.when(begins, F.col("spoken")).otherwise(F.first("spoken").over(chain) & _spoken(F.first("last").over(chain))))
    before = lambda c: F.lag(c).over(at)
    goes_on = F.when(before("voice"), F.col("met")).otherwise(prose & (before("kind") == "prose") & ~before("finished") & ~F.col("spoken"))
    b = seq.islands(b, LEAF, ORDER, ~F.coalesce(goes_on, F.lit(False)), "utterance")
    return b.withColumn("dash", F.col("voice") & (F.col("last") == "-") & F.coalesce(F.lead(F.col("led") | (F.col("kind") == "verse")).over(at), F.lit(False)))


def paragraphs(body: DataFrame) -> DataFrame:
    """(doc_id, leaf, part, ord, kind, text, verse) of each leaf's lines."""
    at = seq.ordered(LEAF, ORDER)
    # One shuffle: all windows and groups below are by leaf.
    b = joined(blocks(body.repartition(*LEAF)))
    b = b.withColumn("part", F.when(F.max(F.col("kind") == "variants").over(seq.running(LEAF, ORDER)), "variants").otherwise("text"))
    opened = F.coalesce(F.lag("dash").over(at), F.lit(False))
    b = b.withColumn("rows", F.when(opened & (F.col("kind") == "verse"), F.concat(F.array(F.concat(F.lit("- "), F.get("rows", F.lit(0)))), F.expr("slice(rows, 2, size(rows))"))).otherwise(F.col("rows")))
    place = F.struct(*ORDER)
    u = b.where("kind in ('prose', 'verse')").groupBy(*LEAF, "part", "utterance", "kind").agg(
        F.min(place).alias("place"), F.array_sort(F.collect_list(F.struct(*ORDER, "text"))).alias("texts"), F.max_by("dash", place).alias("dash"), F.first("rows").alias("rows")
    )
    said = t.split_dialogues(F.array_join(F.transform("texts", lambda x: x.text), " "))
    said = F.when(F.col("dash"), F.filter(said, lambda x, k: (x != "-") | (k < F.size(said) - 1))).otherwise(said)
    prose = u.where("kind = 'prose'").select(*LEAF, "part", "place", F.posexplode(said).alias("pos", "text")).withColumns({"kind": F.lit("text"), "rows": F.lit(None).cast("array<string>")})
    verse = u.where("kind = 'verse'").select(*LEAF, "part", "place", F.lit(0).alias("pos"), F.lit(None).cast("string").alias("text"), F.lit("verse").alias("kind"), "rows")
    order = ["place", "pos"]
    p = seq.change_islands(prose.select(verse.columns).unionByName(verse), [*LEAF, "part"], order, F.when(F.col("kind") == "text", F.struct(*order)), "own")
    p = p.groupBy(*LEAF, "part", "own").agg(F.first("kind").alias("kind"), F.first("text").alias("text"), F.flatten(F.transform(F.array_sort(F.collect_list(F.struct(*order, "rows"))), lambda x: x.rows)).alias("verse"))
    number = (F.row_number().over(Window.partitionBy(*LEAF, "part").orderBy("own")) - 1).cast("int")
    return p.select(*LEAF, "part", number.alias("ord"), "kind", "text", F.when(F.col("kind") == "verse", F.col("verse")).alias("verse"))


def assemble(spans: DataFrame, drawings: DataFrame, leaves: DataFrame, layout: Layout = Layout()) -> DataFrame:
    """The paragraphs of every leaf (doc_id, leaf, start_page, end_page, body_top, body_bottom)."""
    body = mark_verse(lines(spans, drawings, layout), layout).where("band = 'body' and text <> ''")
    pages = leaves.withColumn("page", F.explode(F.sequence("start_page", "end_page")))
    mine = body.join(pages, ["doc_id", "page"])
    above = (F.col("page") == F.col("start_page")) & (F.col("line_y0") < F.col("body_top"))
    below = (F.col("page") == F.col("end_page")) & (F.col("line_y0") >= F.col("body_bottom"))
    mine = mine.where(~F.coalesce(above, F.lit(False)) & ~F.coalesce(below, F.lit(False)))
    return paragraphs(mine.select("doc_id", "leaf", "page", "ord", "block_idx", "text", "is_verse"))
