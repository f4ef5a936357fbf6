"""Verse within notes, and notes open from before a leaf."""

import pytest
from pyspark.sql import functions as F

from folioframe.operators import footnotes, layout, render
from folioframe.sources.layout import placed

ROMAN, ITALIC = "Times-Roman", "Times-Italic"
NOTE = "doc_id long, page int, pos int, num int, text string, continued boolean"


def foot(spark, *rows, page=1):
    """Notes of a page from (x, text, font) lines of its foot."""
    items = [(1, page, 99, 100, "The ferry sank.", ROMAN, 13.7)]
    items += [(1, page, x, 700 + 9 * k, text, font, 11.7) for k, (x, text, font) in enumerate(rows)]
    spans, drawings = placed(spark, items, [(1, page, 690)])
    return footnotes.page_notes(layout.mark_verse(layout.lines(spans, drawings)))


def parts(row):
    return [p["text"] if p["kind"] == "text" else list(p["lines"]) for p in row["parts"]]


def test_verse_in_a_note(spark):
    rows = foot(spark, (88, "1 Rowers sing there:", ROMAN), (253, "Pull for the shore,", ITALIC), (253, "pull for the bell.", ITALIC), (88, "after each haul. 2 Toll roll.", ROMAN), (253, "Salt on the rope.", ITALIC)).orderBy("pos").collect()
    assert [parts(r) for r in rows] == [["Rowers sing there:", ["Pull for the shore,", "pull for the bell."], "after each haul."], ["Toll roll.", ["Salt on the rope."]]]
    assert rows[0]["text"] == "Rowers sing there: Pull for the shore, pull for the bell. after each haul."


def test_notes_without_verse_have_no_parts(spark):
    rows = foot(spark, (88, "1 Parish book. 2 Toll roll.", ROMAN)).collect()
    assert [list(r["parts"]) for r in rows] == [[], []]
    spans, drawings = placed(spark, [(1, 1, 88, 705, "1 Note.", ROMAN, 11.7)], [(1, 1, 690)])
    assert footnotes.page_notes(layout.lines(spans, drawings)).head()["parts"] == []


@pytest.mark.parametrize(
    ("texts", "verses", "expected"),
    [
        (["x ab y ab z"], ["ab", "ab"], [(0, 3, 2), (0, 8, 2)]),
        (["x", "y ab", "ab"], ["ab", "ab"], [(1, 3, 2), (2, 1, 2)]),
        (["ab", "cd"], ["cd", "ab"], [(1, 1, 2)]),  # order counts: what stands before is not looked at again
        (["ab cd"], ["zz", "cd"], []),  # a line that is nowhere ends the search
        (["ab"], ["", "ab"], []),
        ([], ["ab"], []),
        (["ab"], [], []),
    ],
)
def test_places(spark, texts, verses, expected):
    row = spark.createDataFrame([(texts, verses)], "t array<string>, v array<string>")
    got = row.select(footnotes.verse_places(F.col("t"), F.col("v")).alias("p")).head()["p"]
    assert [tuple(p) for p in got] == expected


def test_verse_over_a_page_break(spark):
    """Verse split by the break is one verse; prose joins with a space."""
    first = foot(spark, (88, "1 Rowers sing:", ROMAN), (253, "Pull for the shore,", ITALIC))
    second = foot(spark, (253, "pull for the bell.", ITALIC), (88, "and no more.", ROMAN), page=2)
    third = foot(spark, (88, "So it goes.", ROMAN), page=3)
    got = footnotes.merge_notes(first.unionByName(second).unionByName(third)).collect()
    assert [(r["num"], r["page"], r["end_page"]) for r in got] == [(1, 1, 3)]
    assert parts(got[0]) == ["Rowers sing:", ["Pull for the shore,", "pull for the bell."], "and no more. So it goes."]


def test_rendered_as_block_quotes(spark):
    notes = footnotes.merge_notes(foot(spark, (88, "1 Rowers sing:", ROMAN), (253, "Pull for the shore,", ITALIC), (253, "pull.", ITALIC), (88, "2 Toll roll.", ROMAN)))
    n = notes.agg(F.array_sort(F.collect_list(F.struct("page", "num", "end_page", "text", "parts"))).alias("n"))
    text = n.select(render.leaf_markdown(F.lit("T"), F.expr("cast(array() as array<struct<kind:string,text:string,lines:array<string>>>)"), F.col("n"), with_parts=True).alias("m")).head()["m"]
    assert text == "## T\n\n---\n\n### Chú thích\n\n[^1]: (Trang 1) Rowers sing:\n\n    > Pull for the shore,\n    > pull.\n\n[^2]: (Trang 1) Toll roll.\n"


def pages_of(spark, *rows):
    return spark.createDataFrame([(1, p, k, n, f"n{p}", c) for p, k, n, c in rows], NOTE)


def test_look_back(spark):
    """Eleven pages are looked at, the last one and ten before; one more, or a gap, and nothing is open."""
    for run, gap, expected in ((10, False, 4), (11, False, None), (3, True, None)):
        last = 20 + run
        rows = [(20, 0, 4, False)] + [(p, 0, 1, True) for p in range(21, last + 1) if not (gap and p == 22)]
        at = {r["page"]: r["open"] for r in footnotes.open_at_foot(pages_of(spark, *rows)).collect()}
        assert at[last] == expected and at[20] == 4


@pytest.mark.parametrize(("run", "head"), [(1, (4, 32, 32, True)), (9, (4, 32, 32, True)), (12, (1, 32, 33, False))])
def test_leaf_after_a_long_note(spark, run, head):
    """A leaf begins within a note: it keeps the note's number, as far as that is found."""
    first = 32 - run
    rows = [(first - 1, 0, 4, False)] + [(p, 0, 1, True) for p in range(first, 33)] + [(32, 1, 1, False), (33, 0, 1, True)]
    if run == 12:
        rows = rows[:-2] + [(33, 0, 1, True)]
    leaves = spark.createDataFrame([(1, 7, 32, 33)], "doc_id long, leaf int, start_page int, end_page int")
    got = footnotes.merge_notes(pages_of(spark, *rows), leaves).orderBy("page", "end_page").collect()
    assert (got[0]["num"], got[0]["page"], got[0]["end_page"], got[0]["continued"]) == head
    if run != 12:
        assert [(r["num"], r["page"], r["end_page"], r["continued"]) for r in got] == [head, (1, 32, 33, False)]
