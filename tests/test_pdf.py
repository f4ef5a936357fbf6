"""PDF files as tables, with a reader that stands in for a PDF library."""

import shutil

import pytest
from pyspark.sql import functions as F

from folioframe.operators import layout
from folioframe.sources import pdf

STUB = {"reader": "tests.pdf_stub:read"}


def book(n):
    return "\f".join(f"99 100 13.7 Times-Roman Page {k} begins.\n99 130 13.7 Times-Italic and ends.\n88 690 0 rule 160\n88 705 11.7 Times-Roman 1 Note {k}." for k in range(1, n + 1))


@pytest.fixture
def shelf(tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "a.pdf").write_text(book(7))
    (tmp_path / "in/b.PDF").write_text(book(3))
    (tmp_path / "empty.pdf").write_text("")
    (tmp_path / "no.txt").write_text("x")
    return tmp_path


def test_three_tables(spark, shelf):
    spans = pdf.read_pdf(spark, str(shelf), **STUB)
    assert spans.count() == 30 and [f.name for f in spans.schema] == [c.split()[0] for c in pdf.SPANS.split(", ")]
    a, b = pdf.document_id("a.pdf"), pdf.document_id("in/b.PDF")
    assert {(r["doc_id"], r["n"]) for r in spans.groupBy("doc_id").agg(F.countDistinct("page").alias("n")).collect()} == {(a, 7), (b, 3)}
    rules = pdf.read_pdf(spark, str(shelf), "drawings", **STUB)
    assert {tuple(r)[3:] for r in rules.collect()} == {(88.0, 690.0, 160.0, 0.5)} and rules.count() == 10
    texts = pdf.read_pdf(spark, str(shelf), "pages", **STUB).where(F.col("doc_id") == b).orderBy("page")
    assert [r["text"] for r in texts.collect()][1] == "Page 2 begins.\nand ends.\n1 Note 2."
    got = layout.lines(spans, rules).where(F.col("doc_id") == a).groupBy("band").count().collect()
    assert {r["band"]: r["count"] for r in got} == {"body": 14, "footer": 7}


def test_pages_are_split_over_tasks(spark, shelf):
    spans = pdf.read_pdf(spark, str(shelf), pagesPerTask="2", **STUB)
    tasks = spans.select("doc_id", "page", F.spark_partition_id().alias("task")).distinct().collect()
    pages = {}
    for r in tasks:
        pages.setdefault(r["task"], set()).add((r["doc_id"], r["page"]))
    assert len(pages) == 4 + 2 and max(map(len, pages.values())) == 2 and sum(map(len, pages.values())) == 10


def test_page_filter_is_pushed(spark, shelf):
    spans = pdf.read_pdf(spark, str(shelf), pagesPerTask="2", **STUB)
    for condition, wanted in (("page >= 3 and page < 5", {3, 4}), ("page = 7", {7}), ("page > 6", {7}), ("page > 90", set()), ("page between 5 and 4", set()), ("page in (1, 7)", {1, 7})):
        got = spans.where(condition).select("page", F.spark_partition_id().alias("task")).distinct().collect()
        assert {r["page"] for r in got} == wanted
    reader = pdf.PdfReader({"path": str(shelf), "pagesPerTask": "2", **STUB})
    left = list(reader.pushFilters([pdf.GreaterThanOrEqual(("page",), 3), pdf.LessThan(("page",), 5), pdf.EqualTo(("doc_id",), pdf.document_id("a.pdf")), pdf.EqualTo(("font",), "x")]))
    assert [f.attribute for f in left] == [("font",)]
    assert [(p.path.rsplit("/", 1)[1], p.first, p.last) for p in reader.partitions()] == [("a.pdf", 3, 4)]
    # Less than a range was asked for: the driver need not open the file.
    opened = shelf / "a.pdf.opened"
    before = opened.read_text()
    one = pdf.PdfReader({"path": str(shelf), **STUB})
    assert list(one.pushFilters([pdf.EqualTo(("page",), 2)])) == [] and {(p.first, p.last) for p in one.partitions()} == {(2, 2)}
    assert opened.read_text() == before


def test_ids_stay_when_the_folder_moves(spark, shelf, tmp_path_factory):
    there = tmp_path_factory.mktemp("moved") / "shelf"
    shutil.copytree(shelf, there)
    ids = lambda folder: {r["doc_id"] for r in pdf.read_pdf(spark, f"file://{folder}", **STUB).select("doc_id").distinct().collect()}
    assert ids(shelf) == ids(there)


def test_faults(spark, shelf):
    (shelf / "bad.pdf").write_text("broken")
    with pytest.raises(Exception, match="bad.pdf: not a book"):
        pdf.read_pdf(spark, str(shelf), **STUB).count()
    with pytest.raises(Exception, match="no table"):
        pdf.read_pdf(spark, str(shelf), "fonts", **STUB).count()
    with pytest.raises(Exception, match="no PDF library here"):
        pdf.read_pdf(spark, str(shelf / "a.pdf")).count()
    assert pdf.read_pdf(spark, str(shelf / "a.pdf"), **STUB).select("page").distinct().count() == 7
