"""Table functions in SQL against the DataFrame operators."""

import random

import pytest
from pyspark.sql import functions as F

from folioframe.operators import footnotes, markdown, name_index, table_functions
from folioframe.session import ship
from folioframe.sources.layout import PAGES
from tests.test_names import INDEX

PIECES = ["1 Parish", "2 Toll", "11. Salt", "(2. Thieves)", "(see 1", "3 Rope)", "22 Bells", "and on", "3. \"Sea", "A", "1", "- x", ")", "(", "1. 2. B"]


def test_notes(spark):
    """Random feet of pages: the walk gives what the fold gives."""
    ship(spark)
    table_functions.register(spark)
    r = random.Random(3)
    rows = [(d, p, k, r.choice(PIECES)) for d in range(3) for p in range(150) for k in range(r.randint(1, 6))] + [(9, 1, 0, None), (9, 2, 0, " "), (None, 1, 0, "1 Lost.")]
    feet = spark.createDataFrame(rows, "doc_id long, page int, ord int, raw string").repartition(3)
    feet.createOrReplaceTempView("feet")
    got = spark.sql("SELECT * FROM folio_notes(TABLE(feet) PARTITION BY (doc_id, page) ORDER BY ord)")
    lines = feet.withColumn("band", F.lit("footer"))
    expected = footnotes.page_notes(lines).select("doc_id", "page", "pos", "num", "text", "continued")
    assert got.columns == expected.columns and got.schema["doc_id"].dataType.simpleString() == "bigint"
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, expected.collect()), key=repr)


MD = ["", "## 3. BẾN ĐÒ", "## Second", "# I. BIỂN", "Text[^1].", "> Verse,", "---", "### KHẢO DỊ", "[^1]: (Trang 3-4) Note", "[^2]: Bare", "    > verse", "    goes on[^9]", "### Chú thích", "  plain  "]


def test_markdown(spark):
    ship(spark)
    table_functions.register(spark)
    r = random.Random(4)
    texts = [("a", ""), *((f"f{k}", "\n".join(r.choice(MD) for _ in range(r.randint(1, 14)))) for k in range(120))]
    files = spark.createDataFrame(texts, "path string, text string").repartition(3)
    files.select("path", F.posexplode(F.split("text", "\n")).alias("n", "line")).createOrReplaceTempView("md")
    rows = spark.sql("SELECT * FROM folio_markdown(TABLE(md) PARTITION BY path ORDER BY n)").collect()
    got = {p: {"title": None, "category": None, "body": [], "has_variants": False, "notes": []} for p, _ in texts}
    for x in rows:
        own = got[x["path"]]
        if x["kind"] == "note":
            own["notes"].append((x["num"], x["page"], x["end_page"], x["text"]))
        elif x["kind"] == "body":
            own["body"].append(x["text"])
        elif x["kind"] == "variants":
            own["has_variants"] = True
        else:
            own[x["kind"]] = x["text"]
    for e in markdown.parse(files).collect():
        own = got[e["path"]]
        assert (own["title"], own["category"], "\n".join(own["body"]), own["has_variants"]) == (e["title"], e["category"], e["body"], e["has_variants"]), e
        assert own["notes"] == [(n["num"], n["page"], n["end_page"], n["text"]) for n in e["notes"]]


def test_index(spark):
    ship(spark)
    table_functions.register(spark)
    pages = spark.createDataFrame([(d, k, x) for d in (1, 2) for k, x in enumerate(INDEX)], PAGES).repartition(4)
    pages.createOrReplaceTempView("index_pages")
    got = spark.sql("SELECT * FROM folio_index(TABLE(index_pages) PARTITION BY doc_id ORDER BY page)")
    expected = name_index.records(pages)
    assert got.columns == expected.columns
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))


def test_tables_are_checked(spark):
    table_functions.register(spark)
    spark.range(2).createOrReplaceTempView("ids")
    with pytest.raises(Exception, match="needs the columns doc_id, page, raw"):
        spark.sql("SELECT * FROM folio_notes(TABLE(ids) PARTITION BY id)").collect()
    with pytest.raises(Exception, match="takes a table"):
        spark.sql("SELECT * FROM folio_index('x')").collect()
