"""The tree of files: all of a job's files or none, and manifests over several runs."""

import json

import pytest
from pyspark.sql import functions as F

from folioframe.operators import extract
from folioframe.session import ship
from folioframe.sources import sinks, tree
from folioframe.sources.layout import read_markdown

LEAVES = "doc_id long, part int, section int, roman string, category string, kind string, number int, title string, start_page int, end_page int, leaf int, has_variants boolean, n_notes int, markdown string"


def names(folder):
    return sorted(str(p.relative_to(folder)) for p in folder.rglob("*") if p.is_file())


def leaves(spark, rows):
    return spark.createDataFrame(rows, LEAVES).withColumn("path", extract.leaf_path())


BOOKS = [(d, 2, 1, "I", "I. BIỂN", "story", 1, "CON TÀU", 5, 6, 1, False, 0, f"## tale of {d}\n") for d in (1, 2)] + [
    (1, 2, 2, "II", "II. SÔNG", "story", 2, "NGƯỜI LÁI", 7, 8, 2, True, 3, "## two\n"),
    (1, 2, 2, "II", "II. SÔNG", "story", 2, "NGƯỜI LÁI", 9, 9, 3, False, 0, "## two again\n"),
    (1, 1, None, None, None, "introduction", None, "NÓI VỀ BIỂN", 2, 4, 4, False, 0, "## intro\n"),
]


def write(spark, rows, folder):
    mine = leaves(ship(spark), rows).cache()
    tree.write_tree(mine.select("path", F.col("markdown").alias("text")).unionByName(extract.section_manifests(mine)).repartition(3), str(folder))
    found = sinks.within_tree(read_markdown(spark, str(folder), extract.MANIFEST))
    tree.write_tree(extract.root_manifests(found), str(folder))
    return mine


def test_two_books_round_trip(spark, tmp_path):
    """Documents with equal titles keep their leaves apart, also two leaves of one number and title."""
    mine = write(spark, BOOKS, tmp_path)
    got = {r["path"]: r["text"] for r in sinks.read_leaves(spark, str(tmp_path)).collect()}
    assert got == {r["path"]: r["markdown"] for r in mine.collect()} and len(got) == 5
    assert got["document_1/part_2/I_BIEN/001_CON_TAU.md"] == "## tale of 1\n" and got["document_2/part_2/I_BIEN/001_CON_TAU.md"] == "## tale of 2\n"
    assert names(tmp_path) == sorted([
        *got, "document_1/table_of_contents.json", "document_2/table_of_contents.json", "document_1/part_1/table_of_contents.json",
        "document_1/part_2/I_BIEN/table_of_contents.json", "document_1/part_2/II_SONG/table_of_contents.json", "document_2/part_2/I_BIEN/table_of_contents.json",
    ])
    root = json.loads((tmp_path / "document_1/table_of_contents.json").read_text())
    assert root["total"] == 4 and [(p["part"], p["total"], len(p["sections"])) for p in root["parts"]] == [(1, 1, 1), (2, 3, 2)]


def test_partial_run_keeps_the_rest(spark, tmp_path):
    write(spark, BOOKS, tmp_path)
    changed = [(*BOOKS[2][:13], "## two, anew\n")]
    write(spark, changed, tmp_path)
    root = json.loads((tmp_path / "document_1/table_of_contents.json").read_text())
    assert [(p["part"], [s["total"] for s in p["sections"]]) for p in root["parts"]] == [(1, [1]), (2, [1, 1])]
    assert (tmp_path / "document_1/part_2/II_SONG/002_NGUOI_LAI.md").read_text() == "## two, anew\n"
    assert json.loads((tmp_path / "document_2/table_of_contents.json").read_text())["total"] == 1


def test_failed_job_leaves_nothing(spark, tmp_path):
    ship(spark)
    (tmp_path / "kept.md").write_text("old")
    files = spark.range(20).select(F.concat(F.lit("a/"), "id", F.lit(".md")).alias("path"), F.lit("x").alias("text")).repartition(4)
    failing = files.withColumn("text", F.when(F.col("path") == "a/7.md", F.raise_error(F.lit("broken row"))).otherwise(F.col("text")))
    with pytest.raises(Exception, match="broken row"):
        tree.write_tree(failing, str(tmp_path))
    assert names(tmp_path) == ["kept.md"]
    with pytest.raises(Exception, match="more than one row"):
        tree.write_tree(files.union(files.limit(1)), str(tmp_path))
    for bad in ("../x.md", "/x.md", "", None, "a/../b.md", "."):
        with pytest.raises(Exception, match="no path of a file"):
            tree.write_tree(spark.createDataFrame([(bad, "x")], "path string, text string"), str(tmp_path))
    assert names(tmp_path) == ["kept.md"] and not list(tmp_path.glob("_staging*"))
    tree.write_tree(files.limit(0), str(tmp_path))
    tree.write_tree(spark.createDataFrame([("kept.md", None)], "path string, text string"), f"file://{tmp_path}")
    assert (tmp_path / "kept.md").read_text() == ""


def test_sink_needs_its_columns(spark, tmp_path):
    spark.dataSource.register(tree.TreeSink)
    with pytest.raises(Exception, match="path and text"):
        spark.range(1).write.format("folio_tree").mode("append").save(str(tmp_path))
