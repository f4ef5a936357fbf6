"""Commands over layout tables: extract, validate, index, survey.

    python -m folioframe.cli extract  --spans S --drawings D --pages P --out O [--part N [--section SPEC]] [--last-page N]
    python -m folioframe.cli validate --extracted E --spans S --drawings D --pages P --out O [--errata A] [--threshold X]
    python -m folioframe.cli index    --pages P --stories S --out O
    python -m folioframe.cli survey   --spans S --drawings D --out O [--pages P] [--extracted E]

``extract`` writes leaves (Parquet) and below ``markdown`` a tree of files: document, part, section, a file per leaf, the
bibliography, and a manifest in each folder; a run over one part replaces that part's files and keeps the others in the
document's manifest. ``validate`` checks the files that ``extract`` wrote against the pages and
writes results and report; ``--errata`` (path, flag, reason) and ``--drift-errata`` (path of a section, flag, delta, reason)
name what is known to be the print's own fault. ``index`` writes records, resolved targets, aliases and what is left open, as Parquet, and the
records as JSON. ``survey`` writes layout, italic fonts, poems, breaks of dialogue, recurring notes and notes over page
breaks as Parquet, and a Markdown catalogue of each document: by section where ``--pages`` gives the contents, with the leaf
of each finding where ``--extracted`` gives the leaves.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioframe.operators import extract, footnotes, layout, leaf_validation, name_index, survey, toc
from folioframe.operators.select import parse_spec
from folioframe.session import ship
from folioframe.sources import layout as source
from folioframe.sources import sinks, tree

SECTION_NEEDS_PART = "--section needs --part: sections are numbered anew in every part"
ERRATA = "path string, flag string, reason string"


def _there(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _save(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def run_extract(spark: SparkSession, a: argparse.Namespace) -> None:
    spans, drawings, pages = source.read_spans(spark, a.spans), spark.read.parquet(a.drawings), spark.read.parquet(a.pages)
    _save(extract.extract(spans, drawings, pages, a.last_page, a.part, parse_spec(a.section) if a.section else None), f"{a.out}/leaves")
    leaves = spark.read.parquet(f"{a.out}/leaves")
    folder = f"{a.out}/markdown"
    files = leaves.select("path", F.col("markdown").alias("text")).unionByName(extract.section_manifests(leaves))
    if a.part is None:
        files = files.unionByName(extract.bibliography_files(spans, drawings, pages, a.last_page))
        _save(extract.drift(pages, leaves), f"{a.out}/drift")
    tree.write_tree(files, folder)
    found = sinks.within_tree(source.read_markdown(spark, folder, extract.MANIFEST))
    tree.write_tree(extract.root_manifests(found), folder)


def run_validate(spark: SparkSession, a: argparse.Namespace) -> None:
    leaves = spark.read.parquet(f"{a.extracted}/leaves")
    pages = spark.read.parquet(a.pages)
    notes = footnotes.merge_notes(footnotes.page_notes(layout.lines(source.read_spans(spark, a.spans), spark.read.parquet(a.drawings))))
    allowed = spark.read.parquet(a.errata) if a.errata else spark.createDataFrame([], ERRATA)
    out = leaf_validation.validate_leaves(sinks.read_leaves(spark, f"{a.extracted}/markdown"), extract.jobs(leaves), pages, notes, allowed, a.threshold, a.min_density)
    _save(out, f"{a.out}/results")
    results = spark.read.parquet(f"{a.out}/results")
    report = leaf_validation.report(results)
    if _there(spark, f"{a.extracted}/drift"):
        known = spark.read.parquet(a.drift_errata) if a.drift_errata else spark.createDataFrame([], extract.DRIFT_ERRATA)
        _save(extract.known_drift(spark.read.parquet(f"{a.extracted}/drift"), known), f"{a.out}/drift")
        for r in spark.read.parquet(f"{a.out}/drift").orderBy("path").toLocalIterator():
            report += f"- part {r['part']}, section {r['section']}: {r['flag']} ({r['actual']} of {r['expected']})" + (f" - known: {r['reason']}" if r["erratum"] else "") + "\n"
    spark.createDataFrame([(report,)], "value string").coalesce(1).write.mode("overwrite").text(f"{a.out}/report")


def run_index(spark: SparkSession, a: argparse.Namespace) -> None:
    _save(name_index.records(spark.read.parquet(a.pages)), f"{a.out}/records")
    index, stories = spark.read.parquet(f"{a.out}/records"), spark.read.parquet(a.stories)
    _save(name_index.resolve(index, stories), f"{a.out}/resolved")
    _save(name_index.with_aliases(index), f"{a.out}/aliases")
    resolved, aliases = spark.read.parquet(f"{a.out}/resolved"), spark.read.parquet(f"{a.out}/aliases")
    _save(name_index.unresolved(index, resolved, aliases, stories), f"{a.out}/unresolved")
    _save(resolved.where("tier = 3"), f"{a.out}/fuzzy")
    sinks.write_json(name_index.to_json(index), f"{a.out}/json")


def run_survey(spark: SparkSession, a: argparse.Namespace) -> None:
    spans = source.read_spans(spark, a.spans)
    rows = layout.mark_verse(layout.lines(spans, spark.read.parquet(a.drawings)))
    notes = footnotes.page_notes(rows)
    _save(survey.layout_stats(rows), f"{a.out}/layout")
    _save(survey.italic_fonts(spans), f"{a.out}/fonts")
    _save(layout.poem_runs(rows), f"{a.out}/poems")
    _save(survey.dialogue_breaks(rows), f"{a.out}/dialogue_breaks")
    _save(survey.recurring_notes(notes), f"{a.out}/recurring_notes")
    _save(survey.footnote_chains(footnotes.merge_notes(notes)), f"{a.out}/note_chains")
    if a.pages:
        sections = toc.sections(toc.entries(spark.read.parquet(a.pages))).where("section is not null")
        ranges = sections.select("doc_id", (F.col("part") * 1000 + F.col("section")).alias("range"), F.format_string("Part %s, %s. %s", F.col("part").cast("string"), "roman", "title").alias("label"), "start_page", "end_page")
    else:
        ranges = spans.groupBy("doc_id").agg(F.min("page").alias("start_page"), F.max("page").alias("end_page")).select("doc_id", F.lit(1).alias("range"), F.lit("All pages").alias("label"), "start_page", "end_page")
    leaves = spark.read.parquet(f"{a.extracted}/leaves").select("doc_id", "leaf", "start_page", "end_page") if a.extracted else None
    tree.write_tree(survey.catalogue(rows, spans, ranges, leaves), f"{a.out}/catalogue")


COMMANDS = {
    "extract": (run_extract, ("spans", "drawings", "pages")),
    "validate": (run_validate, ("extracted", "spans", "drawings", "pages")),
    "index": (run_index, ("pages", "stories")),
    "survey": (run_survey, ("spans", "drawings")),
}


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="folioframe")
    sub = p.add_subparsers(dest="command", required=True)
    for name, (_, needs) in COMMANDS.items():
        c = sub.add_parser(name)
        for n in (*needs, "out"):
            c.add_argument(f"--{n}", required=True)
        if name == "extract":
            c.add_argument("--part", type=int)
            c.add_argument("--section")
            c.add_argument("--last-page", type=int, default=10_000)
        if name == "survey":
            c.add_argument("--pages")
            c.add_argument("--extracted")
        if name == "validate":
            c.add_argument("--errata")
            c.add_argument("--drift-errata")
            c.add_argument("--threshold", type=float, default=leaf_validation.validate.DEFAULT_THRESHOLD)
            c.add_argument("--min-density", type=float, default=leaf_validation.validate.MIN_CHARS_PER_PAGE)
    a = p.parse_args(argv)
    if a.command == "extract" and a.section and a.part is None:
        p.error(SECTION_NEEDS_PART)
    COMMANDS[a.command][0](ship(SparkSession.builder.appName("folioframe").getOrCreate()), a)


if __name__ == "__main__":
    main()
