"""Layout tables: their schemas, readers, and rows from placed text."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.functions import col

SPANS = (
    "doc_id long, page int, block_idx int, block_type int, block_x0 double, block_y0 double, line_idx int, "
    "line_x0 double, line_y0 double, line_x1 double, span_idx int, text string, size double, font string"
)
DRAWINGS = "doc_id long, page int, draw_idx int, x0 double, y0 double, width double, height double"
PAGES = "doc_id long, page int, text string"


def read_spans(spark: SparkSession, path: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """Spans of a page range; the range reaches the scan, which skips row groups of other pages."""
    df = spark.read.schema(SPANS).parquet(path)
    if first is not None:
        df = df.where(df["page"] >= first)
    if last is not None:
        df = df.where(df["page"] <= last)
    return df


def read_markdown(spark: SparkSession, folder: str, pattern: str = "*.md") -> DataFrame:
    """(path, text) of every file of a tree; a file is one row."""
    return spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).text(folder, wholetext=True).selectExpr("_metadata.file_path as path", "value as text")


def read_manifests(spark: SparkSession, folder: str, schema: str, name: str = "table_of_contents.json") -> DataFrame:
    """Manifests of a tree with a status: OK, EMPTY or UNREADABLE. A missing file has no row: see ``with_missing``."""
    raw = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", name).text(folder, wholetext=True).selectExpr("_metadata.file_path as path", "value")
    parsed = raw.selectExpr("path", "value", f"from_json(value, '{schema}') as manifest")
    return parsed.selectExpr("path", "manifest", "case when trim(value) = '' then 'EMPTY' when manifest is null or not (value rlike '^\\\\s*[{\\\\[]') then 'UNREADABLE' else 'OK' end as status")


def with_missing(spark: SparkSession, manifests: DataFrame, expected: list[str], key: str = "path") -> DataFrame:
    """``manifests`` with a row for each expected path that has none: EMPTY if there is such a file, as readers have no row
    for a file of no bytes, else MISSING. The expected paths are a list of some sections."""

    def exists(path: str) -> bool:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)

    found = {r[key] for r in manifests.where(col(key).isin(expected)).select(key).collect()}
    lost = [(p, "EMPTY" if exists(p) else "MISSING") for p in dict.fromkeys(expected) if p not in found]
    return manifests.unionByName(spark.createDataFrame(lost, f"{key} string, status string"), allowMissingColumns=True) if lost else manifests


def placed(spark: SparkSession, items: Iterable[tuple], rules: Iterable[tuple] = ()) -> tuple[DataFrame, DataFrame]:
    """(spans, drawings) from items (doc_id, page, x, baseline y, text, font, size), each a block of its own, and rules
    (doc_id, page, y). The top of a line lies 0.9 of its size above the baseline."""
    rows = []
    for k, (doc, page, x, y, text, font, size) in enumerate(items):
        top = y - 0.9 * size
        rows.append((doc, page, k, 0, float(x), top, 0, float(x), top, float(x) + 0.45 * size * len(text), 0, text, float(size), font))
    drawn = [(doc, page, k, 88.0, float(y), 162.0, 0.5) for k, (doc, page, y) in enumerate(rules)]
    return spark.createDataFrame(rows, SPANS), spark.createDataFrame(drawn, DRAWINGS)
