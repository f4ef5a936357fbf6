"""PDF files as tables: a data source with a partition for each range of pages.

    spark.dataSource.register(PdfSource)
    spark.read.format("folio_pdf").option("table", "spans").load(folder).where("page between 5 and 90")

``table`` is ``spans`` (text with its places and fonts), ``drawings`` (filled or stroked shapes) or ``pages`` (plain text).
``pagesPerTask`` pages (64 as a rule) are one partition, so that a long book is read by many tasks, each
opening the file for itself. Filters on ``page`` and ``doc_id`` choose the partitions and pages to read. ``reader`` names
the function that opens a file, ``module:function``; as a rule that of a PDF library, where one is installed. It takes
the path and gives an object with ``len()`` and ``[page]``, closed in the end, whose pages have ``get_text("dict")``,
``get_text()`` and ``get_drawings()``.

Defined results: ``doc_id`` is the first 8 bytes of the SHA-256 of the path below the folder, so that it stays when the
folder moves; a file without pages has no rows; pages without text, blocks or drawings have none in that table (in
``pages`` an empty text). A file that cannot be opened fails the job and is named.
"""

from __future__ import annotations

import hashlib
import importlib
import posixpath
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow.fs as fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

from folioframe.sources.layout import DRAWINGS, PAGES, SPANS
from folioframe.sources.tree import opened

SCHEMAS = {"spans": SPANS, "drawings": DRAWINGS, "pages": PAGES}
PAGES_PER_TASK = 64
LAST_PAGE = 1 << 30


def library_reader(system: fs.FileSystem, path: str):
    """Opens a file with the PDF library, if it is installed."""
    try:
        import fitz  # the PDF library's module
    except ImportError as e:
        raise RuntimeError("no PDF library here: give layout tables instead (sources.layout), or a reader") from e
    if isinstance(system, fs.LocalFileSystem):
        return fitz.open(path)
    with system.open_input_file(path) as f:
        return fitz.open(stream=f.read(), filetype="pdf")


def found_reader(name: str | None) -> Callable:
    if not name:
        return library_reader
    module, function = name.split(":")
    return getattr(importlib.import_module(module), function)


@dataclass
class PageRange(InputPartition):
    """Pages of one file, from 1, both ends included."""

    path: str
    doc_id: int
    first: int
    last: int


def document_id(path: str) -> int:
    return int.from_bytes(hashlib.sha256(path.encode()).digest()[:8], "big", signed=True)


def span_rows(doc_id: int, number: int, page) -> Iterator[tuple]:
    for i, block in enumerate(page.get_text("dict")["blocks"]):
        for j, line in enumerate(block.get("lines", [])):
            x0, y0, x1, _ = line["bbox"]
            for k, s in enumerate(line["spans"]):
                yield (doc_id, number, i, block["type"], *map(float, block["bbox"][:2]), j, float(x0), float(y0), float(x1), k, s["text"], float(s["size"]), s["font"])


def drawing_rows(doc_id: int, number: int, page) -> Iterator[tuple]:
    for k, d in enumerate(page.get_drawings()):
        x0, y0, x1, y1 = map(float, d["rect"])
        yield doc_id, number, k, x0, y0, x1 - x0, y1 - y0


def text_rows(doc_id: int, number: int, page) -> Iterator[tuple]:
    yield doc_id, number, page.get_text()


ROWS = {"spans": span_rows, "drawings": drawing_rows, "pages": text_rows}


class PdfReader(DataSourceReader):
    def __init__(self, options: dict):
        self.folder, self.table, self.reader = options["path"], options.get("table", "spans"), options.get("reader")
        self.per_task = int(options.get("pagesPerTask", PAGES_PER_TASK))
        if self.per_task < 1:
            raise ValueError("pagesPerTask is 1 at least")
        self.first, self.last, self.documents = 1, LAST_PAGE, None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Takes bounds of ``page`` and values of ``doc_id``; hands all others back."""
        for f in filters:
            name, value = ".".join(f.attribute) if hasattr(f, "attribute") else None, getattr(f, "value", None)
            if name == "page" and value is not None and isinstance(f, (GreaterThan, GreaterThanOrEqual, EqualTo, LessThan, LessThanOrEqual)):
                if isinstance(f, (GreaterThan, GreaterThanOrEqual, EqualTo)):
                    self.first = max(self.first, value + isinstance(f, GreaterThan))
                if isinstance(f, (LessThan, LessThanOrEqual, EqualTo)):
                    self.last = min(self.last, value - isinstance(f, LessThan))
            elif name == "doc_id" and isinstance(f, (EqualTo, In)) and value is not None:
                wanted = set(value) if isinstance(f, In) else {value}
                self.documents = wanted if self.documents is None else self.documents & wanted
            else:
                yield f

    def partitions(self) -> list[PageRange]:
        """Ranges of the wanted pages. The driver lists the files, and asks each wanted one for its number of pages unless
        the filters ask for less than one range of it."""
        system, root = opened(self.folder)
        at = system.get_file_info(root)
        files = [at] if at.type == fs.FileType.File else system.get_file_info(fs.FileSelector(root, recursive=True))
        base = posixpath.dirname(root) if at.type == fs.FileType.File else root
        out = []
        for info in sorted((i for i in files if i.type == fs.FileType.File and i.path.lower().endswith(".pdf")), key=lambda i: i.path):
            doc_id = document_id(posixpath.relpath(info.path, base))
            if self.documents is not None and doc_id not in self.documents or self.last < self.first:
                continue
            last = self.last if self.last - self.first < self.per_task else min(self.last, self._length(system, info.path))
            out += [PageRange(info.path, doc_id, a, min(a + self.per_task - 1, last)) for a in range(self.first, last + 1, self.per_task)]
        return out

    def _open(self, system: fs.FileSystem, path: str):
        try:
            return found_reader(self.reader)(system, path)
        except Exception as e:
            raise RuntimeError(f"{path}: {e}") from e

    def _length(self, system: fs.FileSystem, path: str) -> int:
        document = self._open(system, path)
        try:
            return len(document)
        finally:
            document.close()

    def read(self, partition: PageRange | None) -> Iterator[tuple]:
        if partition is None:  # Spark's way of reading a source without partitions
            return
        document = self._open(opened(self.folder)[0], partition.path)
        try:
            for number in range(partition.first, min(partition.last, len(document)) + 1):
                yield from ROWS[self.table](partition.doc_id, number, document[number - 1])
        finally:
            document.close()


class PdfSource(DataSource):
    """The format ``folio_pdf``."""

    @classmethod
    def name(cls) -> str:
        return "folio_pdf"

    def schema(self) -> str:
        table = self.options.get("table", "spans")
        if table not in SCHEMAS:
            raise ValueError(f"no table {table!r}: one of {', '.join(SCHEMAS)}")
        return SCHEMAS[table]

    def reader(self, schema) -> PdfReader:
        return PdfReader(self.options)


def read_pdf(spark: SparkSession, path: str, table: str = "spans", **options: str) -> DataFrame:
    """A table of every PDF below ``path`` (or of one file)."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(PdfSource)
    return spark.read.format("folio_pdf").options(table=table, **options).load(path)
