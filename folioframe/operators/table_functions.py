"""Table functions for SQL: ordered rows of a key in, rows out.

    table_functions.register(spark)
    SELECT * FROM folio_notes(TABLE(feet) PARTITION BY (doc_id, page) ORDER BY ord)
    SELECT * FROM folio_markdown(TABLE(md) PARTITION BY path ORDER BY n)
    SELECT * FROM folio_index(TABLE(pages) PARTITION BY doc_id ORDER BY page)

Each checks in ``analyze`` that its table has the columns it reads and is partitioned, and takes the types of the key from
it. A key's rows stream through; what is kept is one page's foot, one open note or the lines of one index.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import Row, SparkSession
from pyspark.sql.functions import AnalyzeArgument, AnalyzeResult, udtf
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, StringType, StructType

from folioframe.functions import text as t
from folioframe.operators import footnotes, markdown, name_index

_SPACING = [(re.compile(p.replace(r"\p{L}\p{N}_", r"\w")), r.replace("$", "\\")) for p, r in t.SPACING]
_CANDIDATE = re.compile(footnotes.CANDIDATE)
_LONE = re.compile(rf"^([0-9]+)(?:[.\s]+|(?=[{t.UPPER_RANGE}]))")
_DEFINITION, _QUOTE, _RULE, _GOES_ON = (re.compile(p) for p in (markdown.DEFINITION, markdown.QUOTE, markdown.RULE, markdown.CONTINUED))
TARGET = StructType().add("story", IntegerType()).add("tap", StringType()).add("location", StringType())


def _strip(s: str) -> str:
    return s.strip(" \t\n\x0b\f\r")


def _clean(s: str) -> str:
    """``clean_spaces`` for one string."""
    s = t.repaired(s)
    for pattern, new in _SPACING:
        s = pattern.sub(new, s)
    return _strip(re.sub(r"^-\s*(\S)", r"- \1", s))


def _key_schema(table: AnalyzeArgument, name: str, key: list[str], needed: list[str]) -> StructType:
    """The schema of the key, once the table has been found fit."""
    if not table.isTable:
        raise ValueError(f"{name} takes a table: TABLE(...) PARTITION BY ... ORDER BY ...")
    have = {f.name: f for f in table.dataType.fields}
    if lost := [c for c in (*key, *needed) if c not in have]:
        raise ValueError(f"{name} needs the columns {', '.join(lost)}")
    out = StructType()
    for c in key:
        out = out.add(c, have[c].dataType)
    return out


def notes_of(text: str) -> Iterator[tuple[int, str, bool]]:
    """(num, text, continued) of a page's foot, in one walk: the number of parentheses open before each candidate, and the
    balance of what is left, are carried along."""
    clean = re.sub(r"^11\.\s*", "1. ", _clean(text))
    if not clean:
        return
    starts, wanted = [(0, 0, None)], 1
    at, opened = 0, 0
    balance = lambda s: s.count("(") - s.count(")")
    left = balance(clean)
    for m in _CANDIDATE.finditer(clean):
        step = balance(clean[at : m.start()])
        opened, left, at = opened + step, left - step, m.start()
        own = balance(m[0])
        inside = opened > 0 and left - own < 0
        if not inside and (int(m[1]) == wanted or m[1] == f"{wanted}{wanted}"):
            starts.append((m.start(), m.end(), wanted))
            wanted += 1
    head = _clean(clean[: starts[1][0] if len(starts) > 1 else len(clean)])
    if len(starts) == 1 and (lone := _LONE.match(clean)):
        yield int(lone[1]), _clean(clean[lone.end() :]), False
        return
    if head:
        yield 1, head, True
    for k, (_, begin, num) in enumerate(starts[1:], 1):
        end = starts[k + 1][0] if k + 1 < len(starts) else len(clean)
        yield num, re.sub(r"^[.\s-]+", "", _clean(clean[begin:end])), False


class _Notes:
    """(doc_id, page, pos, num, text, continued) of each page from the lines of its foot (doc_id, page, ord, raw)."""

    def __init__(self):
        self.key, self.lines = None, []

    @staticmethod
    def analyze(table: AnalyzeArgument) -> AnalyzeResult:
        schema = _key_schema(table, "folio_notes", ["doc_id", "page"], ["raw"])
        return AnalyzeResult(schema.add("pos", IntegerType()).add("num", IntegerType()).add("text", StringType()).add("continued", BooleanType()))

    def eval(self, row: Row):
        self.key = row["doc_id"], row["page"]
        if line := _strip(row["raw"] or ""):
            self.lines.append(line)

    def terminate(self):
        if self.lines:
            for pos, note in enumerate(notes_of(" ".join(self.lines))):
                yield (*self.key, pos, *note)


class _Markdown:
    """(path, kind, num, page, end_page, text) of each file from its lines (path, n, line): its title, category, lines of
    the body, the heading of variants, and notes with the lines that go on with them."""

    def __init__(self):
        self.path, self.note, self.named = None, None, set()

    @staticmethod
    def analyze(table: AnalyzeArgument) -> AnalyzeResult:
        schema = _key_schema(table, "folio_markdown", ["path"], ["line"])
        return AnalyzeResult(schema.add("kind", StringType()).add("num", IntegerType()).add("page", IntegerType()).add("end_page", IntegerType()).add("text", StringType()))

    def _plain(self, line: str) -> str:
        return re.sub(t.MARKER, "", line)

    def _ended(self):
        if self.note is not None:
            num, page, end, lines = self.note
            self.note = None
            yield self.path, "note", num, page, end, _strip("\n".join(x for x in lines if x))

    def _once(self, kind: str, text: str):
        if kind not in self.named:
            self.named.add(kind)
            yield self.path, kind, None, None, None, text

    def eval(self, row: Row):
        self.path, line = row["path"], row["line"] or ""
        s = _strip(line)
        if m := _DEFINITION.match(s):
            yield from self._ended()
            page = int(m[2]) if m[2] else None
            self.note = int(m[1]), page, int(m[3]) if m[3] else page, [self._plain(s[m.end() :])]
            return
        if self.note is not None:
            if not s or _GOES_ON.match(line):
                self.note[3].append(self._plain(_QUOTE.sub("", s)))
                return
            yield from self._ended()
        if s.startswith("## "):
            yield from self._once("title", re.sub(r"^\s*[0-9]+\.\s*", "", s[3:]))
        elif s.startswith("# "):
            yield from self._once("category", _strip(s[2:]))
        elif s.upper().startswith(markdown.VARIANTS):
            yield from self._once("variants", s)
        elif not s.startswith("#") and not _RULE.match(line) and (body := _QUOTE.sub("", s)):
            yield self.path, "body", None, None, None, body

    def terminate(self):
        yield from self._ended()


class _Index:
    """(doc_id, ord, printed, qualifier, alias_of, targets) of each printed index from its pages (doc_id, page, text)."""

    def __init__(self):
        self.key, self.pages = None, []

    @staticmethod
    def analyze(table: AnalyzeArgument) -> AnalyzeResult:
        schema = _key_schema(table, "folio_index", ["doc_id"], ["text"])
        return AnalyzeResult(schema.add("ord", IntegerType()).add("printed", StringType()).add("qualifier", StringType()).add("alias_of", StringType()).add("targets", ArrayType(TARGET)))

    def eval(self, row: Row):
        self.key = row["doc_id"]
        self.pages.append(name_index.lines_of(row["text"]))

    def terminate(self):
        for k, (printed, qualifier, alias, targets) in enumerate(name_index.read_records(self.pages)):
            yield self.key, k, printed, qualifier, alias, [(x["story"], x["tap"], x["location"]) for x in targets]


FUNCTIONS = {"folio_notes": _Notes, "folio_markdown": _Markdown, "folio_index": _Index}


def register(spark: SparkSession) -> None:
    """Makes the functions known to SQL under their names."""
    for name, f in FUNCTIONS.items():
        spark.udtf.register(name, udtf(f))
