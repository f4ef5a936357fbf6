"""Text repair and classification as Column functions, each beside its spelling in DuckDB SQL.

Regular expressions avoid ``\\w`` and look-around, whose meaning differs between engines: a word character is
``[\\p{L}\\p{N}_]``. Every function maps null to null.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

# Artefacts of a legacy text layer and what they stand for, applied in this order.
LEGACY_CHARACTERS = [
    ("ñ", "đ"),
    ("Ñ", "Đ"),
    ("Ð", "Đ"),
    ("''", '"'),
    ("``", '"'),
    ("’’", '"'),
    ("‘‘", '"'),
    ("«", '"'),
    ("»", '"'),
    ("\xa0", " "),
    ("\xad", ""),
    ("\u200b", ""),
]

# Patterns of typography.
W = r"[\p{L}\p{N}_]"
UPPER_RANGE = "A-ZÀ-Ỵ"
SPACING = [
    (r"[ \t]+", " "),
    (r" +([,.;:!?])", "$1"),
    (r"“\s+", "“"),
    (r"\s+”", "”"),
    (rf"({W}+)-\s+({W}+)", "$1-$2"),
]
SENTENCE_END = r"[.!?:;…][\"”']?(\[\^[0-9]+\])?$"
SUPERSCRIPT_RUN = r"^(\s*)([0-9]+)([.,;:!?)\"”’]*\s*)$"
DIALOGUE_START = r"([:.]\s*)-\s*"
DIALOGUE_END = rf"([\"”'][.!?]?|[.!?][\"”'])\s+([{UPPER_RANGE}])"
SCENE_DIVIDER = r"^[*\s-]+$"
CONTINUED = r"(?iu)^\(\s*tiếp\s+theo\s*\)\.?$"
TOC_ENTRY_END = r"^(.*?)[\s…]*\.+\s*([0-9]+)\s*$"
ROMAN_HEADER = r"^([IVXLCDM]+)\s*[.-]?\s*(.+)$"
STORY_TITLE = r"^\[?([0-9]+)\]?\.\s+(.+)$"
MARKER = r"\[\^([0-9]+)\]"


@dataclass(frozen=True)
class Step:
    """One regular-expression replacement in both dialects."""

    pattern: str
    replacement: str

    def column(self, c: Column) -> Column:
        return F.regexp_replace(c, self.pattern, self.replacement)

    def sql(self, x: str) -> str:
        return f"regexp_replace({x}, {quote(self.pattern)}, {quote(self.replacement.replace('$', chr(92)))}, 'g')"


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def strip_sql(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def normalize_encoding(c: Column) -> Column:
    for old, new in LEGACY_CHARACTERS:
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def repaired(s: str) -> str:
    """``normalize_encoding`` for one string, where a Python pass needs it."""
    for old, new in LEGACY_CHARACTERS:
        s = s.replace(old, new)
    return s


def normalize_encoding_sql(x: str) -> str:
    for old, new in LEGACY_CHARACTERS:
        x = f"replace({x}, {quote(old)}, {quote(new)})"
    return x


def clean_spaces(c: Column) -> Column:
    """Repaired encoding, single spaces, no space before punctuation, joined words, a dash apart from what follows."""
    c = normalize_encoding(c)
    for pattern, replacement in SPACING:
        c = Step(pattern, replacement).column(c)
    c = Step(r"^-\s*(\S)", "- $1").column(c)
    return strip(c)


def clean_spaces_sql(x: str) -> str:
    x = normalize_encoding_sql(x)
    for pattern, replacement in SPACING:
        x = Step(pattern, replacement).sql(x)
    return strip_sql(Step(r"^-\s*(\S)", "- $1").sql(x))


def ends_sentence(c: Column) -> Column:
    return strip(c).rlike(SENTENCE_END)


def ends_sentence_sql(x: str) -> str:
    return f"regexp_matches({strip_sql(x)}, {quote(SENTENCE_END)})"


def is_all_caps(c: Column) -> Column:
    """At least one letter, and no letter that is not upper case."""
    return c.rlike(r"\p{L}") & ~c.rlike(r"[\p{Ll}\p{Lt}\p{Lm}\p{Lo}]")


def is_all_caps_sql(x: str) -> str:
    return rf"(regexp_matches({x}, '\p{{L}}') AND NOT regexp_matches({x}, '[\p{{Ll}}\p{{Lt}}\p{{Lm}}\p{{Lo}}]'))"


def caps_ratio(c: Column) -> Column:
    """Share of upper-case letters among the letters; null without letters."""
    letters = F.length(F.regexp_replace(c, r"[^\p{L}]", ""))
    return F.try_divide(F.length(F.regexp_replace(c, r"[^\p{Lu}]", "")).cast("double"), letters.cast("double"))


def caps_ratio_sql(x: str) -> str:
    upper, letters = (rf"length(regexp_replace({x}, '[^\p{{{k}}}]', '', 'g'))" for k in ("Lu", "L"))
    return f"(CAST({upper} AS DOUBLE) / nullif({letters}, 0))"


def superscript_marker(c: Column) -> Column:
    """``[^N]`` for a run of digits with punctuation; null for anything else."""
    return F.when(c.rlike(SUPERSCRIPT_RUN), F.regexp_replace(c, SUPERSCRIPT_RUN, "$1[^$2]$3"))


def superscript_marker_sql(x: str) -> str:
    return f"CASE WHEN regexp_matches({x}, {quote(SUPERSCRIPT_RUN)}) THEN {Step(SUPERSCRIPT_RUN, '$1[^$2]$3').sql(x)} END"


def is_scene_divider(c: Column) -> Column:
    return c.rlike(SCENE_DIVIDER)


def is_continuation_marker(c: Column) -> Column:
    return strip(c).rlike(CONTINUED)


def split_dialogues(c: Column) -> Column:
    """An array of paragraphs, each turn of a dialogue and the narrative after it on its own."""
    text = Step(DIALOGUE_START, "$1\n- ").column(clean_spaces(c))
    lines = F.transform(F.split(text, "\n"), clean_spaces)
    turns = F.transform(lines, lambda l: F.when(F.startswith(l, F.lit("-")), F.split(Step(DIALOGUE_END, "$1\n$2").column(l), "\n")).otherwise(F.array(l)))
    return F.filter(F.transform(F.flatten(turns), clean_spaces), lambda l: l != "")


def split_dialogues_sql(x: str) -> str:
    """The same as a DuckDB list expression."""
    text = Step(DIALOGUE_START, "$1\n- ").sql(clean_spaces_sql(x))
    turn = f"CASE WHEN starts_with(l, '-') THEN string_split({Step(DIALOGUE_END, '$1' + chr(10) + '$2').sql('l')}, chr(10)) ELSE [l] END"
    lines = f"list_transform(string_split({text}, chr(10)), lambda p: {clean_spaces_sql('p')})"
    return f"list_filter(list_transform(flatten(list_transform({lines}, lambda l: {turn})), lambda m: {clean_spaces_sql('m')}), lambda r: r <> '')"


def clean_category_title(c: Column) -> Column:
    """struct(roman, title) of a Roman category heading in capitals, else null."""
    t = strip(c)
    title = F.regexp_replace(strip(F.regexp_replace(strip(F.regexp_extract(t, ROMAN_HEADER, 2)), r"^-\s*", "")), r"[0-9]+\s*$", "")
    roman = F.regexp_extract(t, ROMAN_HEADER, 1)
    return F.when(t.rlike(ROMAN_HEADER) & is_all_caps(strip(title)), F.struct(roman.alias("roman"), F.concat(roman, F.lit(". "), strip(title)).alias("title")))


def clean_story_title(c: Column) -> Column:
    """struct(number, title) of a numbered heading in capitals without footnote digits, else null."""
    t = strip(c)
    title = strip(F.regexp_replace(strip(F.regexp_extract(t, STORY_TITLE, 2)), r"[0-9]+\s*$", ""))
    title = F.regexp_replace(title, rf"([{UPPER_RANGE}])[0-9]+(\s+)", "$1$2")
    return F.when(t.rlike(STORY_TITLE) & is_all_caps(title), F.struct(F.regexp_extract(t, STORY_TITLE, 1).cast("int").alias("number"), title.alias("title")))


@pandas_udf(StringType())
def nfc(s: pd.Series) -> pd.Series:
    """Canonical composition, for comparisons only."""
    return s.map(lambda t: None if t is None else unicodedata.normalize("NFC", t))


def _fold(t: str | None) -> str | None:
    if t is None:
        return None
    t = t.lower().replace("đ", "d")
    return "".join(x for x in unicodedata.normalize("NFD", t) if not unicodedata.combining(x))


@pandas_udf(StringType())
def folded(s: pd.Series) -> pd.Series:
    """Lower case without diacritics, for matching names."""
    return s.map(_fold)


@pandas_udf(StringType())
def ascii_letters(s: pd.Series) -> pd.Series:
    """Compatibility decomposition with all that is not ASCII dropped."""
    return s.map(lambda t: None if t is None else unicodedata.normalize("NFKD", t.replace("Đ", "D").replace("đ", "d")).encode("ascii", "ignore").decode())


def fixed_point(digits: int):
    """A function of a column of numbers: their decimal spelling, rounded from the exact binary value. The JVM's own
    formatting rounds the shortest decimal spelling, which is not the same."""

    @pandas_udf(StringType())
    def spelled(s: pd.Series) -> pd.Series:
        return s.map(lambda v: f"{v:.{digits}f}", na_action="ignore").astype(object).where(s.notna(), None)

    return spelled


def slug(c: Column) -> Column:
    """A file name: ASCII letters and digits with underscores between."""
    return F.regexp_replace(F.regexp_replace(ascii_letters(c), r"[^A-Za-z0-9]+", "_"), r"^_+|_+$", "")


def slug_sql(x: str) -> str:
    ascii_only = rf"regexp_replace(strip_accents(replace(replace({x}, 'Đ', 'D'), 'đ', 'd')), '[^\x00-\x7F]', '', 'g')"
    return rf"regexp_replace(regexp_replace({ascii_only}, '[^A-Za-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g')"


def heading_with_markers(title: str, printed: str) -> str:
    """``title`` with the footnote markers of the heading as printed, each after the letter it follows there.

    Letters are counted from the end, since the printed heading has a number in front. Where the two disagree on the
    letters after a marker the title stays as it is.
    """
    import re

    letters = [k for k, c in enumerate(title) if not c.isspace()]
    bare = lambda s: re.sub(r"\s", "", re.sub(MARKER, "", s))
    places: list[tuple[int, str]] = []
    for m in re.finditer(MARKER, printed):
        after = bare(printed[m.end() :])
        if len(after) >= len(letters) or not "".join(title[k] for k in letters).endswith(after):
            return title
        places.append((letters[len(letters) - len(after) - 1] + 1, m[0]))
    for at, marker in reversed(places):
        title = title[:at] + marker + title[at:]
    return title
