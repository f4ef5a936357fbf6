"""Footnotes: the notes of each page's foot, and notes that run on over pages.

A page's foot is one text. A number opens a note only if it is the next one expected, so the split is a fold over the
candidate numbers: ``F.aggregate`` carries the expected number and the accepted starts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioframe.functions import text as t
from folioframe.operators import sequence as seq

# Fixed value: a number at the start or after a space, and what may follow it.
CANDIDATE = rf"(?:^|(?<=\s))([0-9]+)(?:[.\s]+(?=[{t.UPPER_RANGE}\"'“‘(\[0-9])|(?=[{t.UPPER_RANGE}]))"

LOOK_BACK = 10


def split_notes(text: Column) -> Column:
    """array<struct<num, text, continued>> of a page's foot; what stands before the first number is continued."""
    # One-element arrays bind what is used often to a name, so that the patterns run once.
    clean = F.regexp_replace(t.clean_spaces(text), r"^11\.\s*", "1. ")
    parts = lambda c: F.struct(c.alias("clean"), F.split(c, CANDIDATE, -1).alias("between"), F.regexp_extract_all(c, F.lit(CANDIDATE), F.lit(0)).alias("hits"))
    return F.get(F.transform(F.transform(F.array(clean), parts), lambda p: _notes(p["clean"], p["between"], p["hits"])), F.lit(0))


def _notes(clean: Column, between: Column, hits: Column) -> Column:
    digits = F.transform(hits, lambda h: F.regexp_extract(h, r"([0-9]+)", 1))
    opened = lambda s: F.length(F.regexp_replace(s, r"[^(]", "")) - F.length(F.regexp_replace(s, r"[^)]", ""))

    def step(acc: Column, i: Column) -> Column:
        """Accept candidate i if it is the number expected and not inside a parenthesis that closes after it."""
        d, rest = F.get(digits, i), F.array_join(F.flatten(F.zip_with(F.slice(between, i + 2, F.size(between)), F.slice(hits, i + 2, F.size(hits)), lambda a, b: F.array(F.coalesce(a, F.lit("")), F.coalesce(b, F.lit(""))))), "")
        head = F.concat(acc["seen"], F.get(between, i))
        inside = (opened(head) > 0) & (opened(rest) < 0)
        wanted = acc["next"].cast("string")
        ok = ~inside & ((d.try_cast("int") == acc["next"]) | (d == F.concat(wanted, wanted)))
        return F.struct(
            F.when(ok, acc["next"] + 1).otherwise(acc["next"]).alias("next"),
            F.concat(head, F.get(hits, i)).alias("seen"),
            F.when(ok, F.concat(acc["notes"], F.array(F.struct(acc["next"].alias("num"), F.get(between, i + 1).alias("text"), F.lit(False).alias("continued")))))
            .otherwise(_extend(acc["notes"], F.concat(F.get(hits, i), F.get(between, i + 1))))
            .alias("notes"),
        )

    head = F.array(F.struct(F.lit(1).alias("num"), F.get(between, F.lit(0)).alias("text"), F.lit(True).alias("continued")))
    start = F.struct(F.lit(1).alias("next"), F.lit("").alias("seen"), head.alias("notes"))
    ids = F.when(F.size(hits) > 0, F.sequence(F.lit(0), F.size(hits) - 1)).otherwise(F.expr("cast(array() as array<int>)"))
    folded = F.aggregate(ids, start, step, lambda a: a["notes"])
    tidy = F.transform(
        folded,
        lambda n: F.struct(n["num"].alias("num"), F.when(n["continued"], t.clean_spaces(n["text"])).otherwise(F.regexp_replace(t.clean_spaces(n["text"]), r"^[.\s-]+", "")).alias("text"), n["continued"].alias("continued")),
    )
    lone = rf"^([0-9]+)(?:[.\s]+|(?=[{t.UPPER_RANGE}]))"
    fallback = F.array(F.struct(F.regexp_extract(clean, lone, 1).try_cast("int").alias("num"), t.clean_spaces(F.regexp_replace(clean, lone, "")).alias("text"), F.lit(False).alias("continued")))
    none = F.size(F.filter(tidy, lambda n: ~n["continued"])) == 0
    found = F.filter(tidy, lambda n: ~n["continued"] | (n["text"] != ""))
    return F.when(clean == "", F.expr("cast(array() as array<struct<num:int,text:string,continued:boolean>>)")).when(none & clean.rlike(lone), fallback).otherwise(found)


def _extend(notes: Column, more: Column) -> Column:
    """The last note of the list with ``more`` at its end."""
    last = F.element_at(notes, -1)
    return F.concat(F.slice(notes, F.lit(1), F.size(notes) - 1), F.array(F.struct(last["num"].alias("num"), F.concat(last["text"], more).alias("text"), last["continued"].alias("continued"))))


PART = "struct<kind:string,text:string,lines:array<string>>"


def _no_parts() -> Column:
    return F.expr(f"cast(array() as array<{PART}>)")


def _prose(text: Column) -> Column:
    return F.struct(F.lit("text").alias("kind"), text.alias("text"), F.lit(None).cast("array<string>").alias("lines"))


def _verse(lines: Column) -> Column:
    return F.struct(F.lit("verse").alias("kind"), F.lit(None).cast("string").alias("text"), lines.alias("lines"))


def _with(parts: Column, part: Column) -> Column:
    """``parts`` and one more, which goes on with the last one if both are verse or both prose."""
    last = F.get(parts, F.size(parts) - 1)
    before = F.slice(parts, F.lit(1), F.greatest(F.size(parts) - 1, F.lit(0)))
    grown = F.when(part["kind"] == "verse", _verse(F.concat(last["lines"], part["lines"]))).otherwise(_prose(t.strip(F.concat_ws(" ", last["text"], part["text"]))))
    return F.when(F.coalesce(last["kind"] == part["kind"], F.lit(False)), F.concat(before, F.array(grown))).otherwise(F.concat(parts, F.array(part)))


def verse_places(texts: Column, verses: Column) -> Column:
    """array<struct<note, at, size>>: where the lines of verse stand in the notes of a page. Lines and notes go by in
    order: a line is sought behind the one before, then in the notes after; the first that is nowhere ends the search."""

    def step(acc: Column, line: Column) -> Column:
        ids = F.sequence(acc["note"], F.size(texts) - 1)
        found = F.get(F.filter(F.transform(ids, lambda j: F.struct(j.alias("note"), F.position(line, F.get(texts, j), F.when(j == acc["note"], acc["from"]).otherwise(1)).alias("at"))), lambda x: x["at"] > 0), F.lit(0))
        ok = ~acc["done"] & (line != "") & found.isNotNull()
        size = F.length(line)
        return F.struct(
            F.when(ok, found["note"]).otherwise(acc["note"]).alias("note"),
            F.when(ok, found["at"] + size).otherwise(acc["from"]).alias("from"),
            (~ok).alias("done"),
            F.when(ok, F.concat(acc["places"], F.array(F.struct(found["note"].alias("note"), found["at"].alias("at"), size.alias("size"))))).otherwise(acc["places"]).alias("places"),
        )

    start = F.struct(F.lit(0).alias("note"), F.lit(1).alias("from"), F.lit(False).alias("done"), F.expr("cast(array() as array<struct<note:int,at:int,size:int>>)").alias("places"))
    return F.when(F.size(texts) > 0, F.aggregate(verses, start, step, lambda a: a["places"])).otherwise(F.expr("cast(array() as array<struct<note:int,at:int,size:int>>)"))


def verse_parts(text: Column, places: Column) -> Column:
    """The parts of one note, prose and verse in turn, from the places of verse in it; none without verse."""

    def step(acc: Column, p: Column) -> Column:
        prose = t.strip(F.substr(text, acc["from"], p["at"] - acc["from"]))
        so_far = F.when(prose != "", F.concat(acc["parts"], F.array(_prose(prose)))).otherwise(acc["parts"])
        return F.struct((p["at"] + p["size"]).alias("from"), _with(so_far, _verse(F.array(F.substr(text, p["at"], p["size"])))).alias("parts"))

    def tail(acc: Column) -> Column:
        rest = t.strip(F.substr(text, acc["from"]))
        return F.when(rest != "", F.concat(acc["parts"], F.array(_prose(rest)))).otherwise(acc["parts"])

    start = F.struct(F.lit(1).alias("from"), _no_parts().alias("parts"))
    return F.when(F.size(places) > 0, F.aggregate(places, start, step, tail)).otherwise(_no_parts())


def page_notes(lines: DataFrame) -> DataFrame:
    """(doc_id, page, pos, num, text, continued, parts) of every page with a foot. ``parts`` keeps the verse of a note
    apart from its prose where lines are marked with ``is_verse``; it is empty for a note without verse."""
    verse = F.col("is_verse") if "is_verse" in lines.columns else F.lit(False)
    foot = lines.where("band = 'footer'").where(t.strip(F.col("raw")) != "")
    one = F.struct("ord", t.strip(F.col("raw")).alias("raw"), F.when(verse, t.clean_spaces(t.strip(F.col("raw")))).alias("verse"))
    joined = foot.groupBy("doc_id", "page").agg(F.array_sort(F.collect_list(one)).alias("l"))
    split = joined.select("doc_id", "page", F.array_compact(F.transform("l", lambda x: x.verse)).alias("verses"), split_notes(F.array_join(F.transform("l", lambda x: x.raw), " ")).alias("notes"))
    placed = split.withColumn("places", verse_places(F.transform("notes", lambda n: n.text), F.col("verses")))
    notes = placed.select("doc_id", "page", "places", F.posexplode("notes").alias("pos", "n"))
    own = F.filter("places", lambda p: p.note == F.col("pos"))
    return notes.select("doc_id", "page", "pos", "n.num", "n.text", "n.continued", verse_parts(F.col("n.text"), own).alias("parts"))


def open_at_foot(notes: DataFrame, back: int = LOOK_BACK) -> DataFrame:
    """(doc_id, page, open): the number of the note still open at the foot of each page with notes: its last numbered
    one, or that of the nearest page before, of at most ``back`` pages without a gap, that has one; else null."""
    pages = notes.groupBy("doc_id", "page").agg(F.max_by(F.when(~F.col("continued"), F.col("num")), F.when(~F.col("continued"), F.col("pos"))).alias("last"))
    runs = seq.gap_islands(pages, ["doc_id"], "page", 1, "run")
    near = seq.ordered(["doc_id", "run"], ["page"]).rowsBetween(-back, 0)
    return runs.select("doc_id", "page", F.last("last", ignorenulls=True).over(near).alias("open"))


def _joined_parts(pieces: Column) -> Column:
    """The parts of a note that runs over pages; those without verse are prose. None if there is no verse at all."""
    every = F.flatten(F.transform(pieces, lambda x: F.when(F.size(x["parts"]) > 0, x["parts"]).otherwise(F.array(_prose(x["text"])))))
    merged = F.aggregate(every, _no_parts(), _with)
    return F.when(F.exists(pieces, lambda x: F.size(x["parts"]) > 0), merged).otherwise(_no_parts())


def merge_notes(notes: DataFrame, leaves: DataFrame | None = None, back: int = LOOK_BACK) -> DataFrame:
    """(doc_id, num, page, end_page, text, continued, parts): the unnumbered head of a page goes on with the note open at
    the foot of the page before; after a page without notes nothing is open and the head is a note of its own, number 1.

    With ``leaves`` (doc_id, leaf, start_page, end_page) each leaf's pages are taken by themselves, and ``leaf`` is a
    column too: what goes on from before the leaf is a note of its own, ``continued``, under the number open there, which
    is looked for on up to ``back`` pages before that one (number 1 and not continued if there is none)."""
    keys, rows = ["doc_id"], notes.withColumn("__open", F.lit(None).cast("int"))
    if "parts" not in notes.columns:
        rows = rows.withColumn("parts", _no_parts())
    if leaves is not None:
        keys = ["doc_id", "leaf"]
        pages = leaves.select(*keys, "start_page", F.explode(F.sequence("start_page", "end_page")).alias("page"))
        before = open_at_foot(notes, back).select("doc_id", (F.col("page") + 1).alias("page"), F.col("open").alias("__before"))
        rows = rows.drop("__open").join(pages, ["doc_id", "page"]).join(before, ["doc_id", "page"], "left")
        rows = rows.withColumn("__open", F.when(F.col("page") == F.col("start_page"), F.col("__before"))).drop("__before", "start_page")
    order = ["page", "pos"]
    n = rows.withColumn("__prior", F.lag("page").over(seq.ordered(keys, order)))
    n = n.withColumn("__broken", F.coalesce((F.col("page") - F.col("__prior") > 1).cast("boolean"), F.lit(True)))
    n = seq.islands(n, keys, order, F.col("__broken"), "__part")
    own = F.when(F.col("continued") & F.col("__broken"), F.coalesce("__open", "num")).when(~F.col("continued"), F.col("num"))
    n = seq.forward_fill(n, [*keys, "__part"], order, own, "__num")
    runs_on = F.col("continued") & ~F.col("__broken")
    n = seq.islands(n, keys, order, ~runs_on, "__note")
    g = n.groupBy(*keys, "__note").agg(
        F.min_by("__num", F.struct(*order)).alias("num"),
        F.min("page").alias("page"),
        F.max("page").alias("end_page"),
        F.min_by(F.col("continued") & F.col("__broken") & F.col("__open").isNotNull(), F.struct(*order)).alias("continued"),
        F.array_sort(F.collect_list(F.struct("page", "pos", "text", "parts"))).alias("t"),
    )
    return g.select(*keys, "num", "page", "end_page", t.strip(F.array_join(F.transform("t", lambda x: x.text), " ")).alias("text"), "continued", _joined_parts(F.col("t")).alias("parts"))


def markers(lines: DataFrame) -> DataFrame:
    """(doc_id, page, num) of the markers in the body."""
    return lines.where("band = 'body'").select("doc_id", "page", F.explode(F.regexp_extract_all("text", F.lit(t.MARKER), F.lit(1))).alias("num")).select("doc_id", "page", F.col("num").cast("int").alias("num")).distinct()


def orphans(found: DataFrame, notes: DataFrame) -> DataFrame:
    """Markers without a note on their page, and notes without a marker on their first page."""
    a = found.join(notes.select("doc_id", "page", "num"), ["doc_id", "page", "num"], "left_anti").select("doc_id", "page", "num", F.lit("ORPHAN_MARKER").alias("flag"))
    b = notes.select("doc_id", "page", "num").join(found, ["doc_id", "page", "num"], "left_anti").select("doc_id", "page", "num", F.lit("ORPHAN_NOTE").alias("flag"))
    return a.unionByName(b)


