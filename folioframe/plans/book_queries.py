"""Whole operators of a book, bound to books that Spark derives from the tables.

A document's lines are the lines of its pages, thirty to a page, set by their numbers: every fifth one is indented, three
of five are italic, and each second page has a rule above its foot. An order is a rendered leaf, its lines are paragraphs
with footnotes; parts are the records of a printed index.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folioframe.functions import text as t
from folioframe.operators import extract, footnotes, layout, markdown, table_functions
from folioframe.plans.structure_queries import DAY_SQL, _day
from folioframe.plans.tables import LINES_SQL, events, lines, table
from folioframe.streaming import open_notes

QUERIES: dict = {}
ORACLES: dict = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


def _pages(spark, sf_dir):
    """(spans, drawings) of the documents as pages."""
    rows = lines(spark, sf_dir, by_document=True).withColumns({"page": F.expr("line_no div 30 + 1").cast("int"), "place": (F.col("line_no") % 30).cast("int")})
    x, y = F.when(F.col("line_no") % 5 == 0, 140.0).otherwise(88.0), (40 + F.col("place") * 25).cast("double")
    font = F.when(F.col("line_no") % 5 < 3, "Times-Italic").otherwise("Times-Roman")
    spans = rows.select(
        "doc_id", "page", F.col("place").alias("block_idx"), F.lit(0).alias("block_type"), x.alias("block_x0"), y.alias("block_y0"), F.lit(0).alias("line_idx"),
        x.alias("line_x0"), y.alias("line_y0"), (x + 300).alias("line_x1"), F.lit(0).alias("span_idx"), F.col("line").alias("text"), F.lit(13.7).alias("size"), font.alias("font"),
    )
    ruled = rows.where("page % 2 = 0 and place = 0")
    drawings = ruled.select("doc_id", "page", F.lit(0).alias("draw_idx"), F.lit(88.0).alias("x0"), F.lit(700.0).alias("y0"), F.lit(160.0).alias("width"), F.lit(0.5).alias("height"))
    return spans, drawings


PAGES_SQL = rf"""{LINES_SQL},
placed AS (SELECT doc_id, line_no // 30 + 1 AS page, line_no % 30 AS place, line_no % 5 AS k, line, {t.clean_spaces_sql(t.normalize_encoding_sql("line"))} AS text, {t.strip_sql("line")} AS bare FROM lines),
banded AS (
  SELECT *, CASE WHEN place = 0 THEN 'header' WHEN place = 29 THEN 'margin' WHEN page % 2 = 0 AND place >= 27 THEN 'footer'
                 WHEN page % 2 = 1 AND place >= 26 AND regexp_matches(line, {t.quote(layout.NOTE_START)}) THEN 'footer' ELSE 'body' END AS band,
         k < 3 AND regexp_matches(line, '\p{{L}}') AND bare <> '' AND NOT regexp_matches(bare, '^\s*\p{{Nd}}') AND NOT (starts_with(bare, '(') AND ends_with(bare, ')')) AND NOT {t.is_all_caps_sql("bare")} AS candidate
  FROM placed),
marked AS (
  SELECT *, candidate AND (k = 0 OR coalesce(lag(candidate AND k > 0) OVER w, false) OR coalesce(lead(candidate AND k > 0) OVER w, false)) AS is_verse
  FROM banded WINDOW w AS (PARTITION BY doc_id, page ORDER BY place))"""


@query(
    "layout_lines",
    f"WITH {PAGES_SQL} SELECT doc_id, CAST(page AS INTEGER) AS page, CAST(place + 1 AS INTEGER) AS ord, band, is_verse, md5(text) AS digest FROM marked",
)
def layout_lines(spark, sf_dir):
    """Lines from spans: reading order, band, repaired text, and whether they are verse."""
    rows = layout.mark_verse(layout.lines(*_pages(spark, sf_dir)))
    return rows.select("doc_id", "page", "ord", "band", "is_verse", F.md5(F.col("text").cast("binary")).alias("digest"))


@query(
    "poem_runs",
    rf"""WITH {PAGES_SQL},
    kept AS (SELECT *, lag(band) OVER w AS band0, lag(is_verse) OVER w AS verse0 FROM marked WHERE bare <> '' WINDOW w AS (PARTITION BY doc_id, page ORDER BY place)),
    runs AS (SELECT *, sum(CASE WHEN band = band0 AND is_verse = verse0 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id, page ORDER BY place) AS run FROM kept)
    SELECT doc_id, CAST(page AS INTEGER) AS page, band, min(place) AS place, md5(arg_min(text, place)) AS first_line, count(*) AS n FROM runs WHERE is_verse GROUP BY doc_id, page, band, run""",
)
def poem_runs(spark, sf_dir):
    """Runs of verse lines within a band of a page; blank lines do not part them."""
    rows = layout.mark_verse(layout.lines(*_pages(spark, sf_dir)))
    kept = rows.withColumn("text", F.struct(F.col("ord").alias("ord"), F.col("text").alias("text")))
    runs = layout.poem_runs(kept)
    return runs.select("doc_id", "page", "band", (F.col("first.ord") - 1).cast("long").alias("place"), F.md5(F.col("first.text").cast("binary")).alias("first_line"), "n")


@query("page_foot_notes", None)
def page_foot_notes(spark, sf_dir):
    """The notes of each page's foot by the table function of SQL."""
    table_functions.register(spark)
    feet = layout.lines(*_pages(spark, sf_dir)).where("band = 'footer'").select("doc_id", "page", "ord", "raw")
    return spark.sql("SELECT * FROM folio_notes(TABLE({feet}) PARTITION BY (doc_id, page) ORDER BY ord)", feet=feet)


def _leaves(spark, sf_dir):
    """(path, text): an order as a rendered leaf. A line has a note unless its page divides by 3; a page that divides by
    5 has a second note that nothing refers to."""
    one = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("p"))
    l = one.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct(F.col("l_linenumber").alias("n"), "p"))).alias("l"))
    paragraphs = F.transform("l", lambda x: F.format_string("Kiện %s[^%s] lên tàu.\n\n> Sóng %s,", x.p.cast("string"), x.n.cast("string"), x.n.cast("string")))
    note = lambda n, x: F.format_string("[^%s]: (Trang %s-%s) Ghi %s.\n\n    > Câu %s", n.cast("string"), x.p.cast("string"), (x.p + 1).cast("string"), x.p.cast("string"), x.n.cast("string"))
    notes = F.flatten(F.transform("l", lambda x: F.concat(F.when(x.p % 3 != 0, F.array(note(x.n, x))).otherwise(F.array().cast("array<string>")), F.when(x.p % 5 == 0, F.array(note(x.n + 90, x))).otherwise(F.array().cast("array<string>")))))
    o = table(spark, sf_dir, "orders").join(l, F.col("o_orderkey") == F.col("l_orderkey"))
    head = F.format_string("# I. %s\n\n## %s. CHUYẾN %s", "o_orderpriority", F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"))
    text = F.array_join(F.concat(F.array(head), paragraphs, F.when(F.size(notes) > 0, F.concat(F.array(F.lit("---"), F.lit("### Chú thích")), notes)).otherwise(notes)), "\n\n")
    return o.select(F.col("o_orderkey").alias("path"), text.alias("text"))


LEAVES_SQL = """one AS (SELECT l_orderkey AS path, l_linenumber AS n, min(l_partkey) AS p FROM lineitem GROUP BY 1, 2),
notes AS (SELECT path, n AS num, n, p FROM one WHERE p % 3 <> 0 UNION ALL SELECT path, n + 90, n, p FROM one WHERE p % 5 = 0),
body AS (SELECT path, string_agg('Kiện ' || p || '[^' || n || '] lên tàu.' || chr(10) || 'Sóng ' || n || ',', chr(10) ORDER BY n) AS body FROM one GROUP BY path),
listed AS (SELECT path, count(*) AS n_notes, string_agg(num || '@' || p || '-' || (p + 1) || ':' || 'Ghi ' || p || '.' || chr(10) || 'Câu ' || n, '|' ORDER BY n, num) AS notes FROM notes GROUP BY path)"""


@query(
    "markdown_leaves",
    f"""WITH {LEAVES_SQL} SELECT o.o_orderkey AS path, 'CHUYẾN ' || o.o_custkey AS title, 'I. ' || o.o_orderpriority AS category, b.body, coalesce(l.n_notes, 0) AS n_notes, coalesce(l.notes, '') AS notes
    FROM orders o JOIN body b ON b.path = o.o_orderkey LEFT JOIN listed l ON l.path = o.o_orderkey""",
)
def markdown_leaves(spark, sf_dir):
    """Rendered leaves read back: title, category, body, and notes with the lines that go on with them."""
    notes = F.transform("notes", lambda n: F.concat(n.num.cast("string"), F.lit("@"), n.page.cast("string"), F.lit("-"), n.end_page.cast("string"), F.lit(":"), n.text))
    return markdown.parse(_leaves(spark, sf_dir)).select("path", "title", "category", "body", F.size("notes").cast("long").alias("n_notes"), F.array_join(notes, "|").alias("notes"))


@query(
    "markdown_parts",
    f"""WITH {LEAVES_SQL} SELECT path, 'body' AS kind, 2 * count(*) AS n, NULL AS pages FROM one GROUP BY path
    UNION ALL SELECT path, 'note', count(*), sum(p) FROM notes GROUP BY path
    UNION ALL SELECT o_orderkey, k, 1, NULL FROM orders, (VALUES ('title'), ('category')) v(k) WHERE o_orderkey IN (SELECT path FROM one)""",
)
def markdown_parts(spark, sf_dir):
    """The parts of rendered leaves by the table function of SQL, counted."""
    table_functions.register(spark)
    rows = _leaves(spark, sf_dir).select("path", F.posexplode(F.split("text", "\n")).alias("n", "line"))
    parts = "SELECT path, kind, count(*) AS n, CAST(sum(page) AS BIGINT) AS pages FROM folio_markdown(TABLE({rows}) PARTITION BY path ORDER BY n) GROUP BY path, kind"
    return spark.sql(parts, rows=rows)


@query(
    "leaf_structure",
    f"""WITH {LEAVES_SQL}, ordered AS (SELECT path, p, lag(p) OVER (PARTITION BY path ORDER BY n, num) AS before FROM notes)
    SELECT path, 'ORPHAN_MARKER:' || n AS flag FROM one WHERE p % 3 = 0
    UNION ALL SELECT path, 'ORPHAN_DEFINITION:' || num FROM notes WHERE num > 90
    UNION ALL SELECT DISTINCT path, 'FOOTNOTE_ORDER' FROM ordered WHERE p < before""",
)
def leaf_structure(spark, sf_dir):
    """What is wrong with the structure of rendered leaves."""
    return markdown.structure_flags(markdown.parse(_leaves(spark, sf_dir)))


@query(
    "index_records",
    """SELECT p_size AS doc_id, CAST(row_number() OVER (PARTITION BY p_size ORDER BY p_partkey) - 1 AS INTEGER) AS ord, 'Bản ' || p_name AS printed,
    CASE WHEN p_partkey % 2 = 0 THEN 'truyện ' || p_brand END AS qualifier, CAST(p_partkey AS INTEGER) AS story, CASE WHEN p_partkey % 3 = 0 THEN 'khao-di' ELSE 'story' END AS location FROM part""",
)
def index_records(spark, sf_dir):
    """The records of printed indexes by the table function of SQL: names over two lines, qualifiers, places, numbers."""
    table_functions.register(spark)
    name = F.concat(F.lit("Bản\n"), F.col("p_name"), F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("\ntruyện "), "p_brand")).otherwise(F.lit("")))
    page = F.concat(F.lit("77\n"), name, F.when(F.col("p_partkey") % 3 == 0, F.lit("\nKhảo dị")).otherwise(F.lit("")), F.lit("\nsố\n["), F.col("p_partkey").cast("string"), F.lit("]\ntập\nII"))
    pages = table(spark, sf_dir, "part").select(F.col("p_size").alias("doc_id"), F.col("p_partkey").alias("page"), page.alias("text"))
    found = spark.sql("SELECT * FROM folio_index(TABLE({pages}) PARTITION BY doc_id ORDER BY page)", pages=pages)
    return found.select("doc_id", "ord", "printed", "qualifier", F.get("targets", F.lit(0))["story"].alias("story"), F.get("targets", F.lit(0))["location"].alias("location"))


@query(
    "leaf_paths",
    rf"""WITH named AS (
      SELECT p_partkey, p_size, 'document_' || p_size || '/part_2/II_' || {t.slug_sql("p_type")} || '/' || CASE WHEN p_partkey % 2 = 0 THEN lpad(CAST(p_partkey % 7 AS VARCHAR), 3, '0') || '_' ELSE '' END || {t.slug_sql("p_name")} AS name FROM part)
    SELECT p_partkey, name || CASE WHEN r > 1 THEN '_' || r ELSE '' END || '.md' AS path FROM (SELECT *, row_number() OVER (PARTITION BY p_size, name ORDER BY p_partkey) AS r FROM named) x""",
)
def leaf_paths(spark, sf_dir):
    """Where a leaf lies in the tree of files; leaves of one name are told apart."""
    number = F.when(F.col("p_partkey") % 2 == 0, (F.col("p_partkey") % 7).cast("int"))
    p = table(spark, sf_dir, "part").select(
        "p_partkey", F.col("p_size").alias("doc_id"), F.lit(2).alias("part"), F.lit(2).alias("section"), F.lit("II").alias("roman"), F.concat(F.lit("II. "), "p_type").alias("category"), number.alias("number"), F.col("p_name").alias("title"), F.col("p_partkey").alias("leaf")
    )
    return p.select("p_partkey", extract.leaf_path().alias("path"))


NOTES_SQL = f"""notes AS (
  SELECT user_id AS doc_id, {DAY_SQL} AS page, event_id, row_number() OVER (PARTITION BY user_id, {DAY_SQL} ORDER BY event_id) - 1 AS pos, event_id % 9 + 1 AS num, event_type FROM events),
marked AS (SELECT *, pos = 0 AND event_type <> 'click' AS continued FROM notes)"""


def _notes(spark, sf_dir):
    """Page notes: a user's events of a day, in order; the first one goes on from the day before unless it is a click."""
    e = events(spark, sf_dir).withColumn("page", _day())
    pos = F.row_number().over(Window.partitionBy("user_id", "page").orderBy("event_id")) - 1
    n = e.select(F.col("user_id").alias("doc_id"), "page", pos.alias("pos"), (F.col("event_id") % 9 + 1).cast("int").alias("num"), F.col("event_id").cast("string").alias("text"), "event_type")
    return n.select("doc_id", "page", "pos", "num", "text", ((F.col("pos") == 0) & (F.col("event_type") != "click")).alias("continued"))


@query(
    "open_at_foot",
    f"""WITH {NOTES_SQL}, pages AS (SELECT doc_id, page, arg_max(num, pos) FILTER (WHERE NOT continued) AS last FROM marked GROUP BY doc_id, page),
    runs AS (SELECT *, sum(CASE WHEN page - before <= 1 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY page) AS run FROM (SELECT *, lag(page) OVER (PARTITION BY doc_id ORDER BY page) AS before FROM pages) x)
    SELECT doc_id, page, last_value(last IGNORE NULLS) OVER (PARTITION BY doc_id, run ORDER BY page ROWS BETWEEN 10 PRECEDING AND CURRENT ROW) AS open FROM runs""",
)
def open_at_foot(spark, sf_dir):
    """The number of the note open at the foot of each page, looked for on ten pages before."""
    return footnotes.open_at_foot(_notes(spark, sf_dir))


@query(
    "notes_numbered",
    f"""WITH {NOTES_SQL}, broken AS (SELECT *, coalesce(page - lag(page) OVER (PARTITION BY doc_id ORDER BY page, pos) > 1, true) AS broken FROM marked),
    parts AS (SELECT *, sum(CASE WHEN broken THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY page, pos) AS part FROM broken)
    SELECT doc_id, page, CAST(pos AS INTEGER) AS pos, last_value(CASE WHEN broken OR NOT continued THEN num END IGNORE NULLS) OVER (PARTITION BY doc_id, part ORDER BY page, pos) AS num, CAST(event_id AS VARCHAR) AS text,
           continued AND NOT broken AS runs_on FROM parts""",
)
def notes_numbered(spark, sf_dir):
    """The number of the note that each entry of a page belongs to, and whether it runs on from the page before."""
    return open_notes.numbered(_notes(spark, sf_dir))


@query(
    "notes_merged",
    f"""WITH {NOTES_SQL}, broken AS (SELECT *, coalesce(page - lag(page) OVER (PARTITION BY doc_id ORDER BY page, pos) > 1, true) AS broken FROM marked),
    parts AS (SELECT *, sum(CASE WHEN broken THEN 1 ELSE 0 END) OVER w AS part, sum(CASE WHEN continued AND NOT broken THEN 0 ELSE 1 END) OVER w AS note FROM broken WINDOW w AS (PARTITION BY doc_id ORDER BY page, pos)),
    filled AS (SELECT *, last_value(CASE WHEN broken OR NOT continued THEN num END IGNORE NULLS) OVER (PARTITION BY doc_id, part ORDER BY page, pos) AS own FROM parts)
    SELECT doc_id, arg_min(own, page * 100000 + pos) AS num, min(page) AS page, max(page) AS end_page, string_agg(CAST(event_id AS VARCHAR), ' ' ORDER BY page, pos) AS text FROM filled GROUP BY doc_id, note""",
)
def notes_merged(spark, sf_dir):
    """Whole notes, each with the pages it runs over."""
    return footnotes.merge_notes(_notes(spark, sf_dir)).select("doc_id", "num", "page", "end_page", "text")
