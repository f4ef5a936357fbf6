"""Layout bands, contents, ranges, footnotes and the survey, bound to tables of the same shape."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folioframe.operators import footnotes, toc
from folioframe.operators import sequence as seq
from folioframe.plans.tables import events, lines, table

QUERIES: dict = {}
ORACLES: dict = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


@query(
    "italic_ratio",
    """SELECT l_orderkey, round_even(sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) / nullif(sum(l_quantity), 0), 6) AS ratio,
    coalesce(sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) / nullif(sum(l_quantity), 0) >= 0.8, false) AS verse FROM lineitem WHERE l_quantity >= 10 GROUP BY l_orderkey""",
)
def italic_ratio(spark, sf_dir):
    """Share of a weight in one class, small parts ignored, as italic letters of a line."""
    ratio = F.try_divide(F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).otherwise(0.0)), F.sum("l_quantity"))
    g = table(spark, sf_dir, "lineitem").where("l_quantity >= 10").groupBy("l_orderkey").agg(ratio.alias("r"))
    return g.select("l_orderkey", F.bround("r", 6).alias("ratio"), F.coalesce(F.col("r") >= 0.8, F.lit(False)).alias("verse"))


@query(
    "band_classify",
    """SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_extendedprice AS y,
    CASE WHEN l.l_extendedprice < 5000 THEN 'header' WHEN l.l_extendedprice > 90000 THEN 'footer'
         WHEN o.o_totalprice IS NOT NULL AND l.l_extendedprice >= o.o_totalprice - 5 THEN 'footer'
         WHEN o.o_totalprice IS NULL AND l.l_extendedprice > 80000 THEN 'footer' ELSE 'body' END AS band
    FROM lineitem l LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus = 'F') o ON l.l_orderkey = o.o_orderkey""",
)
def band_classify(spark, sf_dir):
    """Header, body or footer by position, with a separator that may be missing."""
    o = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select("o_orderkey", F.col("o_totalprice").alias("separator"))
    j = table(spark, sf_dir, "lineitem").join(o, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    y, s = F.col("l_extendedprice"), F.col("separator")
    band = F.when(y < 5000, "header").when((y > 90000) | (y >= s - 5) | (s.isNull() & (y > 80000)), "footer").otherwise("body")
    return j.select("l_orderkey", "l_linenumber", "l_partkey", y.alias("y"), band.alias("band"))


@query(
    "first_separator",
    """SELECT l_orderkey, l_linenumber AS draw_idx, l_extendedprice AS y FROM (
      SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_extendedprice) AS n FROM lineitem WHERE l_quantity > 30 AND l_discount < 0.05) WHERE n = 1""",
)
def first_separator(spark, sf_dir):
    hit = table(spark, sf_dir, "lineitem").where("l_quantity > 30 and l_discount < 0.05")
    first = hit.groupBy("l_orderkey").agg(F.min(F.struct("l_linenumber", "l_partkey", "l_extendedprice")).alias("f"))
    return first.select("l_orderkey", F.col("f.l_linenumber").alias("draw_idx"), F.col("f.l_extendedprice").alias("y"))


@query(
    "text_fix_lookup",
    """WITH fixes(item_id, old, new) AS (VALUES (0, 'That', 'THAT'), (2, 'the', 'THE'), (5, 'and', 'AND'))
    SELECT b.item_id, CASE WHEN f.old IS NULL THEN b.text ELSE replace(b.text, f.old, f.new) END AS text, f.old IS NOT NULL AS fixed FROM benchmark b LEFT JOIN fixes f USING (item_id)""",
)
def text_fix_lookup(spark, sf_dir):
    fixes = spark.createDataFrame([(0, "That", "THAT"), (2, "the", "THE"), (5, "and", "AND")], "item_id long, old string, new string")
    j = table(spark, sf_dir, "benchmark").join(F.broadcast(fixes), "item_id", "left")  # a literal of three rows
    return j.select("item_id", F.when(F.col("old").isNull(), F.col("text")).otherwise(F.replace("text", "old", "new")).alias("text"), F.col("old").isNotNull().alias("fixed"))


TOC_LINES_SQL = """toc AS (
  SELECT n_regionkey AS doc, n_nationkey * 2 AS ord, 'Chapter ' || n_name AS line FROM nation
  UNION ALL SELECT n_regionkey, n_nationkey * 2 + 1, 'of its tales ......... ' || (10 + n_nationkey * 7) FROM nation)"""


def _toc_lines(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    a = n.select(F.col("n_regionkey").alias("doc"), (F.col("n_nationkey") * 2).alias("ord"), F.concat(F.lit("Chapter "), "n_name").alias("line"))
    b = n.select(F.col("n_regionkey").alias("doc"), (F.col("n_nationkey") * 2 + 1).alias("ord"), F.concat(F.lit("of its tales ......... "), (F.col("n_nationkey") * 7 + 10).cast("string")).alias("line"))
    return a.union(b)


def _toc_entries(spark, sf_dir):
    """Wrapped contents lines joined into entries that end with leaders and a page."""
    end = r"^(.*?)[\s…]*\.+\s*([0-9]+)\s*$"
    runs = seq.islands_after(_toc_lines(spark, sf_dir), ["doc"], ["ord"], F.col("line").rlike(end))
    whole = runs.groupBy("doc", "island").agg(F.array_sort(F.collect_list(F.struct("ord", "line"))).alias("l")).withColumn("text", F.array_join(F.transform("l", lambda x: x.line), " "))
    return whole.where(F.col("text").rlike(end)).select("doc", F.col("island").cast("long").alias("entry_no"), F.regexp_extract("text", end, 1).alias("title"), F.regexp_extract("text", end, 2).cast("int").alias("page"))


TOC_ENTRIES_SQL = rf"""{TOC_LINES_SQL},
runs AS (SELECT *, coalesce(sum(CAST(regexp_matches(line, '^(.*?)[\s…]*\.+\s*([0-9]+)\s*$') AS INT)) OVER (PARTITION BY doc ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS island FROM toc),
whole AS (SELECT doc, island, string_agg(line, ' ' ORDER BY ord) AS text FROM runs GROUP BY doc, island),
entries AS (SELECT doc, CAST(island AS BIGINT) AS entry_no, regexp_extract(text, '^(.*?)[\s…]*\.+\s*([0-9]+)\s*$', 1) AS title, CAST(regexp_extract(text, '^(.*?)[\s…]*\.+\s*([0-9]+)\s*$', 2) AS INTEGER) AS page
  FROM whole WHERE regexp_matches(text, '^(.*?)[\s…]*\.+\s*([0-9]+)\s*$'))"""


@query("toc_entries_join", f"WITH {TOC_ENTRIES_SQL} SELECT * FROM entries")
def toc_entries_join(spark, sf_dir):
    return _toc_entries(spark, sf_dir)


@query(
    "toc_parts",
    f"""WITH {TOC_ENTRIES_SQL}
    SELECT doc, entry_no, title, page AS start_page, CASE WHEN lead(page) OVER w IS NULL THEN 200 ELSE greatest(page, lead(page) OVER w - 1) END AS end_page FROM entries WINDOW w AS (PARTITION BY doc ORDER BY entry_no)""",
)
def toc_parts(spark, sf_dir):
    e = seq.next_bound(_toc_entries(spark, sf_dir), ["doc"], ["entry_no"], "page", F.lit(200), "end_page")
    return e.select("doc", "entry_no", "title", F.col("page").alias("start_page"), "end_page")


@query(
    "part_changes",
    """WITH o AS (SELECT o_custkey, o_orderkey, o_orderpriority, lag(o_orderpriority) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS prior FROM orders)
    SELECT o_custkey, o_orderkey, o_orderpriority FROM o WHERE prior IS NULL OR prior <> o_orderpriority""",
)
def part_changes(spark, sf_dir):
    """Repeated headings ignored: only rows that differ from the one before."""
    prior = F.lag("o_orderpriority").over(seq.ordered(["o_custkey"], ["o_orderdate", "o_orderkey"]))
    o = table(spark, sf_dir, "orders").withColumn("prior", prior)
    return o.where("prior is null or prior <> o_orderpriority").select("o_custkey", "o_orderkey", "o_orderpriority")


@query("select_sections", "SELECT n_nationkey, n_name FROM nation WHERE n_nationkey IN (1, 4, 5, 6, 9)")
def select_sections(spark, sf_dir):
    from folioframe.operators.select import select_by_spec

    return select_by_spec(table(spark, sf_dir, "nation"), "n_nationkey", "1,4-6,9,4").select("n_nationkey", "n_name")


@query(
    "active_category",
    """SELECT e.event_id, e.user_id, c.value AS category FROM (SELECT * FROM events WHERE event_type = 'purchase') e
    ASOF LEFT JOIN (SELECT user_id, ts, max_by(value, event_id) AS value FROM events WHERE event_type = 'signup' GROUP BY user_id, ts) c ON e.user_id = c.user_id AND e.ts >= c.ts""",
)
def active_category(spark, sf_dir):
    """The latest heading at or before each row."""
    e = events(spark, sf_dir)
    heads = e.where("event_type = 'signup'").groupBy("user_id", "ts").agg(F.max_by("value", "event_id").alias("value"))
    left = e.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    return seq.asof_backward(left, heads, ["user_id"], "ts", "value", "category").select("event_id", "user_id", "category")


@query(
    "forward_fill_category",
    """SELECT event_id, user_id, last_value(CASE WHEN event_type = 'signup' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS category FROM events""",
)
def forward_fill_category(spark, sf_dir):
    e = events(spark, sf_dir)
    return seq.forward_fill(e, ["user_id"], ["ts", "event_id"], F.when(F.col("event_type") == "signup", F.col("value")), "category").select("event_id", "user_id", "category")


DAY_SQL = "CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS INTEGER)"


def _day():
    return F.datediff(F.to_date("ts"), F.to_date(F.lit("2024-01-01")))


@query(
    "leaf_bounds",
    f"""WITH e AS (SELECT event_id, user_id, ts, {DAY_SQL} AS start FROM events)
    SELECT event_id, user_id, start, CASE WHEN lead(start) OVER w IS NULL THEN least(start + 4, 30) ELSE greatest(start, lead(start) OVER w - 1) END AS "end" FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
)
def leaf_bounds(spark, sf_dir):
    """Each leaf ends before the next one starts; the last one some pages on, at most at the end."""
    e = events(spark, sf_dir).select("event_id", "user_id", "ts", _day().alias("start"))
    return seq.next_bound(e, ["user_id"], ["ts", "event_id"], "start", F.least(F.col("start") + 4, F.lit(30))).select("event_id", "user_id", "start", "end")


ENTRIES_SQL = """entries AS (
  SELECT o_custkey AS doc_id, o_orderkey AS ord, date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS page, CASE o_orderstatus WHEN 'O' THEN 'heading' WHEN 'F' THEN 'leaf' ELSE 'other' END AS kind,
    CASE WHEN o_orderstatus = 'O' THEN repeat('I', CAST(substr(o_orderpriority, 1, 1) AS INT) % 3 + 1) END AS roman FROM orders),
whole AS (SELECT * FROM entries UNION ALL SELECT doc_id, 9223372036854775807, max(page) + 1, 'other', NULL FROM entries GROUP BY doc_id),
filled AS (SELECT *, last_value(roman IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS section_of FROM whole),
near AS (SELECT *, lag(kind) OVER w AS was, lag(section_of) OVER w AS was_of FROM filled WINDOW w AS (PARTITION BY doc_id ORDER BY ord)),
reached AS (
  SELECT doc_id, roman AS section, page AS reach, NULL AS stop, ord, ord AS first_ord, page AS start_page FROM near WHERE kind = 'heading' AND ord = (SELECT min(n.ord) FROM near n WHERE n.doc_id = near.doc_id AND n.roman = near.roman)
  UNION ALL SELECT doc_id, section_of, page, NULL, ord, NULL, NULL FROM near WHERE kind = 'leaf' AND section_of IS NOT NULL
  UNION ALL SELECT doc_id, was_of, page - 1, CASE WHEN kind = 'other' THEN page END, ord, NULL, NULL FROM near WHERE kind <> 'leaf' AND was IN ('heading', 'leaf') AND was_of IS NOT NULL),
ends AS (SELECT doc_id, section, max(reach) AS end_page, min(first_ord) AS first_ord, min(start_page) AS start_page FROM reached GROUP BY 1, 2)"""


@query(
    "section_hard_stops",
    f"""WITH {ENTRIES_SQL}, stops AS (SELECT r.doc_id, r.section, string_agg(CAST(r.stop AS VARCHAR), ',' ORDER BY r.ord) AS stops FROM reached r JOIN ends e USING (doc_id, section) WHERE r.stop <= e.end_page GROUP BY 1, 2)
    SELECT e.doc_id, CAST(row_number() OVER (PARTITION BY e.doc_id ORDER BY e.first_ord) AS INTEGER) AS section, e.section AS roman, CAST(e.start_page AS INTEGER) AS start_page, CAST(e.end_page AS INTEGER) AS end_page, coalesce(s.stops, '') AS stops
    FROM ends e LEFT JOIN stops s USING (doc_id, section)""",
)
def section_hard_stops(spark, sf_dir):
    """Sections among contents entries: headings, leaves and others, with the pages where the leaves must stop."""
    o = table(spark, sf_dir, "orders")
    roman = F.expr("repeat('I', cast(substr(o_orderpriority, 1, 1) as int) % 3 + 1)")
    title = F.when(F.col("o_orderstatus") == "O", F.concat(roman, F.lit(". NGUỒN GỐC"))).when(F.col("o_orderstatus") == "F", F.lit("1. Truyện")).otherwise(F.lit("Phụ bản"))
    rows = o.select(F.col("o_custkey").alias("doc_id"), F.col("o_orderkey").alias("ord"), title.alias("title"), F.unix_date(F.to_date("o_orderdate")).alias("page"))
    opened = rows.select("doc_id").distinct().select("doc_id", F.lit(-1).cast("long").alias("ord"), F.lit("PHẦN THỨ HAI").alias("title"), F.lit(0).alias("page"))
    found = toc.sections(opened.unionByName(rows)).where("section is not null")
    return found.select("doc_id", "section", "roman", "start_page", "end_page", F.array_join(F.col("hard_stops").cast("array<string>"), ",").alias("stops"))


@query("footnote_split", None)
def footnote_split(spark, sf_dir):
    """The notes of each line as a page's foot: a number opens one only if it is the next expected."""
    n = lines(spark, sf_dir, by_document=True).select("doc_id", "line_no", F.posexplode(footnotes.split_notes(F.col("line"))).alias("pos", "n"))
    return n.where("not n.continued").select("doc_id", "line_no", "pos", "n.num", "n.text")


@query(
    "hard_stop_clamp",
    """WITH leaf AS (SELECT o_orderkey, o_orderkey % 50 AS start, o_orderkey % 50 + 10 AS "end" FROM orders), stops AS (SELECT DISTINCT p_size AS stop FROM part)
    SELECT o_orderkey, start, least("end", coalesce((SELECT min(stop) - 1 FROM stops WHERE stop > start AND stop <= "end"), "end")) AS "end" FROM leaf""",
)
def hard_stop_clamp(spark, sf_dir):
    """A leaf ends before the first stop within it. The distinct ranges are few, so they, not the leaves, meet the stops."""
    leaf = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_orderkey") % 50).alias("start"), (F.col("o_orderkey") % 50 + 10).alias("end"))
    stops = table(spark, sf_dir, "part").select(F.col("p_size").cast("long").alias("stop")).distinct()
    ranges = leaf.select("start", "end").distinct()
    at = ranges.select("start", "end", F.explode(F.expr("sequence(start + 1, `end`)")).alias("stop")).join(stops, "stop", "left_semi").groupBy("start", "end").agg(F.min("stop").alias("stop"))
    return leaf.join(at, ["start", "end"], "left").select("o_orderkey", "start", F.least("end", F.coalesce(F.col("stop") - 1, F.col("end"))).alias("end"))


@query(
    "range_owner",
    """WITH r AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS s FROM orders),
    p AS (SELECT DISTINCT l.l_partkey, l.l_suppkey % 20 AS custkey, CAST(l.l_shipdate AS DATE) AS d FROM lineitem l),
    held AS (SELECT q.custkey, q.d, max(r.o_orderkey) AS owner FROM (SELECT DISTINCT custkey, d FROM p) q JOIN r ON r.o_custkey = q.custkey AND q.d BETWEEN r.s AND r.s + 30 GROUP BY 1, 2)
    SELECT p.l_partkey, p.custkey, strftime(p.d, '%Y-%m-%d') AS day, held.owner FROM p LEFT JOIN held USING (custkey, d)""",
)
def range_owner(spark, sf_dir):
    """The last range that holds each point."""
    day = lambda c: F.unix_date(F.to_date(c))
    r = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("custkey"), day("o_orderdate").alias("s"), (day("o_orderdate") + 30).alias("e"), F.col("o_orderkey").alias("owner"), F.col("o_orderkey").alias("ord"))
    p = table(spark, sf_dir, "lineitem").select("l_partkey", (F.col("l_suppkey") % 20).alias("custkey"), day("l_shipdate").alias("d")).distinct()
    out = seq.range_owner(p, r, ["custkey"], "d", "s", "e", "owner", "ord")
    return out.select("l_partkey", "custkey", F.date_format(F.date_from_unix_date("d"), "yyyy-MM-dd").alias("day"), "owner")


@query(
    "heading_has_text",
    "SELECT o_orderkey FROM orders o WHERE EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_shipdate > o.o_orderdate)",
)
def heading_has_text(spark, sf_dir):
    o, l = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    return o.join(l, (o["o_orderkey"] == l["l_orderkey"]) & (l["l_shipdate"] > o["o_orderdate"]), "left_semi").select("o_orderkey")


CARRY_SQL = f"""days AS (SELECT user_id, {DAY_SQL} AS day, max(event_id) FILTER (WHERE event_type = 'click') AS num FROM events GROUP BY 1, 2),
parts AS (SELECT *, sum(CASE WHEN day - prior = 1 THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY day) AS part FROM (SELECT *, lag(day) OVER (PARTITION BY user_id ORDER BY day) AS prior FROM days))"""


@query(
    "footnote_carry",
    f"WITH {CARRY_SQL} SELECT user_id, day, last_value(num IGNORE NULLS) OVER (PARTITION BY user_id, part ORDER BY day ROWS BETWEEN 10 PRECEDING AND CURRENT ROW) AS open_num FROM parts",
)
def footnote_carry(spark, sf_dir):
    """The number still open on a page: the latest within ten pages, forgotten where a page is missing."""
    days = events(spark, sf_dir).withColumn("day", _day()).groupBy("user_id", "day").agg(F.max(F.when(F.col("event_type") == "click", F.col("event_id"))).alias("num"))
    parts = seq.gap_islands(days, ["user_id"], "day", 1, "part")
    frame = seq.ordered(["user_id", "part"], ["day"]).rowsBetween(-10, 0)
    return parts.select("user_id", "day", F.last("num", ignorenulls=True).over(frame).alias("open_num"))


RUNS_SQL = f"""days AS (SELECT DISTINCT user_id, event_type, {DAY_SQL} AS day FROM events),
runs AS (SELECT *, sum(CASE WHEN day - prior <= 1 THEN 0 ELSE 1 END) OVER (PARTITION BY user_id, event_type ORDER BY day) AS run
  FROM (SELECT *, lag(day) OVER (PARTITION BY user_id, event_type ORDER BY day) AS prior FROM days))"""


def _runs(spark, sf_dir):
    days = events(spark, sf_dir).select("user_id", "event_type", _day().alias("day")).distinct()
    return seq.gap_islands(days, ["user_id", "event_type"], "day", 1, "run")


@query(
    "footnote_merge",
    f"WITH {RUNS_SQL} SELECT user_id, event_type, min(day) AS page, max(day) AS end_page, string_agg(CAST(day AS VARCHAR), ' ' ORDER BY day) AS text FROM runs GROUP BY user_id, event_type, run",
)
def footnote_merge(spark, sf_dir):
    g = _runs(spark, sf_dir).groupBy("user_id", "event_type", "run").agg(F.min("day").alias("page"), F.max("day").alias("end_page"), F.array_sort(F.collect_list("day")).alias("d"))
    return g.select("user_id", "event_type", "page", "end_page", F.array_join(F.transform("d", lambda x: x.cast("string")), " ").alias("text"))


@query("footnote_chains", f"WITH {RUNS_SQL} SELECT user_id, event_type, min(day) AS page, count(*) AS n_pages FROM runs GROUP BY user_id, event_type, run HAVING count(*) >= 2")
def footnote_chains(spark, sf_dir):
    g = _runs(spark, sf_dir).groupBy("user_id", "event_type", "run").agg(F.min("day").alias("page"), F.count(F.lit(1)).alias("n_pages"))
    return g.where("n_pages >= 2").drop("run")


@query(
    "recurring_runs",
    f"""WITH days AS (SELECT DISTINCT user_id, event_type, {DAY_SQL} AS day FROM events),
    runs AS (SELECT *, sum(CASE WHEN day - prior <= 3 THEN 0 ELSE 1 END) OVER (PARTITION BY user_id, event_type ORDER BY day) AS run FROM (SELECT *, lag(day) OVER (PARTITION BY user_id, event_type ORDER BY day) AS prior FROM days))
    SELECT user_id, event_type, min(day) AS first_page, max(day) AS last_page, count(*) AS n_pages FROM runs GROUP BY user_id, event_type, run HAVING count(*) >= 8""",
)
def recurring_runs(spark, sf_dir):
    days = events(spark, sf_dir).select("user_id", "event_type", _day().alias("day")).distinct()
    runs = seq.gap_islands(days, ["user_id", "event_type"], "day", 3, "run")
    return runs.groupBy("user_id", "event_type", "run").agg(F.min("day").alias("first_page"), F.max("day").alias("last_page"), F.count(F.lit(1)).alias("n_pages")).where("n_pages >= 8").drop("run")


@query(
    "ownership_filter",
    "SELECT d.doc_id FROM documents d WHERE NOT (d.doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) AND d.doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1))",
)
def ownership_filter(spark, sf_dir):
    """Rows seen outside the bounds and not inside are dropped; rows never seen stay."""
    l = table(spark, sf_dir, "labels")
    lost = l.where("toxic = 1").select("doc_id").exceptAll(l.where("toxic = 1").select("doc_id").join(l.where("quality = 1"), "doc_id", "left_semi")).distinct()
    return table(spark, sf_dir, "documents").select("doc_id").join(lost, "doc_id", "left_anti")


@query(
    "layout_stats",
    """WITH h AS (SELECT l_returnflag, CAST(round_even(l_extendedprice / 1000, 0) AS BIGINT) AS x, count(*) AS n FROM lineitem GROUP BY 1, 2),
    r AS (SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY n DESC, x) AS k FROM h),
    m AS (SELECT l_returnflag, min(x) AS min_x, max(x) AS max_x FROM h GROUP BY 1)
    SELECT r.l_returnflag, r.k, r.x, r.n, m.min_x, m.max_x FROM r JOIN m USING (l_returnflag) WHERE r.k <= 2""",
)
def layout_stats(spark, sf_dir):
    """The two commonest rounded positions of each class, and the extremes."""
    h = table(spark, sf_dir, "lineitem").groupBy("l_returnflag", F.bround(F.col("l_extendedprice") / 1000, 0).cast("long").alias("x")).agg(F.count(F.lit(1)).alias("n"))
    m = h.groupBy("l_returnflag").agg(F.min("x").alias("min_x"), F.max("x").alias("max_x"))
    k = F.row_number().over(Window.partitionBy("l_returnflag").orderBy(F.desc("n"), "x")).cast("long")
    return h.withColumn("k", k).where("k <= 2").join(m, "l_returnflag").select("l_returnflag", "k", "x", "n", "min_x", "max_x")


@query(
    "font_histogram",
    "SELECT lang, source, CAST(sum(length(text)) AS BIGINT) AS chars, count(*) AS n FROM documents GROUP BY lang, source",
)
def font_histogram(spark, sf_dir):
    return table(spark, sf_dir, "documents").groupBy("lang", "source").agg(F.sum(F.length("text")).cast("long").alias("chars"), F.count(F.lit(1)).alias("n"))


@query(
    "survey_summary",
    "SELECT event_type, count(*) AS n, count(*) FILTER (WHERE value > 50) AS n_high, count(*) FILTER (WHERE value <= 50) AS n_low, count(DISTINCT user_id) AS n_users FROM events GROUP BY event_type",
)
def survey_summary(spark, sf_dir):
    v = F.col("value")
    return events(spark, sf_dir).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.count_if(v > 50).alias("n_high"), F.count_if(v <= 50).alias("n_low"), F.countDistinct("user_id").alias("n_users"))


@query(
    "section_manifest",
    """SELECT r.r_regionkey, n.n_nationkey, n.n_name, count(c.c_custkey) AS total_stories, coalesce(max(c.c_custkey), 0) AS end_page FROM region r JOIN nation n ON n.n_regionkey = r.r_regionkey LEFT JOIN customer c ON c.c_nationkey = n.n_nationkey GROUP BY 1, 2, 3""",
)
def section_manifest(spark, sf_dir):
    c = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("total"), F.max("c_custkey").alias("last"))
    n = table(spark, sf_dir, "region").join(table(spark, sf_dir, "nation"), F.col("r_regionkey") == F.col("n_regionkey")).join(c, F.col("n_nationkey") == F.col("c_nationkey"), "left")
    return n.select("r_regionkey", "n_nationkey", "n_name", F.coalesce("total", F.lit(0)).alias("total_stories"), F.coalesce("last", F.lit(0)).alias("end_page"))


@query(
    "root_manifest",
    """SELECT r.r_regionkey, r.r_name, count(DISTINCT n.n_nationkey) AS n_sections, count(c.c_custkey) AS n_leaves FROM region r LEFT JOIN nation n ON n.n_regionkey = r.r_regionkey LEFT JOIN customer c ON c.c_nationkey = n.n_nationkey GROUP BY 1, 2""",
)
def root_manifest(spark, sf_dir):
    m = section_manifest(spark, sf_dir).groupBy("r_regionkey").agg(F.count(F.lit(1)).alias("n_sections"), F.sum("total_stories").alias("n_leaves"))
    return table(spark, sf_dir, "region").join(m, "r_regionkey", "left").select("r_regionkey", "r_name", F.coalesce("n_sections", F.lit(0)).alias("n_sections"), F.coalesce("n_leaves", F.lit(0)).alias("n_leaves"))


@query(
    "section_manifest_json",
    """WITH leaf AS (SELECT c_nationkey AS section, c_custkey AS ord, c_name AS title, c_mktsegment AS category FROM customer),
    kinds AS (SELECT section, category, min(ord) AS first_ord, list({'ord': ord, 'title': title, 'category': category} ORDER BY ord) AS stories FROM leaf GROUP BY 1, 2),
    whole AS (SELECT section, CAST(sum(len(stories)) AS BIGINT) AS n, list({'category': category, 'stories': stories} ORDER BY first_ord) AS categories FROM kinds GROUP BY 1)
    SELECT n_nationkey AS section, CAST(to_json({'name': n_name, 'total_stories': coalesce(n, 0), 'categories': coalesce(categories, [])}) AS VARCHAR) AS json FROM nation LEFT JOIN whole ON n_nationkey = section""",
)
def section_manifest_json(spark, sf_dir):
    from folioframe.operators.render import manifest

    c = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("section"), F.col("c_custkey").alias("ord"), F.col("c_name").alias("title"), F.col("c_mktsegment").alias("category"))
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("section"), F.col("n_name").alias("name"))
    return manifest(n, c, "stories")
