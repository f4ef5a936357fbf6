"""Checks of an output against its source, reports and names, bound to tables of the same shape."""

from __future__ import annotations

from pyspark.sql import functions as F

from folioframe.functions import text as t
from folioframe.operators import extract, names, validate
from folioframe.operators import sequence as seq
from folioframe.plans.structure_queries import DAY_SQL, RUNS_SQL, _day, _runs
from folioframe.plans.tables import events, table

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
    "weighted_coverage",
    """WITH s AS (SELECT l_orderkey, CAST(sum(CAST(l_quantity AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(6,4)))) AS DOUBLE) AS part, CAST(sum(CAST(l_quantity AS DECIMAL(12,2))) AS DOUBLE) AS whole FROM lineitem GROUP BY l_orderkey)
    SELECT l_orderkey, floor(least(1.0, part / nullif(whole, 0)) * 1000000 + 0.5) / 1000000 AS coverage FROM s""",
)
def weighted_coverage(spark, sf_dir):
    """A mean weighted by size, from sums of decimals: these are the same in any order."""
    size, lost = F.col("l_quantity").cast("decimal(12,2)"), F.col("l_discount").cast("decimal(6,4)")
    ratio = F.try_divide(F.sum(size * (1 - lost)).cast("double"), F.sum(size).cast("double"))
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg((F.floor(F.least(F.lit(1.0), ratio) * 1e6 + 0.5) / 1e6).alias("coverage"))


@query(
    "orphan_markers",
    f"""SELECT 'ORPHAN_MARKER' AS flag, doc_id AS num FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
    UNION ALL SELECT 'ORPHAN_DEFINITION', user_id FROM (SELECT DISTINCT user_id FROM events) u WHERE user_id NOT IN (SELECT doc_id FROM labels)""",
)
def orphan_markers(spark, sf_dir):
    """Markers without a definition, and definitions without a marker."""
    defined = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("num"))
    a = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("num")).join(defined, "num", "left_anti")
    b = events(spark, sf_dir).select(F.col("user_id").alias("num")).distinct().join(defined, "num", "left_anti")
    return a.select(F.lit("ORPHAN_MARKER").alias("flag"), "num").unionByName(b.select(F.lit("ORPHAN_DEFINITION").alias("flag"), "num"))


@query(
    "chain_coverage",
    f"""WITH {RUNS_SQL}, r AS (SELECT user_id, event_type, min(day) AS s, max(day) AS e FROM runs GROUP BY user_id, event_type, run),
    covered AS (SELECT DISTINCT user_id, unnest(generate_series(s, e)) AS day FROM r WHERE event_type = 'click'), required AS (SELECT DISTINCT user_id, day FROM days WHERE event_type = 'purchase')
    SELECT user_id, CAST(day AS INTEGER) AS day FROM (SELECT user_id, day FROM required EXCEPT SELECT user_id, day FROM covered)""",
)
def chain_coverage(spark, sf_dir):
    """Required pages that no range of the entry covers."""
    r = _runs(spark, sf_dir).groupBy("user_id", "event_type", "run").agg(F.min("day").alias("s"), F.max("day").alias("e"))
    covered = r.where("event_type = 'click'").select("user_id", F.explode(F.sequence("s", "e")).alias("day"))
    required = events(spark, sf_dir).where("event_type = 'purchase'").select("user_id", _day().alias("day")).distinct()
    return required.join(covered, ["user_id", "day"], "left_anti")


@query(
    "footnote_monotonic",
    """SELECT l_orderkey, bool_and(ok) AS monotonic, count(*) AS n FROM (SELECT l_orderkey, coalesce(l_shipdate >= lag(l_shipdate) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate), true) AS ok FROM lineitem) GROUP BY l_orderkey""",
)
def footnote_monotonic(spark, sf_dir):
    order = seq.ordered(["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"])
    ok = F.coalesce(F.col("l_shipdate") >= F.lag("l_shipdate").over(order), F.lit(True))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", ok.alias("ok")).groupBy("l_orderkey").agg(F.bool_and("ok").alias("monotonic"), F.count(F.lit(1)).alias("n"))


@query(
    "duplicate_numbers",
    f"SELECT user_id, event_type, count(*) AS n, count(DISTINCT {DAY_SQL}) AS n_days FROM events GROUP BY user_id, event_type HAVING count(*) > count(DISTINCT {DAY_SQL})",
)
def duplicate_numbers(spark, sf_dir):
    g = events(spark, sf_dir).groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"), F.countDistinct(_day()).alias("n_days"))
    return g.where("n > n_days")


@query(
    "completeness",
    """WITH a AS (SELECT o.o_orderkey, count(l.l_orderkey) AS actual, coalesce(max(l.l_linenumber), 0) AS expected FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey GROUP BY 1)
    SELECT o_orderkey, CAST(expected AS BIGINT) AS expected, actual, CAST(actual - expected AS BIGINT) AS delta, CASE WHEN actual = expected THEN 'OK' WHEN actual < expected THEN 'MISSING' ELSE 'EXTRA' END AS code FROM a""",
)
def completeness(spark, sf_dir):
    actual = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("actual"), F.max("l_linenumber").cast("long").alias("expected"))
    return validate.completeness(table(spark, sf_dir, "orders").select("o_orderkey"), actual, "o_orderkey")


FLAGS_SQL = """flags AS (
  SELECT doc_id, 'LOW_DENSITY' AS flag FROM documents WHERE n_chars < 300
  UNION ALL SELECT doc_id, 'TOXIC' FROM labels WHERE toxic = 1
  UNION ALL SELECT doc_id, 'LOW_QUALITY' FROM labels WHERE quality = 0),
allowed(flag, reason) AS (VALUES ('LOW_QUALITY', 'known')),
split AS (SELECT f.doc_id, f.flag, a.reason FROM flags f LEFT JOIN allowed a ON f.flag = a.flag AND f.doc_id % 2 = 0)"""


def _flags(spark, sf_dir):
    d, l = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    parts = [(d.where("n_chars < 300"), "LOW_DENSITY"), (l.where("toxic = 1"), "TOXIC"), (l.where("quality = 0"), "LOW_QUALITY")]
    rows = [x.select("doc_id", F.lit(name).alias("flag")) for x, name in parts]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@query("apply_errata", f"WITH {FLAGS_SQL} SELECT doc_id, flag, reason, reason IS NOT NULL AS erratum FROM split")
def apply_errata(spark, sf_dir):
    """Flags on an allow-list move from notes to errata."""
    f = _flags(spark, sf_dir)
    allowed = spark.createDataFrame([("LOW_QUALITY", 0, "known")], "flag string, even int, reason string")
    return validate.apply_errata(f.withColumn("even", (F.col("doc_id") % 2).cast("int")), allowed, ["flag", "even"]).select("doc_id", "flag", "reason", "erratum")


STATUS_SQL = f"""{FLAGS_SQL},
status AS (SELECT d.doc_id, d.lang, d.source, CAST(d.n_chars AS DOUBLE) / 10000 AS coverage, count(s.flag) FILTER (WHERE s.reason IS NULL) AS n_notes, count(s.flag) FILTER (WHERE s.reason IS NOT NULL) AS n_errata
  FROM documents d LEFT JOIN split s USING (doc_id) GROUP BY 1, 2, 3, 4),
named AS (SELECT *, CASE WHEN n_notes > 0 THEN 'REVIEW' WHEN n_errata > 0 THEN 'ERRATUM' ELSE 'OK' END AS status FROM status)"""


def _status(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", (F.col("n_chars").cast("double") / 10000).alias("coverage"))
    return validate.leaf_status(d, apply_errata(spark, sf_dir), "doc_id")


@query("leaf_status", f"WITH {STATUS_SQL} SELECT doc_id, n_notes, n_errata, status FROM named")
def leaf_status(spark, sf_dir):
    return _status(spark, sf_dir).select("doc_id", "n_notes", "n_errata", "status")


@query("worst_first_top15", f"WITH {STATUS_SQL} SELECT doc_id, lang, round_even(coverage, 6) AS coverage, status FROM (SELECT * FROM named ORDER BY coverage, lang, source, doc_id LIMIT 15)")
def worst_first_top15(spark, sf_dir):
    return validate.worst_first(_status(spark, sf_dir), ["coverage", "lang", "source", "doc_id"], 15).select("doc_id", "lang", F.bround("coverage", 6).alias("coverage"), "status")


@query(
    "report_counts",
    f"WITH {STATUS_SQL} SELECT lang, source, count(*) AS n, count(*) FILTER (WHERE status = 'OK') AS n_ok, count(*) FILTER (WHERE status = 'ERRATUM') AS n_erratum, count(*) FILTER (WHERE status = 'REVIEW') AS n_review FROM named GROUP BY 1, 2",
)
def report_counts(spark, sf_dir):
    return validate.report_counts(_status(spark, sf_dir), ["lang", "source"])


@query(
    "report_rows",
    f"WITH {STATUS_SQL} SELECT doc_id, '| ' || doc_id || ' | ' || format('{{:.3f}}', coverage) || ' | ' || status || ' |' AS line FROM named WHERE status <> 'OK'",
)
def report_rows(spark, sf_dir):
    s = _status(spark, sf_dir).where("status <> 'OK'")
    return s.select("doc_id", F.format_string("| %d | %s | %s |", "doc_id", t.fixed_point(3)("coverage"), "status").alias("line"))


@query(
    "page_text_offsets",
    """WITH o AS (SELECT conv_id, turn, length(text) AS n FROM conversations)
    SELECT conv_id, turn, CAST(coalesce(sum(n + 1) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS offset_at FROM o""",
)
def page_text_offsets(spark, sf_dir):
    """Where each page starts in the joined text."""
    before = seq.ordered(["conv_id"], ["turn"]).rowsBetween(seq.Window.unboundedPreceding, -1)
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.coalesce(F.sum(F.length("text") + 1).over(before), F.lit(0)).cast("long").alias("offset_at"))


@query("html_body_coverage", None)
def html_body_coverage(spark, sf_dir):
    """How much of each page's body text a tag-stripped rendering keeps, by longest matching blocks."""
    p = table(spark, sf_dir, "pages").select("page_id", F.regexp_replace("html", r"(?s)<(script|style)[^>]*>.*?</\1>|<[^>]*>", " ").alias("rendered"), F.regexp_extract("html", r"(?s)<article>(.*?)</article>", 1).alias("source"))
    return p.select("page_id", F.bround(validate.coverage(F.col("source"), F.col("rendered")), 4).alias("coverage"))


FIRST_WORDS_SQL = r"SELECT item_id, regexp_extract(text, '^(\S+ \S+ \S+)', 1) AS name FROM benchmark"


def _names(spark, sf_dir):
    return table(spark, sf_dir, "benchmark").select("item_id", F.regexp_extract("text", r"^(\S+ \S+ \S+)", 1).alias("name")).where("name <> ''")


@query(
    "name_exact",
    f"WITH n AS ({FIRST_WORDS_SQL}) SELECT n.item_id, d.doc_id FROM n JOIN documents d ON n.name <> '' AND contains(lower(d.text), lower(n.name))",
)
def name_exact(spark, sf_dir):
    """Documents that hold a printed name, in any case. The names are a list of bounded size, sought in one pass."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return names.exact(_names(spark, sf_dir), docs, "item_id", "name", "doc_id", "text")


@query(
    "name_tiers",
    f"""WITH n AS ({FIRST_WORDS_SQL}), exact AS (SELECT n.item_id, d.doc_id FROM n JOIN documents d ON n.name <> '' AND contains(d.text, n.name)),
    folded AS (SELECT n.item_id, d.doc_id FROM n JOIN documents d ON n.name <> '' AND contains(lower(d.text), lower(n.name)))
    SELECT item_id, doc_id, 1 AS tier FROM exact UNION ALL SELECT item_id, doc_id, 2 FROM folded WHERE item_id NOT IN (SELECT item_id FROM exact)""",
)
def name_tiers(spark, sf_dir):
    docs, n = table(spark, sf_dir, "documents").select("doc_id", "text"), _names(spark, sf_dir)
    tiers = [names.exact(n, docs, "item_id", "name", "doc_id", "text", fold=False), names.exact(n, docs, "item_id", "name", "doc_id", "text")]
    return seq.first_match_by_tier(n, "item_id", tiers).select("item_id", "doc_id", "tier")


@query(
    "name_folded",
    f"WITH n AS ({FIRST_WORDS_SQL}), d AS (SELECT doc_id, strip_accents(replace(lower(text), 'đ', 'd')) AS text FROM documents) SELECT n.item_id, d.doc_id FROM n JOIN d ON n.name <> '' AND contains(d.text, strip_accents(replace(lower(n.name), 'đ', 'd')))",
)
def name_folded(spark, sf_dir):
    """Documents that hold a printed name, without case and diacritics."""
    docs = table(spark, sf_dir, "documents").select("doc_id", t.folded(F.col("text")).alias("text"))
    return names.exact(_names(spark, sf_dir).select("item_id", t.folded(F.col("name")).alias("name")), docs, "item_id", "name", "doc_id", "text", fold=False)


@query("name_fuzzy", None)
def name_fuzzy(spark, sf_dir):
    """The best window of words of each document for each name, where it is close enough."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return names.fuzzy(_names(spark, sf_dir), docs, "item_id", "name", "doc_id", "text")


@query(
    "alias_resolution",
    """WITH p AS (SELECT p_partkey, p_name, split_part(p_name, ' ', 1) AS half FROM part),
    keys AS (SELECT p_name AS k, min(p_partkey) AS target FROM part GROUP BY 1),
    half_keys AS (SELECT split_part(p_name, ' ', 1) AS k, min(p_partkey) AS target FROM part GROUP BY 1)
    SELECT p.p_partkey, coalesce(f.target, h.target) AS target, CASE WHEN f.target IS NOT NULL THEN 1 WHEN h.target IS NOT NULL THEN 2 END AS tier
    FROM p LEFT JOIN keys f ON p.p_name = f.k LEFT JOIN half_keys h ON p.half = h.k""",
)
def alias_resolution(spark, sf_dir):
    """An alias by its full name, else by the first half of it."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", F.split_part("p_name", F.lit(" "), F.lit(1)).alias("half"))
    full = p.groupBy(F.col("p_name").alias("k")).agg(F.min("p_partkey").alias("target"))
    half = p.groupBy(F.col("half").alias("k")).agg(F.min("p_partkey").alias("target"))
    tiers = [p.join(full, F.col("p_name") == F.col("k")).select("p_partkey", "target"), p.join(half, F.col("half") == F.col("k")).select("p_partkey", "target")]
    found = seq.first_match_by_tier(p, "p_partkey", tiers)
    return p.select("p_partkey").join(found, "p_partkey", "left").select("p_partkey", "target", "tier")


DRIFT_SQL = """e AS (SELECT 'document_' || o_custkey % 40 || '/part_2/' || o_orderpriority AS path, count(*) AS expected, count(*) FILTER (WHERE o_orderstatus <> 'F') + o_custkey % 40 % 3 AS actual FROM orders GROUP BY o_custkey % 40, o_orderpriority),
d AS (SELECT path, expected, actual, actual - expected AS delta, CASE WHEN actual = 0 THEN 'MISSING_SECTION' WHEN actual < expected THEN 'MISSING_LEAVES' ELSE 'EXTRA_LEAVES' END AS flag FROM e WHERE actual <> expected)"""


@query(
    "drift_errata",
    f"""WITH {DRIFT_SQL}, w AS (SELECT path, flag, CASE WHEN expected % 2 = 0 THEN delta ELSE delta - 1 END AS delta, 'known ' || expected AS reason FROM d WHERE expected % 3 <> 0)
    SELECT d.path, d.flag, d.delta, w.reason, w.reason IS NOT NULL AS erratum FROM d LEFT JOIN w ON d.path = w.path AND d.flag = w.flag AND d.delta = w.delta""",
)
def drift_errata(spark, sf_dir):
    """Sections that drift from their contents, against a list of known drifts by path, flag and number."""
    doc = F.col("o_custkey") % 40
    e = table(spark, sf_dir, "orders").groupBy(doc.alias("doc"), "o_orderpriority").agg(F.count(F.lit(1)).alias("expected"), F.count_if(F.col("o_orderstatus") != "F").alias("kept"))
    e = e.select(F.concat(F.lit("document_"), F.col("doc").cast("string"), F.lit("/part_2/"), "o_orderpriority").alias("path"), "expected", (F.col("kept") + F.col("doc") % 3).alias("actual"))
    d = e.withColumn("delta", F.col("actual") - F.col("expected")).where("delta <> 0").withColumn("flag", F.when(F.col("actual") == 0, "MISSING_SECTION").when(F.col("delta") < 0, "MISSING_LEAVES").otherwise("EXTRA_LEAVES"))
    listed = d.where("expected % 3 <> 0").select("path", "flag", F.when(F.col("expected") % 2 == 0, F.col("delta")).otherwise(F.col("delta") - 1).alias("delta"), F.concat(F.lit("known "), F.col("expected").cast("string")).alias("reason"))
    return extract.known_drift(d, listed).select("path", "flag", "delta", "reason", "erratum")
