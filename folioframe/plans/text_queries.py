"""Text repair, dialogue, paragraphs and verse over the documents and conversations."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folioframe.functions import text as t
from folioframe.operators import sequence as seq
from folioframe.plans.tables import LINES_SQL, lines, table

QUERIES: dict = {}
ORACLES: dict = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


@query("normalize_encoding", f"SELECT doc_id, md5({t.normalize_encoding_sql('text')}) AS digest, CAST(length({t.normalize_encoding_sql('text')}) AS BIGINT) AS n_chars FROM documents")
def normalize_encoding(spark, sf_dir):
    fixed = t.normalize_encoding(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(fixed.cast("binary")).alias("digest"), F.length(fixed).cast("long").alias("n_chars"))


@query("clean_spaces", f"WITH {LINES_SQL} SELECT doc_id, line_no, {t.clean_spaces_sql('line')} AS line FROM lines")
def clean_spaces(spark, sf_dir):
    return lines(spark, sf_dir).select("doc_id", "line_no", t.clean_spaces(F.col("line")).alias("line"))


WORDS_SQL = r"words AS (SELECT doc_id, unnest(string_split_regex(text, '\s+')) AS word FROM documents)"


@query(
    "superscript_marker",
    f"WITH {WORDS_SQL} SELECT doc_id, word, {t.superscript_marker_sql('word')} AS marker, count(*) AS n FROM words WHERE regexp_matches(word, '^[0-9]') GROUP BY 1, 2, 3",
)
def superscript_marker(spark, sf_dir):
    words = table(spark, sf_dir, "documents").select("doc_id", F.explode(F.split("text", r"\s+")).alias("word")).where(F.col("word").rlike("^[0-9]"))
    return words.withColumn("marker", t.superscript_marker(F.col("word"))).groupBy("doc_id", "word", "marker").agg(F.count(F.lit(1)).alias("n"))


@query("all_caps_lines", f"WITH {LINES_SQL} SELECT doc_id, line_no, CAST(length(line) AS BIGINT) AS n_chars FROM lines WHERE {t.is_all_caps_sql('line')}")
def all_caps_lines(spark, sf_dir):
    return lines(spark, sf_dir).where(t.is_all_caps(F.col("line"))).select("doc_id", "line_no", F.length("line").cast("long").alias("n_chars"))


@query(
    "mostly_caps_ratio",
    f"WITH {LINES_SQL} SELECT doc_id, line_no, round_even({t.caps_ratio_sql('line')}, 6) AS ratio, coalesce({t.caps_ratio_sql('line')} >= 0.9, false) AS heading FROM lines",
)
def mostly_caps_ratio(spark, sf_dir):
    ratio = t.caps_ratio(F.col("line"))
    return lines(spark, sf_dir).select("doc_id", "line_no", F.bround(ratio, 6).alias("ratio"), F.coalesce(ratio >= 0.9, F.lit(False)).alias("heading"))


@query(
    "sentence_end_stats",
    f"""WITH {LINES_SQL}, marked AS (SELECT d.lang, {t.ends_sentence_sql('l.line')} AS ends FROM lines l JOIN documents d USING (doc_id))
    SELECT lang, count(*) AS n_lines, count(*) FILTER (WHERE ends) AS n_ends FROM marked GROUP BY lang""",
)
def sentence_end_stats(spark, sf_dir):
    marked = table(spark, sf_dir, "documents").select("lang", F.explode(F.split("text", "\n")).alias("line")).withColumn("ends", t.ends_sentence(F.col("line")))
    return marked.groupBy("lang").agg(F.count(F.lit(1)).alias("n_lines"), F.count_if("ends").alias("n_ends"))


SPOKEN_SQL = "spoken AS (SELECT conv_id, string_agg(role || ': - ' || text, ' ' ORDER BY turn) AS text FROM conversations GROUP BY conv_id)"


def _spoken(spark, sf_dir):
    """Each conversation as one running text with dialogue dashes."""
    turn = F.concat(F.col("role"), F.lit(": - "), F.col("text"))
    c = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", turn.alias("said")))).alias("turns"))
    return c.select("conv_id", F.array_join(F.transform("turns", lambda x: x.said), " ").alias("text"))


@query(
    "split_dialogues",
    f"""WITH {SPOKEN_SQL}, parts AS (SELECT conv_id, {t.split_dialogues_sql('text')} AS parts FROM spoken)
    SELECT conv_id, CAST(unnest(generate_series(0, len(parts) - 1)) AS INTEGER) AS para_no, unnest(parts) AS para FROM parts""",
)
def split_dialogues(spark, sf_dir):
    return _spoken(spark, sf_dir).select("conv_id", F.posexplode(t.split_dialogues(F.col("text"))).alias("para_no", "para"))


@query("scene_dividers", f"WITH {LINES_SQL} SELECT doc_id, line_no, line FROM lines WHERE regexp_matches(line, {t.quote(t.SCENE_DIVIDER)}) UNION ALL SELECT -1, 0, '* * *'")
def scene_dividers(spark, sf_dir):
    literal = spark.createDataFrame([(-1, 0, "* * *"), (-1, 1, "*** x")], "doc_id long, line_no int, line string")
    return lines(spark, sf_dir).unionByName(literal).where(t.is_scene_divider(F.col("line")))


@query("continuation_markers", "SELECT * FROM (VALUES (1, true), (2, true), (3, false), (4, false)) v(n, continued)")
def continuation_markers(spark, sf_dir):
    rows = [(1, "(Tiếp theo)"), (2, " ( TIẾP  THEO ). "), (3, "Tiếp theo"), (4, "(Tiếp theo) nữa")]
    return spark.createDataFrame(rows, "n int, line string").select("n", t.is_continuation_marker(F.col("line")).alias("continued"))


PARAGRAPHS_SQL = f"""WITH {LINES_SQL},
cleaned AS (SELECT doc_id, line_no, {t.clean_spaces_sql('line')} AS line FROM lines),
kept AS (SELECT *, {t.ends_sentence_sql('line')} AS ends FROM cleaned WHERE line <> ''),
runs AS (SELECT *, coalesce(sum(CAST(ends AS INT)) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS island FROM kept)
SELECT doc_id, CAST(island AS BIGINT) AS para_no, count(*) AS n_lines, string_agg(line, ' ' ORDER BY line_no) AS para_text FROM runs GROUP BY doc_id, island"""


@query("paragraph_assembly", PARAGRAPHS_SQL)
def paragraph_assembly(spark, sf_dir):
    """Lines joined into paragraphs: a new one after a line that ends a sentence."""
    kept = lines(spark, sf_dir, by_document=True).select("doc_id", "line_no", t.clean_spaces(F.col("line")).alias("line")).where("line <> ''")
    runs = seq.islands_after(kept, ["doc_id"], ["line_no"], t.ends_sentence(F.col("line")))
    listed = runs.groupBy("doc_id", "island").agg(F.count(F.lit(1)).alias("n_lines"), F.array_sort(F.collect_list(F.struct("line_no", "line"))).alias("l"))
    return listed.select("doc_id", F.col("island").cast("long").alias("para_no"), "n_lines", F.array_join(F.transform("l", lambda x: x.line), " ").alias("para_text"))


@query(
    "prose_verse_runs",
    f"""WITH {LINES_SQL}, kinds AS (SELECT doc_id, line_no, length(line) < 40 AS short FROM lines WHERE line <> ''),
    marked AS (SELECT *, CASE WHEN short IS NOT DISTINCT FROM lag(short) OVER w AND row_number() OVER w > 1 THEN 0 ELSE 1 END AS new FROM kinds WINDOW w AS (PARTITION BY doc_id ORDER BY line_no)),
    runs AS (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY line_no) AS island FROM marked)
    SELECT doc_id, CAST(island AS BIGINT) AS run_no, short, min(line_no) AS first_line, count(*) AS n_lines FROM runs GROUP BY doc_id, island, short""",
)
def prose_verse_runs(spark, sf_dir):
    kinds = lines(spark, sf_dir).where("line <> ''").select("doc_id", "line_no", (F.length("line") < 40).alias("short"))
    runs = seq.change_islands(kinds, ["doc_id"], ["line_no"], F.col("short"))
    return runs.groupBy("doc_id", F.col("island").cast("long").alias("run_no"), "short").agg(F.min("line_no").alias("first_line"), F.count(F.lit(1)).alias("n_lines"))


VERSE_LINE_SQL = rf"length(line) BETWEEN 1 AND 60 AND NOT regexp_matches(line, '^\s*[0-9]') AND NOT {t.is_all_caps_sql('line')}"


@query(
    "verse_runs",
    f"""WITH {LINES_SQL}, c AS (SELECT doc_id, line_no, coalesce({VERSE_LINE_SQL}, false) AS verse FROM lines),
    runs AS (SELECT *, sum(CASE WHEN verse THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY line_no) AS island FROM c)
    SELECT doc_id, min(line_no) AS first_line, count(*) AS n_lines FROM runs WHERE verse GROUP BY doc_id, island HAVING count(*) >= 2""",
)
def verse_runs(spark, sf_dir):
    """Runs of at least two short lines that are no headings and no list items."""
    line = F.col("line")
    verse = F.length(line).between(1, 60) & ~line.rlike(r"^\s*[0-9]") & ~t.is_all_caps(line)
    c = lines(spark, sf_dir, by_document=True).select("doc_id", "line_no", verse.alias("verse"))
    runs = seq.islands(c, ["doc_id"], ["line_no"], ~F.col("verse"))
    return runs.where("verse").groupBy("doc_id", "island").agg(F.min("line_no").alias("first_line"), F.count(F.lit(1)).alias("n_lines")).where("n_lines >= 2").drop("island")


@query("slug", f"SELECT doc_id, {t.slug_sql('text')} AS slug FROM documents")
def slug(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", t.slug(F.col("text")).alias("slug"))


@query(
    "bib_entries",
    rf"""WITH {LINES_SQL}, k AS (SELECT doc_id, line_no, line, regexp_matches(line, '^\p{{Lu}}') AS starts FROM lines WHERE line <> ''),
    runs AS (SELECT *, sum(CAST(starts AS INT)) OVER (PARTITION BY doc_id ORDER BY line_no) AS island FROM k)
    SELECT doc_id, CAST(island AS BIGINT) AS entry_no, string_agg(line, ' ' ORDER BY line_no) AS entry FROM runs GROUP BY doc_id, island""",
)
def bib_entries(spark, sf_dir):
    """Hanging-indent entries: a line in capitals opens one, others continue it."""
    k = lines(spark, sf_dir).where("line <> ''")
    runs = seq.islands(k, ["doc_id"], ["line_no"], F.col("line").rlike(r"^\p{Lu}"))
    listed = runs.groupBy("doc_id", "island").agg(F.array_sort(F.collect_list(F.struct("line_no", "line"))).alias("l"))
    return listed.select("doc_id", F.col("island").cast("long").alias("entry_no"), F.array_join(F.transform("l", lambda x: x.line), " ").alias("entry"))


@query(
    "bib_render",
    """SELECT n.n_nationkey, '## ' || any_value(n.n_name) || chr(10) || coalesce(string_agg('- ' || s.s_name, chr(10) ORDER BY s.s_suppkey), '') AS markdown, count(s.s_suppkey) AS n_entries
    FROM nation n LEFT JOIN supplier s ON s.s_nationkey = n.n_nationkey GROUP BY n.n_nationkey""",
)
def bib_render(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").groupBy("s_nationkey").agg(F.array_sort(F.collect_list(F.struct("s_suppkey", "s_name"))).alias("e"))
    joined = table(spark, sf_dir, "nation").join(s, F.col("n_nationkey") == F.col("s_nationkey"), "left")
    body = F.array_join(F.transform(F.coalesce("e", F.expr("cast(array() as array<struct<s_suppkey:bigint,s_name:string>>)")), lambda x: F.concat(F.lit("- "), x.s_name)), "\n")
    return joined.select("n_nationkey", F.concat(F.lit("## "), "n_name", F.lit("\n"), body).alias("markdown"), F.coalesce(F.size("e"), F.lit(0)).cast("long").alias("n_entries"))


@query(
    "render_markdown",
    """SELECT conv_id, '# Conversation ' || conv_id || chr(10) || chr(10) || string_agg('**' || role || '**: ' || text, chr(10) || chr(10) ORDER BY turn) AS markdown FROM conversations GROUP BY conv_id""",
)
def render_markdown(spark, sf_dir):
    para = F.concat(F.lit("**"), "role", F.lit("**: "), "text")
    c = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", para.alias("para")))).alias("p"))
    return c.select("conv_id", F.concat(F.lit("# Conversation "), F.col("conv_id").cast("string"), F.lit("\n\n"), F.array_join(F.transform("p", lambda x: x.para), "\n\n")).alias("markdown"))


@query(
    "strip_scaffolding",
    r"""WITH m AS (SELECT conv_id, '# Conversation ' || conv_id || chr(10) || chr(10) || string_agg('**' || role || '**: ' || text, chr(10) || chr(10) ORDER BY turn) AS markdown FROM conversations GROUP BY conv_id),
    l AS (SELECT conv_id, string_split(markdown, chr(10)) AS parts FROM m),
    e AS (SELECT conv_id, unnest(generate_series(0, len(parts) - 1)) AS n, unnest(parts) AS line FROM l)
    SELECT conv_id, string_agg(regexp_replace(line, '^\*\*[a-z]+\*\*: ', ''), ' ' ORDER BY n) AS body FROM e WHERE line <> '' AND NOT regexp_matches(line, '^\s{0,3}#{1,6}\s+') AND NOT regexp_matches(line, '^\s*-{3,}\s*$') GROUP BY conv_id""",
)
def strip_scaffolding(spark, sf_dir):
    """The text of rendered Markdown without headings, rules and labels."""
    kept = F.filter(F.split("markdown", "\n"), lambda l: (l != "") & ~l.rlike(r"^\s{0,3}#{1,6}\s+") & ~l.rlike(r"^\s*-{3,}\s*$"))
    bare = F.transform(kept, lambda l: F.regexp_replace(l, r"^\*\*[a-z]+\*\*: ", ""))
    return render_markdown(spark, sf_dir).select("conv_id", F.array_join(bare, " ").alias("body")).where("body <> ''")


@query(
    "render_json",
    """SELECT conv_id, CAST(to_json({'conv_id': conv_id, 'total_turns': count(*), 'turns': list({'turn': turn, 'role': role, 'text': text} ORDER BY turn)}) AS VARCHAR) AS json FROM conversations GROUP BY conv_id""",
)
def render_json(spark, sf_dir):
    """One nested JSON record per conversation; absent keys are left out."""
    c = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    return c.select("conv_id", F.to_json(F.struct("conv_id", F.size("turns").alias("total_turns"), "turns")).alias("json"))


@query("marker_counts", r"SELECT doc_id, len(regexp_extract_all(text, '[0-9]+')) AS n_numbers, len(regexp_extract_all(text, '\p{Lu}\p{Ll}+')) AS n_names FROM documents WHERE text IS NOT NULL")
def marker_counts(spark, sf_dir):
    """How often patterns are found in each text."""
    d = table(spark, sf_dir, "documents").where("text is not null")
    return d.select("doc_id", F.regexp_count("text", F.lit(r"[0-9]+")).cast("long").alias("n_numbers"), F.size(F.regexp_extract_all("text", F.lit(r"\p{Lu}\p{Ll}+"), F.lit(0))).cast("long").alias("n_names"))


@query(
    "dialogue_breaks",
    f"""WITH last AS (SELECT conv_id, turn, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS n FROM conversations)
    SELECT conv_id, turn, CASE WHEN {t.ends_sentence_sql('text')} THEN 'block_end' ELSE 'page_end' END AS kind, right(text, 70) AS tail FROM last WHERE n = 1""",
)
def dialogue_breaks(spark, sf_dir):
    order = Window.partitionBy("conv_id").orderBy(F.desc("turn"))
    last = table(spark, sf_dir, "conversations").withColumn("n", F.row_number().over(order)).where("n = 1")
    return last.select("conv_id", "turn", F.when(t.ends_sentence(F.col("text")), "block_end").otherwise("page_end").alias("kind"), F.right("text", F.lit(70)).alias("tail"))


@query(
    "low_density",
    "SELECT doc_id, n_chars, CAST(len(string_split(text, chr(10))) AS BIGINT) AS n_lines FROM documents WHERE CAST(n_chars AS DOUBLE) / len(string_split(text, chr(10))) < 120",
)
def low_density(spark, sf_dir):
    n = F.size(F.split("text", "\n")).cast("long")
    return table(spark, sf_dir, "documents").where(F.col("n_chars").cast("double") / n < 120).select("doc_id", "n_chars", n.alias("n_lines"))


@query(
    "location_counts",
    "SELECT conv_id, count(*) FILTER (WHERE role = 'user') AS n_user, count(*) FILTER (WHERE role = 'assistant') AS n_assistant, count(*) FILTER (WHERE role NOT IN ('user', 'assistant')) AS n_other FROM conversations GROUP BY conv_id",
)
def location_counts(spark, sf_dir):
    role = F.col("role")
    return table(spark, sf_dir, "conversations").groupBy("conv_id").agg(
        F.count_if(role == "user").alias("n_user"), F.count_if(role == "assistant").alias("n_assistant"), F.count_if(~role.isin("user", "assistant")).alias("n_other")
    )
