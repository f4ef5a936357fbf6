"""Personal data spans by weak supervision, in DataFrame functions only.

Candidates are the spans of base patterns (e-mail, IP address, card and phone number), near misses of their checks,
local phone numbers and titled names. Labelers vote on each: the pattern and its checksum, gazetteers, words of the
context, the boundary. Votes are counted by pattern, a table whose size is bounded by the number of labelers;
expectation-maximisation over it estimates how reliable each labeler is, and its posteriors train the final span
classifier, a logistic model. The model's weights are then constants of one projection over the documents, so texts
are never shuffled. Spans of the base patterns stay in any case; others are added when the classifier accepts them.

Offsets count code points; a span's end is exclusive.

Defined results: a null text is empty; a text without spans has counts of 0 and an empty list; rows of one id stay
rows of their own; without any candidates the prior weights hold; an empty table gives no rows. Columns of other names
are kept by ``find_spans``, whose own columns start with two underscores.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Patterns of the base kinds. The look-behinds and possessive quantifiers only save work: a match that
# starts within a run of its characters would end where the run's own match ends.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}"
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,18}+(?![\x20-]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
LOCAL_PHONE = r"(?<![0-9A-Za-z+])(?:\([0-9]{3}\)\x20?|[0-9]{3}[.\x20-])[0-9]{3}[.\x20-][0-9]{4}(?![0-9A-Za-z])"
NAME = r"(?<![A-Za-z])(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Monsieur|Madame|Señor|Señora)\.?\x20\p{Lu}\p{Ll}++(?:\x20\p{Lu}\p{Ll}++)?"
KINDS = ["email", "ip", "card", "phone", "local_phone", "name"]
TITLES = ["Mr", "Ms", "Dr", "Prof", "Herr", "Frau", "Monsieur", "Madame", "Señor"]
TLDS = ["com", "org", "net", "edu", "gov", "io", "de", "fr", "es", "uk", "info", "eu"]
COUNTRY_CODES = ["1", "7", "20", "27", "30", "31", "32", "33", "34", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49", "52", "55", "61", "81", "82", "86", "91"]
FIRST_NAMES = ["Anna", "Carlos", "David", "Emma", "Hans", "Jean", "John", "Juan", "Julia", "Karl", "Laura", "Lucas", "Maria", "Marie", "Michael", "Paul", "Peter", "Pierre", "Robert", "Sarah", "Thomas"]
FOR_IT = r"(?i)(e-?mail|mail|contact|phone|tel|call|mobile|fax|card|visa|credit|kontakt|telefon|karte|courriel|carte|correo|tarjeta|address|adresse|host|name)\W{0,3}$"
AGAINST_IT = r"(?i)(version|release|isbn|issn|sku|order|invoice|figure|section|chapter|build)\W{0,3}$"
VOTES = ["v_pattern", "v_gazetteer", "v_context", "v_boundary"]
BLOCK = 256
CUT = 4096


def _digits(c: str) -> str:
    return f"regexp_replace({c}, '[^0-9]', '')"


def _luhn(c: str) -> str:
    digit = f"cast(substring(reverse({_digits(c)}), i, 1) as int)"
    doubled = f"{digit} * 2 - if({digit} > 4, 9, 0)"
    return f"aggregate(sequence(1, length({_digits(c)})), 0, (s, i) -> s + if(i % 2 = 0, {doubled}, {digit})) % 10 = 0"


def _matches(text: Column, kind: int, pattern: str, possible: Column, checked: str, gazetteer: str) -> tuple[Column, str]:
    """Candidates of a kind as structs; positions are sums of the lengths of what lies before, in blocks so that the
    work stays near linear for texts with very many matches."""
    between, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    both = F.when(possible, F.struct(between.alias("seg"), found.alias("hit")))
    # The one-element array binds the struct to a name, so that the patterns run once.
    expr = f"""
      flatten(transform(array(__x), x -> if(x is null or size(x.hit) = 0, cast(array() as array<{SPAN}>), flatten(transform(array(
        transform(x.hit, (h, i) -> cast(length(h) + length(x.seg[i]) as bigint))), lens ->
        flatten(transform(array(aggregate(sequence(0, (size(lens) - 1) div {BLOCK}), array(0L), (a, b) ->
          array_append(a, element_at(a, -1) + aggregate(slice(lens, b * {BLOCK} + 1, {BLOCK}), 0L, (s, n) -> s + n)))), base ->
        transform(transform(x.hit, (h, i) -> struct(h as h, i as i,
          base[i div {BLOCK}] + aggregate(slice(lens, (i div {BLOCK}) * {BLOCK} + 1, i % {BLOCK}), 0L, (s, n) -> s + n) + length(x.seg[i]) as s,
          right(x.seg[i], 24) as before, left(x.seg[i + 1], 1) as after)), y ->
        named_struct('start', y.s, 'kind', {kind}, 'end', y.s + length(y.h),
          'v_pattern', {checked}, 'v_gazetteer', {gazetteer},
          'v_context', case when y.before rlike r'{FOR_IT}' then 1 when y.before rlike r'{AGAINST_IT}' then -1 else 0 end,
          'v_boundary', if(y.before rlike r'[\\p{{L}}\\p{{N}}_]$' or y.after rlike r'^[\\p{{L}}\\p{{N}}_]', -1, 1),
          'size', least(3, length(y.h) div 8))))))))))
    """
    return both, expr


SPAN = "struct<start:bigint,kind:int,end:bigint,v_pattern:int,v_gazetteer:int,v_context:int,v_boundary:int,size:int>"


def candidates(rows: DataFrame, text_col: str) -> DataFrame:
    """``rows`` with ``__spans``: all candidates of a text in order of start, then kind."""
    quoted = lambda names: ", ".join(f"'{n}'" for n in names)
    text = F.col("__text")
    any_of = lambda words: reduce(lambda a, b: a | b, [F.contains(text, F.lit(w)) for w in words])
    plans = [
        (EMAIL, F.contains(text, F.lit("@")), "1", f"if(regexp_extract(y.h, '[^.]+$', 0) in ({quoted(TLDS)}), 1, 0)"),
        (IP, text.rlike(r"[0-9]\.[0-9]"), "if(forall(split(y.h, '[.]'), p -> length(ltrim('0', p)) <= 3 and cast(right(p, 4) as int) <= 255), 1, -1)", "if(split(y.h, '[.]')[0] in ('0', '127', '255'), -1, 0)"),
        (CARD, text.rlike(r"[0-9](?:[\x20-]?[0-9]){13}"), f"if({_luhn('y.h')}, 1, -1)", "if(left(y.h, 1) in ('3', '4', '5', '6'), 1, -1)"),
        (PHONE, F.contains(text, F.lit("+")), f"if(length({_digits('y.h')}) between 10 and 15, 1, -1)", f"if(exists(array(1, 2), k -> substring(y.h, 2, k) in ({quoted(COUNTRY_CODES)})), 1, 0)"),
        (LOCAL_PHONE, text.rlike(r"[0-9]{3}[.\x20-][0-9]{4}"), "if(left(y.h, 1) = '(', 1, 0)", "if(right(y.h, 4) = '0000', -1, 0)"),
        (NAME, any_of(TITLES), "if(size(split(y.h, ' ')) > 2, 1, 0)", f"if(exists(split(y.h, ' '), w -> w in ({quoted(FIRST_NAMES)})), 1, 0)"),
    ]
    out = rows.withColumn("__text", F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    parts = []
    for kind, (pattern, possible, checked, gazetteer) in enumerate(plans):
        both, expr = _matches(text, kind, pattern, possible, checked, gazetteer)
        out = out.withColumn(f"__x{kind}", both)
        parts.append(F.expr(expr.replace("__x", f"__x{kind}")))
    out = out.withColumn("__all", F.concat(*parts)).drop(*[f"__x{k}" for k in range(len(plans))])
    # Added candidates must not touch a base span. Base spans of a kind lie apart and in order, so of each kind only the
    # last that starts before the candidate's end can: a binary search.
    middle = "cast((a.lo + a.hi) div 2 as int)"
    before = f"""aggregate(sequence(0, cast(ceil(log2(size(b) + 1)) as int)), named_struct('lo', 0, 'hi', size(b)), (a, i) ->
      if(a.lo >= a.hi, a, if(b[{middle}].start < s.end, named_struct('lo', {middle} + 1, 'hi', a.hi), named_struct('lo', a.lo, 'hi', {middle}))), a -> a.lo)"""
    clear = f"""transform(array(transform(array(0, 1, 2, 3), k -> filter(__all, s -> s.v_pattern = 1 and s.kind = k))), held ->
      filter(__all, s -> (s.v_pattern = 1 and s.kind < 4) or not exists(held, b -> coalesce(get(b, {before} - 1).end > s.start, false))))[0]"""
    return out.withColumn("__spans", F.when(F.size("__all") > 0, F.expr(f"array_sort({clear})")).otherwise(F.col("__all"))).drop("__all")


def estimate(patterns: list[tuple[tuple[int, ...], float]], rounds: int = 40) -> tuple[list[dict[int, tuple[float, float]]], list[float], float]:
    """Expectation-maximisation over vote patterns with counts: for each labeler the chance of each vote given a false
    or a true span, the posterior of each pattern, and the share of true spans. The start trusts each labeler a little."""
    k = len(VOTES)
    table = [{-1: (0.5, 0.1), 0: (0.3, 0.3), 1: (0.2, 0.6)} for _ in range(k)]
    prior, post = 0.5, [0.5] * len(patterns)
    for _ in range(rounds):
        for n, (votes, _) in enumerate(patterns):
            yes, no = math.log(prior), math.log(1 - prior)
            for j, v in enumerate(votes):
                no, yes = no + math.log(table[j][v][0]), yes + math.log(table[j][v][1])
            post[n] = 1 / (1 + math.exp(min(50, max(-50, no - yes))))
        total = sum(c for _, c in patterns)
        true = sum(c * p for (_, c), p in zip(patterns, post, strict=True))
        prior = min(0.99, max(0.01, (true + 1) / (total + 2)))
        for j in range(k):
            for v in (-1, 0, 1):
                no = sum(c * (1 - p) for (votes, c), p in zip(patterns, post, strict=True) if votes[j] == v)
                yes = sum(c * p for (votes, c), p in zip(patterns, post, strict=True) if votes[j] == v)
                table[j][v] = ((no + 1) / (total - true + 3), (yes + 1) / (true + 3))
    return table, post, prior


FEATURES = ["one", *[f"kind{k}" for k in range(len(KINDS))], "pattern+", "pattern-", "gazetteer+", "gazetteer-", "context+", "context-", "boundary-", "long"]


def features(kind: int, votes: tuple[int, ...], size: int) -> list[float]:
    signs = [float(x) for v in votes[:3] for x in (v > 0, v < 0)]
    return [1.0, *[float(kind == k) for k in range(len(KINDS))], *signs, float(votes[3] < 0), size / 3]


def train(rows: list[tuple[int, tuple[int, ...], int, float, float]], rounds: int = 200, ridge: float = 0.01) -> list[float]:
    """Logistic weights from (kind, votes, size, count, posterior) by gradient steps with momentum."""
    w, speed = [0.0] * len(FEATURES), [0.0] * len(FEATURES)
    total = sum(r[3] for r in rows)
    # A rare pattern counts by the root of its number, or the commonest would be all there is to learn.
    data = [(features(k, v, s), math.sqrt(c), p) for k, v, s, c, p in rows]
    weight = sum(c for _, c, _ in data)
    for _ in range(rounds if total else 0):
        slope = [ridge * x for x in w]
        for x, c, p in data:
            z = sum(a * b for a, b in zip(w, x, strict=True))
            e = (1 / (1 + math.exp(-max(-50, min(50, z)))) - p) * c / weight
            for j, xj in enumerate(x):
                if xj:
                    slope[j] += e * xj
        speed = [0.9 * s - 0.5 * g for s, g in zip(speed, slope, strict=True)]
        w = [a + b for a, b in zip(w, speed, strict=True)]
    return w


def fit(spans: DataFrame) -> list[float]:
    """Weights of the span classifier from the candidates of all documents."""
    s = spans.select(F.explode("__spans").alias("s")).select("s.kind", *[f"s.{v}" for v in VOTES], "s.size")
    counted = s.groupBy("kind", *VOTES, "size").agg(F.count(F.lit(1)).alias("n")).collect()  # at most 6 * 81 * 4 rows
    rows = sorted((r["kind"], tuple(r[v] for v in VOTES), r["size"], float(r["n"])) for r in counted)
    if not rows:
        return [-2.0] + [0.0] * (len(FEATURES) - 1)
    _, post, _ = estimate([(r[1], r[3]) for r in rows])
    return train([(*r, p) for r, p in zip(rows, post, strict=True)])


def _score(w: list[float]) -> str:
    f = dict(zip(FEATURES, (repr(float(x)) for x in w), strict=True))
    signs = "".join(f" + if(s.v_{n} > 0, {f[n + '+']}D, 0D) + if(s.v_{n} < 0, {f[n + '-']}D, 0D)" for n in ("pattern", "gazetteer", "context"))
    kinds = "".join(f" when {k} then {f[f'kind{k}']}D" for k in range(len(KINDS)))
    return f"1D / (1D + exp(-({f['one']}D + case s.kind{kinds} end{signs} + if(s.v_boundary < 0, {f['boundary-']}D, 0D) + s.size / 3D * {f['long']}D)))"


def find_spans(spark: SparkSession, documents: DataFrame, *, text_col: str = "text", accept: float = 0.65) -> DataFrame:
    """``documents`` with ``__spans`` (base and accepted spans: start, kind, end, base, score) and ``__text``."""
    found = candidates(documents, text_col)
    w = fit(found.select("__spans"))
    base = "s.v_pattern = 1 and s.kind < 4"
    # A near miss of a check trains the classifier as a likely false span, and is never added.
    scored = f"transform(filter(__spans, s -> s.v_pattern >= 0), s -> named_struct('start', s.start, 'kind', s.kind, 'end', s.end, 'base', {base}, 'score', {_score(w)}))"
    return found.withColumn("__spans", F.expr(f"filter({scored}, s -> s.base or s.score >= {accept})"))


def _listed(only: str) -> Column:
    names = "array(" + ", ".join(f"'{k}'" for k in KINDS) + ")"
    return F.expr(f"array_join(transform(filter(__spans, s -> {only}), s -> concat({names}[s.kind], ':', s.start, ':', s.end)), ',')")


def redacted() -> Column:
    """The text with each span, or run of overlapping spans, replaced by its first kind in brackets.

    Where a run ends is the largest end so far, from blocks as in ``_matches``; the text is cut from pieces of CUT
    characters, since a cut costs what lies before it.
    """
    names = "array(" + ", ".join(f"'[{k.upper()}]'" for k in KINDS) + ")"
    largest = "(m, s) -> greatest(m, s.end)"
    tops = f"aggregate(sequence(0, (size(__spans) - 1) div {BLOCK}), array(0L), (a, b) -> array_append(a, aggregate(slice(__spans, cast(b * {BLOCK} + 1 as int), {BLOCK}), element_at(a, -1), {largest})))"
    end = f"aggregate(slice(__spans, cast((i div {BLOCK}) * {BLOCK} + 1 as int), i % {BLOCK}), tops[cast(i div {BLOCK} as int)], {largest})"
    pieces = f"transform(sequence(0, length(__text) div {CUT}), k -> substring(__text, cast(k * {CUT} + 1 as int), {CUT}))"
    cut = lambda a, b: (
        f"if({a} >= {b}, '', array_join(transform(sequence({a} div {CUT}, ({b} - 1) div {CUT}), k -> substring(pieces[cast(k as int)],"
        f" cast(greatest({a} - k * {CUT}, 0) + 1 as int), cast(least({b} - k * {CUT}, {CUT}) - greatest({a} - k * {CUT}, 0) as int))), ''))"
    )
    whole = f"""transform(array({pieces}), pieces -> transform(array({tops}), tops -> concat(
      array_join(transform(__spans, (s, i) -> transform(array({end}), e -> if(s.start < e, '', concat({cut("e", "s.start")}, {names}[s.kind])))[0]), ''),
      {cut("element_at(tops, -1)", "cast(length(__text) as bigint)")}))[0])[0]"""
    return F.when(F.size("__spans") > 0, F.expr(whole))


def redact(spark: SparkSession, documents: DataFrame, *, text_col: str = "text", n_chars_col: str | None = "n_chars") -> DataFrame:
    """``documents``, same columns and rows, with personal data in the text replaced by the names of its kinds."""
    found = find_spans(spark, documents, text_col=text_col)
    text = F.coalesce(redacted(), F.col(text_col))
    out = found.withColumn("__new", text)
    columns = []
    for c in documents.columns:
        if c == text_col:
            columns.append(F.col("__new").alias(c))
        elif c == n_chars_col:
            columns.append(F.when(F.size("__spans") > 0, F.length("__new").cast(documents.schema[c].dataType)).otherwise(F.col(c)).alias(c))
        else:
            columns.append(F.col(c))
    return out.select(*columns)


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_spans(spark, spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    count = lambda k: F.expr(f"cast(size(filter(__spans, s -> s.base and s.kind = {k})) as bigint)")
    return found.select(
        "doc_id", *[count(k).alias(f"n_{KINDS[k]}") for k in range(4)], F.sha2(_listed("s.base").cast("binary"), 256).alias("base_sha256"), _listed("true").alias("spans")
    )
