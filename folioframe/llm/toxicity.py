"""Toxicity grades by cumulative-link ordinal regression over sparse word features.

P(grade >= k) = sigmoid(w . x - t_k): one weight vector for all thresholds, and thresholds in ascending order by
construction (t_k is t_1 plus positive steps). The likelihood of a grade is the difference of its two neighbouring
sigmoids. Features are hashed lower-cased words and their first bytes (a stem, for languages that inflect), present or
absent; those of fewer than MIN_DOCS sampled documents, or within LEAST_DEVIATION standard deviations of the mean grade,
are left out. The model is fitted on a bounded sample of labelled documents (``sample`` ids, those of least hash, each
with one text); features are cut where the texts lie, and only the chosen ones of each document reach the driver, at most
``sample`` times MOST_FEATURES numbers. Documents are scored where they lie, over their whole text.

Defined results: a null or empty text has the grade that the thresholds alone give; a document with several labels
counts with the highest grade, an id with several texts trains with that of least hash; labels with a null grade, and
labels without a document, are left out; with no usable labels every severity is 0; an expected grade between two
grades gives a severity, the grade itself is the number of thresholds reached at even chance, a tie counting as
reached; rows of one id are scored one by one; an empty table gives no rows. ``score_documents`` keeps other columns, its
own start with two underscores.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioframe.llm import textkernel as tk
from folioframe.scratch import Scratch

BITS = 18
SAMPLE, MOST_FEATURES = 8_000, 1 << 14
STEMS = (4, 5, 6)
MIN_DOCS = 4
LEAST_DEVIATION = 4.0


def word_sets(raw: np.ndarray, offsets: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(text number, feature) of the different words of each text, in order of text."""
    starts, ends, first = tk.words(raw, offsets)
    starts, ends = _trim(raw, starts, ends)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(first)) << bits
    found = [text | (tk.span_hashes(raw, starts, ends) >> tk.U64(64 - bits)).astype(np.int64)]
    for n in STEMS:
        longer = ends - starts >= n
        a = starts[longer]
        h = tk.mix(tk.span_hashes(raw, a, a + n) ^ tk.U64(n)) >> tk.U64(64 - bits)
        found.append(text[longer] | h.astype(np.int64))
    both = np.unique(np.concatenate(found))
    return both >> bits, both & ((1 << bits) - 1)


_PUNCTUATION = np.zeros(256, dtype=bool)
_PUNCTUATION[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True


def _trim(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word bounds without ASCII punctuation at either end; a word of nothing else keeps its bounds."""
    solid = np.flatnonzero(~_PUNCTUATION[raw])
    if not len(solid) or not len(starts):
        return starts, ends
    a = np.searchsorted(solid, starts)
    b = np.searchsorted(solid, ends) - 1
    ok = b >= a
    a, b = np.minimum(a, len(solid) - 1), np.maximum(b, 0)
    return np.where(ok, solid[a], starts), np.where(ok, solid[b] + 1, ends)


def ordinal_slopes(z: np.ndarray, t: np.ndarray, grades: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """The negative logarithm of the cumulative-link likelihood, and its slopes in each z and each threshold."""
    reached = 1 / (1 + np.exp(-np.clip(z[:, None] - t, -40, 40)))
    edges = np.column_stack((np.ones(len(z)), reached, np.zeros(len(z))))  # P(grade >= k) for k from 0 to one past the top
    row = np.arange(len(z))
    low, high = edges[row, grades], edges[row, grades + 1]
    p = np.maximum(low - high, 1e-15)
    slope_t = np.zeros((len(t) + 2))
    np.add.at(slope_t, grades, low * (1 - low) / p)
    np.add.at(slope_t, grades + 1, -high * (1 - high) / p)
    return float(-np.log(p).sum()), low + high - 1, slope_t[1:-1]


def fit_ordinal(doc: np.ndarray, feat: np.ndarray, n_features: int, grades: np.ndarray, rounds: int = 400, rate: float = 0.3, ridge: float = 1e-5) -> tuple[np.ndarray, np.ndarray]:
    """(weights, thresholds) of the pairs (document, feature) by full-batch Adam steps on the ordinal likelihood."""
    n, top = len(grades), int(grades.max())
    share = np.array([np.clip((grades >= k).mean(), 1e-3, 1 - 1e-3) for k in range(1, top + 1)])
    cuts = -np.log(share / (1 - share))
    params = np.concatenate((np.zeros(n_features), [cuts[0]], np.log(np.maximum(np.diff(cuts), 0.05))))
    m, v = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, rounds + 1):
        w, steps = params[:n_features], np.exp(params[n_features + 1 :])
        t = params[n_features] + np.concatenate(([0.0], np.cumsum(steps)))
        z = np.bincount(doc, weights=w[feat], minlength=n)
        _, g_z, g_t = ordinal_slopes(z, t, grades)
        tail = np.cumsum(g_t[::-1])[::-1] / n
        g = np.concatenate((np.bincount(feat, weights=g_z[doc], minlength=n_features) / n + ridge * w, [tail[0]], tail[1:] * steps))
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        params = params - rate * (0.1 if step > rounds // 2 else 0.3) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return params[:n_features], params[n_features] + np.concatenate(([0.0], np.cumsum(np.exp(params[n_features + 1 :]))))


def _counted(bits: int):
    """(feature, texts, texts above grade 0) over the texts of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, toxic = np.zeros(1 << bits, np.int64), np.zeros(1 << bits, np.int64)
        for b in batches:
            graded = b.column(1).to_numpy(zero_copy_only=False) > 0
            for first, raw, offsets in tk.chunks(b.column(2)):
                d, f = word_sets(raw, offsets, bits)
                count += np.bincount(f, minlength=1 << bits)
                toxic += np.bincount(f[graded[d + first]], minlength=1 << bits)
        met = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(count[met]), pa.array(toxic[met])], names=["feature", "n", "toxic"])

    return run


def _chosen_of(used: np.ndarray, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = np.full(1 << bits, -1, np.int32)
        place[used] = np.arange(len(used))
        for b in batches:
            own: list[bytes] = [b""] * b.num_rows
            for first, raw, offsets in tk.chunks(b.column(2)):
                d, f = word_sets(raw, offsets, bits)
                keep = place[f] >= 0
                d, f = d[keep], place[f[keep]]
                cut = np.searchsorted(d, np.arange(len(offsets)))
                for k in range(len(offsets) - 1):
                    own[first + k] = f[cut[k] : cut[k + 1]].tobytes()
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(own, pa.binary())], names=["id", "grade", "features"])

    return run


def chances(raw: np.ndarray, offsets: np.ndarray, weights: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """P(grade >= k) for each text (rows) and k from 1."""
    doc, feat = word_sets(raw, offsets, int(np.log2(len(weights))))
    z = np.bincount(doc, weights=weights[feat].astype(np.float64), minlength=len(offsets) - 1)
    return 1 / (1 + np.exp(-np.clip(z[:, None] - cuts, -40, 40)))


def _score(text_at: int, weights: np.ndarray, cuts: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            severity, toxic = np.zeros(batch.num_rows), np.zeros(batch.num_rows)
            grade = np.zeros(batch.num_rows, np.int64)
            for first, raw, offsets in tk.chunks(batch.column(text_at)) if len(cuts) else ():
                p = chances(raw, offsets, weights, cuts)
                here = slice(first, first + len(p))
                severity[here], toxic[here], grade[here] = p.sum(1), p[:, 0], (p >= 0.5).sum(1)
            names = [*batch.schema.names, "__severity", "__toxic", "__grade"]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(severity), pa.array(toxic), pa.array(grade)], names=names)

    return run


def fit_on(spark: SparkSession, documents: DataFrame, labels: DataFrame, grade: Column, *, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray]:
    """Fits on at most ``sample`` labelled documents; the broadcast side has at most that many rows of two numbers."""
    scratch = Scratch(spark, "toxicity")
    chosen = labels.select(F.col(id_col).alias("__id"), grade.cast("int").alias("__grade")).where("__id is not null and __grade is not null and __grade >= 0")
    chosen = chosen.groupBy("__id").agg(F.max("__grade").alias("__grade")).orderBy(F.xxhash64("__id"), "__id").limit(sample)
    found = documents.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("__text")).join(F.broadcast(chosen), "__id")
    one = found.groupBy("__id", "__grade").agg(F.min_by("__text", F.struct(F.xxhash64("__text"), F.col("__text").isNull())).alias("__text"))
    rows = scratch.save(one.select(F.col("__id").cast("string").alias("id"), F.col("__grade").alias("grade"), "__text"))
    grades = {r["grade"]: r["count"] for r in rows.groupBy("grade").count().collect()}
    n, top = sum(grades.values()), max(grades, default=0)
    if top < 1:
        return np.zeros(1 << BITS, np.float32), np.zeros(0)
    # Words are many and documents few: only features whose share of graded documents is no matter of chance enter.
    base = min(max((n - grades.get(0, 0)) / n, 1e-3), 1 - 1e-3)
    counts = rows.mapInArrow(_counted(BITS), "feature long, n long, toxic long").groupBy("feature").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic"))
    deviation = F.abs((F.col("toxic") - base * F.col("n")) / F.sqrt(F.col("n") * (base * (1 - base))))
    best = counts.withColumn("far", deviation).where((F.col("n") >= min(MIN_DOCS, max(1, n // 50))) & (F.col("far") >= LEAST_DEVIATION)).orderBy(F.desc("far"), "feature").limit(MOST_FEATURES)
    used = np.sort(np.array([r["feature"] for r in best.select("feature").collect()], np.int64))
    held = rows.mapInArrow(_chosen_of(used, BITS), "id string, grade int, features binary").toPandas().sort_values("id", kind="stable")
    features = [np.frombuffer(x, np.int32) for x in held["features"]]
    doc = np.repeat(np.arange(len(held)), [len(x) for x in features])
    w, cuts = fit_ordinal(doc, np.concatenate(features).astype(np.int64), len(used), held["grade"].to_numpy(np.int64))
    out = np.zeros(1 << BITS, np.float32)
    out[used] = w
    return out, cuts


def score_documents(documents: DataFrame, model: tuple[np.ndarray, np.ndarray], *, text_col: str = "text") -> DataFrame:
    """``documents`` with ``__severity`` (expected grade), ``__toxic`` (chance of grade 1 or more) and ``__grade`` (most thresholds at even chance)."""
    own = documents.select(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(documents.columns)])
    at = documents.columns.index(text_col)
    fields = ", ".join(f"c{k} {f.dataType.simpleString()}" for k, f in enumerate(documents.schema.fields))
    out = own.mapInArrow(_score(at, *model), f"{fields}, __severity double, __toxic double, __grade long")
    return out.select(*[F.col(f"c{k}").alias(c) for k, c in enumerate(documents.columns)], "__severity", "__toxic", "__grade")


def label_grade() -> Column:
    """The grade that the labels table gives, which has no severity: 0 clean, 1 toxic, 2 toxic and of low quality."""
    return F.when(F.col("toxic") == 1, F.when(F.col("quality") == 0, 2).otherwise(1)).when(F.col("toxic") == 0, 0)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = fit_on(spark, documents, spark.read.parquet(f"{sf_dir}/labels.parquet"), label_grade())
    scored = score_documents(documents, model)
    return scored.select(
        "doc_id",
        F.col("__grade").alias("grade"),
        F.col("__severity").alias("expected_severity"),
        F.col("__toxic").alias("p_toxic"),
        (F.col("__grade") >= 1).alias("toxic"),
    )
