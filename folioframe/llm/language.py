"""Language of words and documents by a linear-chain conditional random field.

Each word has affix, n-gram, whole-word and lexicon features; transitions between the languages of neighbouring words
are learned with them, so that words of code-switched text get a language each by the forward-backward recursion. A
chain is a run of at most ``CHAIN`` words of one document. The document's language is the one of the largest mean
chance over all its words, its score that mean.

The model is fitted on a bounded sample: of each language the documents of least hash, at most ``PER_LANGUAGE`` and
``MOST_DOCUMENTS`` over the number of languages but one at least, of each at most ``CHAINS_PER_DOC`` pieces of ``CHAIN``
words spread over the text, without words above ``LONGEST`` bytes. Pieces are cut where the texts lie. Words of a
training document take its language. Of every third piece the words go, in short segments, into chains that join pieces
of different languages, from which the transitions learn how text switches. The table of weights has a fixed size:
beyond 64 languages each has fewer slots.

Defined results: a null text, or one without a letter, is ``und`` with score 0; documents without a language, or held
out, never train; with no training documents all are ``und``; a tie goes to the first language in order; rows of one
id are predicted one by one, a null id counts as the empty text for the fold; an empty table gives no rows. Other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folioframe.llm import textkernel as tk
from folioframe.llm.toxicity import _trim

BITS = 17
CHAIN = 64
PER_LANGUAGE, MOST_DOCUMENTS, CHAINS_PER_DOC, LONGEST = 500, 16_000, 8, 64
MIXED_EVERY, SEGMENT = 3, (3, 17)
AFFIXES = (1, 2, 3, 4)
LEXICON_LEAST, LEXICON_SHARE = 5, 0.7
UNKNOWN = "und"


def slot_bits(languages: int) -> int:
    """The bits of a slot's number, so that the table of weights keeps its size."""
    return max(8, BITS - max(0, (languages - 1).bit_length() - 6))


def word_features(raw: np.ndarray, offsets: np.ndarray, bits: int = BITS):
    """(slots, trigram of each byte position, word starts, word ends, first word of each text); a slot is a feature of a word, -1 if missing."""
    starts, ends, first = tk.words(raw, offsets)
    starts, ends = _trim(raw, starts, ends)
    hasher = tk.SpanHasher(raw)
    down = tk.U64(64 - bits)
    slots = [(hasher(starts, ends, 1) >> down).astype(np.int32)]
    for n in AFFIXES:
        ok = ends - starts >= n
        for kind, a, b in ((2, starts, starts + n), (3, ends - n, ends)):
            f = np.full(len(starts), -1, np.int32)
            f[ok] = (hasher(a[ok], b[ok], kind) >> down).astype(np.int32)
            slots.append(f)
    low = tk.LOWER[raw].astype(np.uint32)
    tri = np.zeros(len(raw), np.int32)
    if len(raw) >= 3:
        code = low[:-2] * np.uint32(0x01000193) + low[1:-1] * np.uint32(0x85EBCA6B) + low[2:] * np.uint32(0xC2B2AE35)
        code ^= code >> np.uint32(15)
        tri[:-2] = (code * np.uint32(0x2C1B3C6D)) >> np.uint32(32 - bits)
    return np.stack(slots), tri, starts, ends, first


def emissions(raw: np.ndarray, offsets: np.ndarray, model: dict) -> tuple[np.ndarray, np.ndarray]:
    """Score of each word for each language, and the first word of each text."""
    w = model["weights"]
    slots, tri, starts, ends, first = word_features(raw, offsets, len(w).bit_length() - 1)
    out = np.zeros((len(starts), w.shape[1]), np.float32)
    for f in slots:
        out += w[f] * (f >= 0)[:, None]
    out += model["lexicon"][slots[0]]
    total = np.zeros((len(raw) + 1, w.shape[1]), np.float64)
    np.cumsum(model["trigrams"][tri], axis=0, out=total[1:])
    last = np.maximum(ends - 2, starts)
    out += (total[last] - total[starts]).astype(np.float32)
    return out, first


def chains(first: np.ndarray, length: int = CHAIN) -> tuple[np.ndarray, np.ndarray]:
    """(first word, words) of each chain; no chain crosses a text."""
    n = np.diff(first)
    parts = -(-n // length)
    begin = np.repeat(first[:-1], parts) + length * (np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts))
    return begin, np.minimum(length, np.repeat(first[1:], parts) - begin)


def forward_backward(scores: np.ndarray, begin: np.ndarray, size: np.ndarray, start: np.ndarray, step: np.ndarray):
    """(marginals of the words in order, expected transitions, expected starts) over all chains at once."""
    k = scores.shape[1]
    if not len(begin):
        return np.zeros((0, k)), np.zeros((k, k)), np.zeros(k)
    order = np.argsort(-size, kind="stable")
    begin, size = begin[order], size[order]
    longest = int(size[0])
    e = np.exp(scores - scores.max(1, keepdims=True))
    a, s = np.exp(step), np.exp(start - start.max())
    count = np.searchsorted(-size, -np.arange(1, longest + 1), side="right")  # chains still running at each step
    forward = np.zeros((longest, len(begin), k))
    for t in range(longest):
        m = count[t]
        here = e[begin[:m] + t] * (forward[t - 1, :m] @ a if t else s)
        forward[t, :m] = here / here.sum(1, keepdims=True)
    out = np.zeros((len(scores), k))
    back = np.ones((len(begin), k))
    moves = np.zeros((k, k))
    for t in range(longest - 1, -1, -1):
        m = count[t]
        p = forward[t, :m] * back[:m]
        out[begin[:m] + t] = p / p.sum(1, keepdims=True)
        if t:
            right = e[begin[:m] + t] * back[:m]
            left = right @ a.T
            total = (forward[t - 1, :m] * left).sum(1, keepdims=True)
            moves += (forward[t - 1, :m] / total).T @ right * a
            back[:m] = left / left.sum(1, keepdims=True)
    return out, moves, out[begin].sum(0)


def cut_pieces(raw: np.ndarray, offsets: np.ndarray) -> list[list[str]]:
    """Of each text at most CHAINS_PER_DOC pieces of CHAIN words, evenly spread."""
    starts, ends, first = tk.words(raw, offsets)
    short = ends - starts <= LONGEST
    before = np.concatenate(([0], np.cumsum(short)))
    starts, ends, first = starts[short], ends[short], before[first]
    begin, size = chains(first)
    doc = np.searchsorted(first, begin, side="right") - 1
    parts = np.bincount(doc, minlength=len(first) - 1)
    place = np.arange(len(begin)) - np.repeat(np.cumsum(parts) - parts, parts)
    use = place % np.maximum(1, -(-parts[doc] // CHAINS_PER_DOC)) == 0
    out: list[list[str]] = [[] for _ in range(len(first) - 1)]
    for d, a, n in zip(doc[use].tolist(), begin[use].tolist(), size[use].tolist(), strict=True):
        out[d].append(b" ".join(raw[x:y].tobytes() for x, y in zip(starts[a : a + n].tolist(), ends[a : a + n].tolist(), strict=True)).decode())
    return out


def training_order(begin: np.ndarray, size: np.ndarray, seed: int = 9) -> tuple[np.ndarray, np.ndarray]:
    """(words in their order of training, words of each chain): pieces as they are, but for every third, whose words go in
    segments into chains of many pieces."""
    rng = np.random.default_rng(seed)
    order, sizes, segments = [], [], []
    for k, (a, n) in enumerate(zip(begin.tolist(), size.tolist(), strict=True)):
        if k % MIXED_EVERY:
            order.append(np.arange(a, a + n))
            sizes.append(n)
        else:
            while n:
                m = min(n, int(rng.integers(*SEGMENT)))
                segments.append(np.arange(a, a + m))
                a, n = a + m, n - m
    held = 0
    for k in rng.permutation(len(segments)).tolist():
        order.append(segments[k])
        held += len(segments[k])
        if held >= CHAIN:
            sizes.append(held)
            held = 0
    if held:
        sizes.append(held)
    return np.concatenate(order) if order else np.zeros(0, np.int64), np.array(sizes, np.int64)


def fit(texts: list[str], languages: list[str], rounds: int = 30, rate: float = 0.15, ridge: float = 1e-5) -> dict:
    """Weights by full-batch Adam steps on the likelihood of the chains; ``texts`` are pieces of one language each."""
    names = sorted(set(languages))
    k = len(names)
    bits = slot_bits(k)
    label_of = {n: j for j, n in enumerate(names)}
    slots, grams, gram_word, labels, begins, sizes, base = [], [], [], [], [], [], 0
    for row, raw, offsets in tk.chunks(pa.array(texts, pa.string())):
        s, tri, starts, ends, first = word_features(raw, offsets, bits)
        begin, size = chains(first)
        slots.append(s)
        n = np.maximum(0, ends - 2 - starts)
        at = np.repeat(starts - np.cumsum(n) + n, n) + np.arange(n.sum())
        grams.append(tri[at])
        gram_word.append(np.repeat(np.arange(len(starts)), n) + base)
        begins.append(begin + base)
        sizes.append(size)
        labels.append(np.repeat([label_of[x] for x in languages[row : row + len(first) - 1]], np.diff(first)))
        base += len(starts)
    slots, grams, gram_word = np.concatenate(slots, 1), np.concatenate(grams), np.concatenate(gram_word)
    order, size = training_order(np.concatenate(begins), np.concatenate(sizes))
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    slots, gram_word, labels = slots[:, order], place[gram_word], np.concatenate(labels).astype(np.int64)[order]
    begin = np.cumsum(size) - size
    n = len(labels)
    # Features met once or twice say nothing of the language; all that is fitted is renumbered without gaps.
    word_feats = [f for f in slots]
    feat = np.concatenate([f[f >= 0] for f in word_feats])
    word = np.concatenate([np.flatnonzero(f >= 0) for f in word_feats])
    seen = np.bincount(feat, minlength=1 << bits)
    ok = seen[feat] >= 3
    feat, word = feat[ok], word[ok]
    gseen = np.bincount(grams, minlength=1 << bits)
    ok = gseen[grams] >= 3
    grams, gram_word = grams[ok], gram_word[ok]
    share = np.stack([np.bincount(slots[0], weights=labels == j, minlength=1 << bits) for j in range(k)], 1)
    total = share.sum(1)
    member = (total[:, None] >= LEXICON_LEAST) & (share >= LEXICON_SHARE * np.maximum(total, 1)[:, None])
    in_lexicon = member[slots[0]].astype(np.float64)
    u, feat = np.unique(feat, return_inverse=True)
    g, grams = np.unique(grams, return_inverse=True)
    shape = [(len(u), k), (len(g), k), (k, k), (k,), (k,)]  # weights, trigrams, transitions, starts, lexicon
    params = [np.zeros(x) for x in shape]
    first, second = [np.zeros(x) for x in shape], [np.zeros(x) for x in shape]
    gold = np.zeros((n, k))
    gold[np.arange(n), labels] = 1
    inner = np.ones(n, bool)
    inner[begin] = False
    pairs = np.zeros((k, k))
    np.add.at(pairs, (labels[:-1][inner[1:]], labels[1:][inner[1:]]), 1)
    begun = gold[begin].sum(0)
    for r in range(1, rounds + 1):
        w, wt, a, s, lex = params
        scores = in_lexicon * lex
        for j in range(k):
            scores[:, j] += np.bincount(word, weights=w[feat, j], minlength=n) + np.bincount(gram_word, weights=wt[grams, j], minlength=n)
        p, moves, starts = forward_backward(scores, begin, size, s, a)
        e = p - gold
        slopes = [
            np.stack([np.bincount(feat, weights=e[word, j], minlength=len(u)) for j in range(k)], 1) / n + ridge * w,
            np.stack([np.bincount(grams, weights=e[gram_word, j], minlength=len(g)) for j in range(k)], 1) / n + ridge * wt,
            (moves - pairs) / n + 1e-3 * a,
            (starts - begun) / n + 1e-3 * s,
            (e * in_lexicon).sum(0) / n + 1e-3 * lex,
        ]
        for j, d in enumerate(slopes):
            first[j], second[j] = 0.9 * first[j] + 0.1 * d, 0.99 * second[j] + 0.01 * d * d
            params[j] = params[j] - rate * (first[j] / (1 - 0.9**r)) / (np.sqrt(second[j] / (1 - 0.99**r)) + 1e-8)
    w, wt, a, s, lex = params
    weights, trigrams = np.zeros((1 << bits, k), np.float32), np.zeros((1 << bits, k), np.float32)
    weights[u], trigrams[g] = w, wt
    return {"names": names, "weights": weights, "trigrams": trigrams, "lexicon": (member * lex).astype(np.float32), "step": a, "start": s}


def tag(texts: pa.Array, model: dict) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first text, chance of each language for each word, first word of each text), slice by slice."""
    for row, raw, offsets in tk.chunks(texts):
        scores, first = emissions(raw, offsets, model)
        p, _, _ = forward_backward(scores.astype(np.float64), *chains(first), model["start"], model["step"])
        yield row, p, first


def _predict(model: dict | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            letters = batch.column(3).to_numpy(zero_copy_only=False)
            names, scores = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows)
            for row, p, first in tag(batch.column(2), model) if model else ():
                total = np.zeros((len(first), p.shape[1]))
                sums = np.concatenate((np.zeros((1, p.shape[1])), np.cumsum(p, axis=0)))
                total = sums[first[1:]] - sums[first[:-1]]
                n = np.diff(first)
                for k in np.flatnonzero((n > 0) & letters[row : row + len(n)]).tolist():
                    best = int(np.argmax(total[k]))
                    names[row + k] = model["names"][best]
                    scores[row + k] = min(1.0, max(0.0, total[k, best] / n[k]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(scores)], names=["doc_id", "held_out", "lang_pred", "score"])

    return run


def held_out(key: Column) -> Column:
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def sample(documents: DataFrame, id_col: str, text_col: str, lang_col: str) -> pd.DataFrame:
    """(lang, piece) of the training documents, in a defined order."""
    usable = documents.where(~held_out(F.col(id_col)) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    usable = usable.select(F.col(id_col).cast("string").alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")).withColumn("h", F.xxhash64("text"))
    ids = usable.select("id", "lang", "h").distinct()
    languages = ids.select("lang").distinct().count()
    quota = min(PER_LANGUAGE, max(1, MOST_DOCUMENTS // max(1, languages)))
    # The least hashes of each language. Of large ones only ids with a hash low enough for about four times as many are
    # ranked, so that what meets in a task does not go with the input.
    sizes = ids.groupBy("lang").agg(F.count(F.lit(1)).alias("size"))
    low = ids.join(sizes, "lang").where((F.col("size") <= 16 * quota) | (F.pmod(F.xxhash64("id"), F.lit(1 << 40)) * F.col("size") < 4.0 * quota * (1 << 40)))
    few = low.select("id", "lang", "h").withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy(F.pmod(F.xxhash64("id"), F.lit(1 << 40)), "id", "h"))).where(F.col("n") <= quota).drop("n")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for _, raw, offsets in tk.chunks(b.column(3)):
                out += cut_pieces(raw, offsets)
            at = pa.array(np.repeat(np.arange(len(out)), [len(x) for x in out]))
            number, piece = [n for x in out for n in range(len(x))], [p for x in out for p in x]
            yield pa.RecordBatch.from_arrays([*(b.column(c).take(at) for c in range(3)), pa.array(number, pa.int32()), pa.array(piece, pa.string())], names=["id", "lang", "h", "number", "piece"])

    # Null ids are ids like others here, so the sides meet null-safe.
    chosen = few.select(F.coalesce("id", F.lit("")).alias("k"), F.col("id").isNull().alias("no_id"), F.col("lang").alias("l"), F.col("h").alias("g"))
    same = (F.coalesce("id", F.lit("")) == F.col("k")) & (F.col("id").isNull() == F.col("no_id")) & (F.col("lang") == F.col("l")) & (F.col("h") == F.col("g"))
    texts = usable.join(F.broadcast(chosen), same, "left_semi").select("id", "lang", "h", "text")
    pieces = texts.mapInArrow(cut, "id string, lang string, h long, number int, piece string").dropDuplicates(["id", "lang", "h", "number"])
    return pieces.toPandas().sort_values(["id", "h", "number", "lang"], kind="stable")


def identify(spark: SparkSession, documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Per row: doc_id, held_out, lang_pred and score."""
    rows = sample(documents, id_col, text_col, lang_col)
    model = fit(rows["piece"].tolist(), rows["lang"].tolist()) if len(rows) else None
    text = F.col(text_col).cast("string")
    own = documents.select(F.col(id_col).cast("long").alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), text.alias("text"), F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("letters"))
    return own.mapInArrow(_predict(model), "doc_id long, held_out boolean, lang_pred string, score double")


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))
