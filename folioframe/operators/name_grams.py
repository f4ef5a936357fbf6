"""Names sought in texts by the grams they share: joins that grow with the hits, not with names times texts.

A run of words of at least the wanted ratio keeps most of a name's characters in their order, and so a known number of
the name's grams (stretches of q characters): with ``M`` common characters of ``la`` and ``lb``, deleting one breaks at most
q grams and inserting one at most q - 1, which leaves ``(2q - 1) M - (q - 1) (la + lb + 1)``. If at least ``need`` of G grams
stay, then of any G - need + 3 of them 3 stay. So each name is listed under its rarest grams only, texts give the places
of listed grams, and a place in a text is compared with a name only where enough of these meet within the longest run
that could be similar. Which grams are rare is counted over all texts, in counters of a fixed number; which are listed
is a bitmap of a fixed size.

Defined results: null and empty names and null texts match nothing; equal rows of texts count once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from difflib import SequenceMatcher
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from folioframe.operators import name_pieces
from folioframe.scratch import Scratch

COUNTER_BITS, LISTED_BITS = 16, 22
AT_ONCE = 1 << 20
TOGETHER = 4
BLOCK = 4096
MASK_BITS = 62
_MIX = np.uint64(0x9E3779B97F4A7C15)
_RANK = ("ratio", "same", "size", "at", "run", "shown")
_HIT = "text_id long, ratio double, same boolean, size int, at long, run string, shown double"


def normal(text: Column) -> Column:
    """Lower case, words parted by single spaces."""
    return F.trim(F.regexp_replace(F.lower(text), r"(?U)[\s\x1C-\x1F]+", " "))


def points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)


def grams(chars: np.ndarray, q: int) -> np.ndarray:
    """The stretches of q characters (at most three), each as one number."""
    n = len(chars) - q + 1
    out = np.zeros(max(n, 0), dtype=np.uint64)
    for k in range(q if n > 0 else 0):
        out = out << np.uint64(21) | chars[k : k + n]
    return out


def slots(codes: np.ndarray, bits: int) -> np.ndarray:
    return ((codes * _MIX) >> np.uint64(64 - bits)).astype(np.int64)


def kept_grams(la: int, lb: np.ndarray, q: int, threshold: float) -> int:
    """The least number of grams that stay for runs of these lengths."""
    common = np.ceil(threshold * (la + lb) / 2 - 1e-9)
    return int(((2 * q - 1) * common - (q - 1) * (la + lb + 1)).min())


def listing(name: str, threshold: float, rarity: np.ndarray) -> tuple[int, np.ndarray, np.ndarray, int, int]:
    """(q, grams listed, offsets, how many different ones must meet, longest run) of a name."""
    chars = points(name)
    la = len(chars)
    longest = math.floor(la * (2 - threshold) / threshold + 1e-9)
    lb = np.arange(max(1, math.ceil(la * threshold / (2 - threshold) - 1e-9)), longest + 1)
    q = next(q for q in (3, 2, 1) if la >= q and (q == 1 or kept_grams(la, lb, q, threshold) >= 1))
    codes = grams(chars, q)
    need = min(max(1, kept_grams(la, lb, q, threshold)), len(codes))
    order = np.lexsort((codes, rarity[slots(codes, COUNTER_BITS)]))
    together = min(TOGETHER, need)
    own = order[: len(codes) - need + together]
    _, first, times = np.unique(codes[own], return_index=True, return_counts=True)
    if len(first) > MASK_BITS:
        together = 1
        own = order[: len(codes) - need + 1]
        _, first, times = np.unique(codes[own], return_index=True, return_counts=True)
    # So many different grams at least make up ``together`` places, were the commonest ones among them.
    different = int(np.searchsorted(np.cumsum(np.sort(times)[::-1]), together)) + 1
    return q, codes[own][first], own[first], different, longest


def promising(name: str, pieces: list[str], threshold: float) -> np.ndarray:
    """Which pieces have, within the longest run that could be similar, places enough with a gram of the name."""
    chars = points(name)
    la = len(chars)
    longest = math.floor(la * (2 - threshold) / threshold + 1e-9)
    lb = np.arange(max(1, math.ceil(la * threshold / (2 - threshold) - 1e-9)), longest + 1)
    width = max(map(len, pieces), default=0)
    text = np.zeros((len(pieces), width), dtype=np.uint64)
    for row, piece in zip(text, pieces, strict=True):
        row[: len(piece)] = points(piece)
    good = np.ones(len(pieces), dtype=bool)
    for q in (3, 2):
        need = kept_grams(la, lb, q, threshold) if la >= q else 0
        if need < 1 or width < q:
            continue
        n, reach = width - q + 1, longest - q + 1
        codes = np.zeros((len(pieces), n), dtype=np.uint64)
        for k in range(q):
            codes = codes << np.uint64(21) | text[:, k : k + n]
        upto = np.zeros((len(pieces), n + reach), dtype=np.int32)
        upto[:, reach:] = np.cumsum(np.isin(codes, grams(chars, q)), axis=1)
        good &= (upto[:, reach:] - upto[:, :n]).max(axis=1) >= need
    return good


def _rarity(texts: DataFrame) -> np.ndarray:
    """How often the grams of each counter occur in all texts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(1 << COUNTER_BITS, dtype=np.int64)
        for b in batches:
            for s in b["s"]:
                for first in range(0, len(s), AT_ONCE):
                    chars = points(s[first : first + AT_ONCE])
                    for q in (1, 2, 3):
                        total += np.bincount(slots(grams(chars, q), COUNTER_BITS), minlength=len(total))
        at = np.flatnonzero(total)
        yield pd.DataFrame({"slot": at, "n": total[at]})

    out = np.zeros(1 << COUNTER_BITS, dtype=np.int64)
    for r in texts.select("s").mapInPandas(run, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).collect():
        out[r["slot"]] = r["n"]
    return out


def _listed(names: DataFrame, threshold: float, rarity: np.ndarray) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for i, name in zip(b["name_id"], b["name"], strict=True):
                q, codes, at, require, span = listing(name, threshold, rarity)
                out += [(c, i, k % MASK_BITS, int(o), q, require, span) for k, (c, o) in enumerate(zip(codes.astype(np.int64).tolist(), at, strict=True))]
            yield pd.DataFrame(out, columns=["gram", "name_id", "bit", "at", "q", "require", "span"])

    return names.select("name_id", "name").mapInPandas(run, "gram long, name_id long, bit int, at int, q int, require int, span int")


def _places(texts: DataFrame, listed: DataFrame) -> DataFrame:
    """(gram, text_id, pos) of every place of a listed gram in the texts."""

    def marked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            at = np.unique(slots(b["gram"].to_numpy(np.int64).view(np.uint64), LISTED_BITS))
            words, first = np.unique(at >> 5, return_index=True)
            yield pd.DataFrame({"word": words, "bits": np.bitwise_or.reduceat(1 << (at & 31), first) if len(at) else at})

    bits = np.zeros(1 << LISTED_BITS - 5, dtype=np.int64)
    for r in listed.select("gram").mapInPandas(marked, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).collect():
        bits[r["word"]] = r["bits"]
    sizes = sorted(r["q"] for r in listed.select("q").distinct().collect())
    bits = bits.astype(np.uint32)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for i, s in zip(b["text_id"], b["s"], strict=True):
                for first in range(0, len(s), AT_ONCE):
                    chars = points(s[first : first + AT_ONCE + 2])
                    for q in sizes:
                        codes = grams(chars, q)[:AT_ONCE]
                        slot = slots(codes, LISTED_BITS)
                        at = np.flatnonzero(bits[slot >> 5] >> (slot & 31).astype(np.uint32) & 1)
                        yield pd.DataFrame({"gram": codes[at].view(np.int64), "text_id": np.full(len(at), i, dtype=np.int64), "pos": at + first})

    return texts.select("text_id", "s").mapInPandas(run, "gram long, text_id long, pos long")


def _blocks(texts: DataFrame, width: int, more: int) -> DataFrame:
    """(text_id, block, s, end) of each text in blocks of ``width`` characters and ``more`` of the next; ``end`` is the
    length of the text. Short blocks spare what cuts pieces out of them a walk through a long text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = [(i, k, s[k * width : (k + 1) * width + more], len(s)) for i, s in zip(b["text_id"], b["s"], strict=True) for k in range(-(-len(s) // width))]
            yield pd.DataFrame(out, columns=["text_id", "block", "s", "end"])

    return texts.select("text_id", "s").mapInPandas(run, "text_id long, block long, s string, end long")


def _scored(threshold: float):
    """Scores the runs of words that begin in a slot of a text."""

    def best(name: str, piece: str, first: int, low: int, high: int, end: int, scorer: SequenceMatcher, known: dict[str, float]) -> tuple | None:
        number, la, found = len(name.split()), len(name), None
        starts = [k for k in range(len(piece)) if piece[k] != " " and (first + k == 0 or k and piece[k - 1] == " ")]
        stops = [k for k in range(1, len(piece) + 1) if piece[k - 1] != " " and (first + k == end or k < len(piece) and piece[k] == " ")]
        stops = [k for k in stops if starts and k > starts[0]]
        for w, a in enumerate(starts):
            if not low <= first + a < high:
                continue
            for size in (number - 1, number, number + 1):
                if size < 1 or w + size > len(stops):
                    continue
                run = piece[a : stops[w + size - 1]]
                if 2.0 * min(la, len(run)) / (la + len(run)) < threshold:
                    continue
                if run not in known:
                    scorer.set_seq1(run)
                    known[run] = scorer.ratio() if scorer.quick_ratio() >= threshold else 0.0
                rank = (known[run], size == number, -size, -(first + a), run)
                if rank[0] >= threshold and (found is None or rank > found):
                    found = rank
        return found

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for name, rows in b.groupby("name", sort=False):
                scorer, known = SequenceMatcher(None, "", name, autojunk=False), {}
                for r in rows[promising(name, rows["piece"].tolist(), threshold)].itertuples():
                    if hit := best(name, r.piece, r.first, r.low, r.low + r.span, r.end, scorer, known):
                        out.append((r.name_id, r.text_id, hit[0], hit[1], hit[2], hit[3], hit[4], round(hit[0], 6)))
            yield pd.DataFrame(out, columns=["name_id", "text_id", "ratio", "same", "size", "at", "run", "shown"])

    return run


def _prepared(names: DataFrame, texts: DataFrame, key: str, name: str, text_key: str, text: str, wanted: Column, as_sought: Column) -> tuple[DataFrame, DataFrame]:
    n = names.select(F.col(key).alias("key"), wanted.alias("name")).where("name <> ''").distinct().withColumn("name_id", F.xxhash64(F.lit(0), "key", F.col("key").isNull(), "name"))
    t = texts.select(F.col(text_key).alias("text_key"), as_sought.alias("s")).where("s is not null")
    return n, t.withColumn("text_id", F.xxhash64(F.lit(1), "text_key", F.col("text_key").isNull(), "s"))


def _similar_by_joins(scratch: Scratch, n: DataFrame, t: DataFrame, threshold: float) -> DataFrame:
    """(key, text_key, b) by joins on the rarest grams, for lists of any length."""
    listed = scratch.save(_listed(n, threshold, _rarity(t)))
    met = _places(t, listed).join(listed, "gram").withColumn("own", F.floor(F.col("pos") / F.col("span")))
    # A run that begins in a slot of its name's longest run ends in the next one at the latest.
    met = met.withColumn("slot", F.explode(F.array(F.col("own") - 1, F.col("own")))).where("slot >= 0")
    enough = met.groupBy("name_id", "text_id", "slot", "span", "require").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits")).where("bit_count(bits) >= require")
    found = scratch.save(enough.select("name_id", "text_id", "slot", "span"))
    longest = found.agg(F.coalesce(F.max("span"), F.lit(0))).head()[0]
    width = max(BLOCK, 8 * longest)
    low = F.col("slot") * F.col("span")
    first = F.greatest(low - 1, F.lit(0))
    wanted = found.withColumns({"low": low, "first": first, "block": F.floor(first / width)})
    cut = F.expr(f"substring(s, cast(first - block * {width} + 1 AS int), cast(2 * span + 2 AS int))")
    pieces = wanted.join(_blocks(t, width, 2 * longest + 2), ["text_id", "block"]).select("name_id", "text_id", "low", "span", "first", "end", cut.alias("piece"))
    asked = pieces.join(n.select("name_id", "name"), "name_id")
    hits = asked.select("name", "name_id", "text_id", "low", "span", "first", "end", "piece").mapInPandas(_scored(threshold), f"name_id long, {_HIT}")
    best = hits.groupBy("name_id", "text_id").agg(F.max(F.struct(*_RANK)).alias("b"))
    owner = t.select("text_id", "text_key").join(found.select("text_id").distinct(), "text_id", "left_semi").distinct()
    return best.join(owner, "text_id").join(n.select("name_id", "key"), "name_id").select("key", "text_key", "b")


def similar(names: DataFrame, texts: DataFrame, key: str, name: str, text_key: str, text: str, threshold: float) -> DataFrame:
    """(key, text_key, ratio, window): for each name and text the most similar run of about as many words as the name
    has. Of equal ones the run of just as many words counts, then the shorter, then the earlier."""
    if not 0 < threshold <= 1:
        raise ValueError("the threshold lies above 0 and up to 1")
    spark = texts.sparkSession
    scratch = Scratch(spark, "names")
    n, t = _prepared(names, texts, key, name, text_key, text, F.lower(name), normal(F.col(text)))
    n = scratch.save(n)
    short = F.length("name").isin(name_pieces.lengths(threshold))
    few = n.where(short).select("name_id", "name").limit(name_pieces.MOST + 1).collect()
    found = []
    if 0 < len(few) <= name_pieces.MOST:
        listed = spark.sparkContext.broadcast(([r["name_id"] for r in few], [r["name"] for r in few]))
        kinds = StructType([StructField("name_id", LongType()), t.schema["text_key"], *StructType.fromDDL(_HIT)])
        hits = t.select("text_key", "text_id", "s").mapInArrow(name_pieces.scored(listed, threshold), kinds)
        best = hits.groupBy("name_id", "text_id", "text_key").agg(F.max(F.struct(*_RANK)).alias("b"))
        found.append(best.join(n.select("name_id", "key"), "name_id").select("key", "text_key", "b"))
    rest = n.where(~short) if found else n
    if not found or rest.head(1):
        found.append(_similar_by_joins(scratch, rest, t, threshold))
    return reduce(DataFrame.unionByName, found).select(F.col("key").alias(key), F.col("text_key").alias(text_key), F.col("b.shown").alias("ratio"), F.col("b.run").alias("window"))


def containing(names: DataFrame, texts: DataFrame, key: str, name: str, text_key: str, text: str, fold: bool) -> DataFrame:
    """(key, text_key) of each text that holds a name: the places of its rarest gram are looked at."""
    scratch = Scratch(texts.sparkSession, "names")
    same = (lambda c: F.lower(c)) if fold else (lambda c: F.col(c))
    n, t = _prepared(names, texts, key, name, text_key, text, same(name), same(text))
    n = scratch.save(n)
    listed = _listed(n, 1.0, _rarity(t))
    first = scratch.save(listed.groupBy("name_id").agg(F.min_by(F.struct("gram", "at", "q"), "bit").alias("g")).select("name_id", "g.*"))
    met = _places(t, first).join(first, "gram").withColumn("from", F.col("pos") - F.col("at")).where("from >= 0")
    looked = met.select("name_id", "text_id", "from").join(n, "name_id").join(t, "text_id")
    held = looked.where("substring(s, cast(from + 1 AS int), length(name)) = name")
    return held.select(F.col("key").alias(key), F.col("text_key").alias(text_key)).distinct()
