"""Exact self-join on the Jaccard similarity of word shingles, with adaptive multi-match prefixes.

Shingles get one global order: rare before frequent by their exact numbers of texts, kept as levels in a table of
fixed size, then by hash. A document of n shingles that needs an overlap of a has the l-prefix of its first n - a + l
shingles; two similar documents share at least l shingles of their l-prefixes. Each document takes the l of least
estimated cost: postings, and candidates to verify, of which every one must be met l times. A pair is counted at the
smaller l of the two. So what many unlike documents share stays outside their prefixes.

Work is kept linear in groups of copies. Texts with equal shingle sets are one node. Within the postings of a shingle
every node is first compared only with one pivot; nodes found linked are merged, and just candidates that still lie in
different components are then compared with each other. So no link between components is lost, while the pairs inside
a group of copies are never listed. Postings of frequent shingles are salted for the pivot step.

Defined results: a null text, or one without words, has no shingles, links with nothing and is its own component; a
text of fewer words than a shingle is one shingle; rows of one id are rows of their own with one component; rows with
a null id keep it and join components like others; an empty table gives no rows. Other columns are ignored. Nodes are
64-bit hashes of shingle sets, so different sets fall together with a chance of about n * n / 2**65.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folioframe.llm import textkernel as tk
from folioframe.llm.components import components
from folioframe.scratch import Scratch, input_partitions

LEVEL_BITS, FREQUENT = 24, 8
BITMAP_BITS, BITMAP_PART = 25, 1 << 19
MAX_L = 8
VERIFY_COST = 8.0
HOT = 4096


def signature(s: np.ndarray) -> int:
    """A signed 64-bit hash of a sorted set of shingle hashes."""
    x = tk.mix(s * tk.U64(0x9FB21C651E98DF25)).sum(dtype=np.uint64) ^ tk.U64(len(s))
    return int(tk.mix(np.array([x], dtype=np.uint64)).view(np.int64)[0])


def least_overlap(n, percent: int):
    """Fewest shingles that a document of n shares with any partner."""
    return -(-percent * n // 100)


def _scan(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, sig = [], []
            for _, raw, offsets in tk.chunks(batch.column(1)):
                sets = list(tk.shingle_sets(raw, offsets, size))
                n += [len(s) for s in sets]
                sig += [signature(s) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(n, pa.int64()), pa.array(sig, pa.int64())], names=["doc_id", "n", "node"])

    return run


def _summed(h: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(h, kind="stable")
    h = h[order]
    first = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
    return h[first], np.add.reduceat(n[order], first)


def _count(size: int, buckets: int, flush: int = 1 << 20):
    """Shingles with their numbers of texts, equal ones of a task added up, packed by the bucket that their first bits name."""
    wide = buckets.bit_length() - 1

    def give(held: list[np.ndarray]) -> pa.RecordBatch:
        h = np.concatenate(held)
        h, n = _summed(h, np.ones(len(h), np.int64))
        bucket = (h >> tk.U64(64 - wide)).astype(np.int32)
        cut = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
        bounds = list(zip(cut.tolist(), np.append(cut[1:], len(h)).tolist(), strict=True))
        # 48 bits below the bucket's own tell shingles apart.
        six = ((h << tk.U64(wide)) >> tk.U64(16)).view(np.uint8).reshape(-1, 8)[:, :6]
        n = np.minimum(n, 65535).astype(np.uint16)
        packed = lambda x: pa.array([x[i:j].tobytes() for i, j in bounds], pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(bucket[cut]), packed(six), packed(n)], names=["bucket", "shingles", "texts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        held, total = [], 0
        for batch in batches:
            for _, raw, offsets in tk.chunks(batch.column(0)):
                for s in tk.shingle_sets(raw, offsets, size):
                    if len(s) and (node := signature(s)) not in seen:
                        seen.add(node)
                        held.append(s)
                        total += len(s)
                        if total > flush:
                            yield give(held)
                            held, total = [], 0
        if held:
            yield give(held)
        del held
        tk.release_memory()

    return run


def _levels(buckets: int):
    region = (1 << LEVEL_BITS) // buckets

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        six = np.concatenate([np.frombuffer(x, np.uint8) for x in rows["shingles"]]).reshape(-1, 6)
        h = np.zeros((len(six), 8), np.uint8)
        h[:, :6] = six
        h, n = _summed(h.view(np.uint64)[:, 0], np.concatenate([np.frombuffer(x, np.uint16) for x in rows["texts"]]).astype(np.int64))
        least, room = FREQUENT, max(1, region // 4)
        if np.count_nonzero(n >= least) > room:
            least = max(least, int(np.partition(n, len(n) - room)[len(n) - room]))
        often = n >= least
        table = np.zeros(region, np.uint8)
        np.maximum.at(table, (h[often] >> tk.U64(48 - region.bit_length() + 1)).astype(np.int64), np.minimum(np.floor(4 * np.log2(n[often])), 255).astype(np.uint8))
        rest = n[~often]
        return pd.DataFrame({"bucket": [int(rows["bucket"].iloc[0])], "levels": [table.tobytes() if often.any() else None], "met": [float((rest * (rest - 1)).sum())], "seen": [float(rest.sum())]})

    return run


def frequencies(texts: DataFrame, size: int) -> tuple[np.ndarray, float]:
    """The level of each slot of shingles, and how many other texts a shingle below all levels meets on average.

    A level is four times the logarithm of the exact number of texts, counted over all of them. The table has a fixed
    size: where frequent shingles would fill more than a quarter of their bucket's slots, the least of them have none.
    Two shingles of a slot share the higher level; any order that the shingle alone decides gives the same links.
    """
    buckets = 1 << min(LEVEL_BITS - 4, max(6, (4 * input_partitions(texts) - 1).bit_length()))
    counted = texts.select("text").mapInArrow(_count(size, buckets), "bucket int, shingles binary, texts binary")
    rows = counted.groupBy("bucket").applyInPandas(_levels(buckets), "bucket int, levels binary, met double, seen double").collect()
    levels, region = np.zeros(1 << LEVEL_BITS, np.uint8), (1 << LEVEL_BITS) // buckets
    for r in rows:
        if r["levels"]:
            levels[r["bucket"] * region :][:region] = np.frombuffer(r["levels"], np.uint8)
    return levels, sum(r["met"] for r in rows) / max(1.0, sum(r["seen"] for r in rows))


def _or(rows: pd.DataFrame) -> pd.DataFrame:
    out = np.zeros(BITMAP_PART // 8, np.uint8)
    for x in rows["bits"]:
        out |= np.frombuffer(x, np.uint8)
    return pd.DataFrame({"part": [rows["part"].iloc[0]], "bits": [out.tobytes()]})


def node_bitmap(nodes: DataFrame) -> np.ndarray:
    """A bit for each hash of a node, in a bitmap of fixed size: a filter before a shuffle that lets all nodes pass and few others."""

    def run(batches):
        bits = np.zeros(1 << BITMAP_BITS, dtype=bool)
        for b in batches:
            bits[b.column(0).to_numpy(zero_copy_only=False).view(np.uint64) >> tk.U64(64 - BITMAP_BITS)] = True
        parts = [p for p in range(0, len(bits), BITMAP_PART) if bits[p : p + BITMAP_PART].any()]
        yield pa.RecordBatch.from_arrays([pa.array([p // BITMAP_PART for p in parts], pa.int32()), pa.array([np.packbits(bits[p : p + BITMAP_PART]).tobytes() for p in parts], pa.binary())], names=["part", "bits"])

    rows = nodes.select("node").mapInArrow(run, "part int, bits binary").groupBy("part").applyInPandas(_or, "part int, bits binary").collect()
    out = np.zeros(1 << (BITMAP_BITS - 3), np.uint8)
    for r in rows:
        out[r["part"] * BITMAP_PART // 8 :][: BITMAP_PART // 8] = np.frombuffer(r["bits"], np.uint8)
    return out


def choose_l(partners: np.ndarray, base: int, most: int) -> int:
    """The l of least estimated cost; ``partners``: other texts at each shingle of the longest prefix, in order; ``base``:
    length of the 0-prefix. Each posting costs 1; of the pairs met at most one in l is met l times and compared."""
    best, best_cost = 1, np.inf
    sums = np.cumsum(partners)
    for l in range(1, most + 1):
        k = min(base + l, len(sums))
        cost = k + VERIFY_COST * sums[k - 1] / l
        if cost < best_cost:
            best, best_cost = l, cost
    return best


def _postings(size: int, percent: int, levels, rare: float, hot: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        table = levels.value
        number = np.exp2(np.arange(256) / 4)  # of texts, by level
        partners = np.where(np.arange(256) > 0, number - 1, rare)
        parts = np.where(number > hot, np.maximum(1, number / max(1, hot / 2)), 0).astype(np.int64)
        for batch in batches:
            for _, raw, offsets in tk.chunks(batch.column(0)):
                tokens, nodes, metas, salts = [], [], [], []
                for s in tk.shingle_sets(raw, offsets, size):
                    n = len(s)
                    if not n or (node := signature(s)) in seen:
                        continue
                    seen.add(node)
                    need = least_overlap(n, percent)
                    longest = min(n, n - need + min(MAX_L, need))
                    lv = table[(s >> tk.U64(64 - LEVEL_BITS)).astype(np.int64)]
                    order = np.argsort(lv, kind="stable")[:longest]  # s is sorted by hash
                    l = choose_l(partners[lv[order]], n - need, min(MAX_L, need))
                    keep = order[: n - need + l]
                    k = len(keep)
                    tokens.append(s[keep])
                    nodes.append(np.full(k, node, np.int64))
                    metas.append((n << 34) | (np.arange(k, dtype=np.int64) << 8) | l)
                    p = parts[lv[keep]]
                    salts.append(np.where(p > 0, node % np.maximum(p, 1), -1).astype(np.int32))
                if tokens:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(tokens).view(np.int64)), pa.array(np.concatenate(nodes)), pa.array(np.concatenate(metas)), pa.array(np.concatenate(salts))], names=["token", "node", "meta", "salt"]
                    )

    return run


def _sets(size: int, bitmap: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(bitmap).astype(bool)
        seen: set[int] = set()
        for batch in batches:
            for _, raw, offsets in tk.chunks(batch.column(0)):
                nodes, sets = [], []
                for s in tk.shingle_sets(raw, offsets, size):
                    if len(s) and (node := signature(s)) not in seen and bits[(node & (2**64 - 1)) >> (64 - BITMAP_BITS)]:
                        seen.add(node)
                        nodes.append(node)
                        sets.append(s.tobytes())
                if nodes:
                    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(sets, pa.binary())], names=["node", "shingles"])

    return run


def _compare(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for k in range(batch.num_rows):
                x, y = (np.frombuffer(batch.column(c)[k].as_buffer(), np.uint64) for c in (2, 3))
                both = np.concatenate((x, y))
                both.sort()
                shared = int(np.count_nonzero(both[1:] == both[:-1]))
                keep.append(100 * shared >= percent * (len(both) - shared))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def verify(texts: DataFrame, pairs: DataFrame, size: int, percent: int, scratch: Scratch) -> DataFrame:
    """The pairs (a, b) of nodes whose shingle sets are similar enough, by comparing the whole sets."""
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node")))
    bitmap = node_bitmap(nodes)
    sets = texts.select("text").mapInArrow(_sets(size, bitmap), "node long, shingles binary")
    # Equal sets found by several tasks: one is enough.
    sets = scratch.save(sets.join(nodes.distinct(), "node", "left_semi").dropDuplicates(["node"]))
    left = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a")
    full = left.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b")
    out = scratch.save(full.select("a", "b", "x", "y").mapInArrow(_compare(percent), "a long, b long"))
    scratch.drop(sets)
    return out


def _candidates(met: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that pass length, multi-match and position bounds; ``met``: a row for each shingle met by both, with both metas."""
    n = lambda m: F.shiftright(m, 34)
    at = lambda m: F.shiftright(m, 8).bitwiseAND(F.lit((1 << 26) - 1))
    l = lambda m: F.col(m).bitwiseAND(F.lit(255))
    rows = met.select("a", "b", n("ma").alias("na"), n("mb").alias("nb"), at("ma").alias("ia"), at("mb").alias("ib"), F.least(l("ma"), l("mb")).alias("l"))
    zero = lambda c: F.expr(f"{c} - ({percent} * {c} + 99) div 100")
    rows = rows.where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent)
    inside = (F.col("ia") < zero("na") + F.col("l")) & (F.col("ib") < zero("nb") + F.col("l"))
    counted = rows.groupBy("a", "b").agg(
        F.count(F.when(inside, 1)).alias("met"), F.count(F.lit(1)).alias("all"), F.max("ia").alias("ia"), F.max("ib").alias("ib"), F.first("na").alias("na"), F.first("nb").alias("nb"), F.first("l").alias("l")
    )
    overlap = F.expr(f"({percent} * (na + nb) + {100 + percent - 1}) div {100 + percent}")
    most = F.col("all") + F.least(F.col("na") - F.col("ia") - 1, F.col("nb") - F.col("ib") - 1)
    return counted.where((F.col("met") >= F.col("l")) & (most >= overlap)).select("a", "b")


def similar_components(
    spark: SparkSession, documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80, hot: int = HOT
) -> DataFrame:
    """Per row of ``documents``: doc_id, n_shingles and component_id, the smallest id that links of similarity >= percent reach."""
    scratch = Scratch(spark, "ngram-join")
    texts = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = scratch.save(texts.mapInArrow(_scan(size), "doc_id long, n long, node long"))
    levels, rare = frequencies(texts, size)
    shared = spark.sparkContext.broadcast(levels)
    scratch.release()

    postings = texts.select("text").mapInArrow(_postings(size, percent, shared, rare, hot), "token long, node long, meta long, salt int")
    group = Window.partitionBy("token", "salt")
    place = F.struct(F.shiftright("meta", 8).bitwiseAND(F.lit((1 << 26) - 1)), F.col("node"), F.col("meta"))
    met = postings.withColumn("k", F.count(F.lit(1)).over(group)).where("k > 1 or salt >= 0").withColumn("p", F.min(place).over(group))
    met = scratch.save(met.select("token", "node", "meta", F.col("p.node").alias("pivot"), F.col("p.meta").alias("pivot_meta")))
    shared.unpersist()
    scratch.release()

    stars = met.where("node <> pivot").select(F.col("node").alias("a"), F.col("pivot").alias("b"), F.col("meta").alias("ma"), F.col("pivot_meta").alias("mb"))
    tried = scratch.save(_candidates(stars, percent))
    links = verify(texts, tried, size, percent, scratch)
    merged = scratch.save(components(links, scratch))
    scratch.release()

    named = met.select("token", "node", "meta").join(merged, "node", "left").withColumn("c", F.coalesce("component", "node"))
    group = Window.partitionBy("token")
    open_ = scratch.save(named.withColumn("lo", F.min("c").over(group)).withColumn("hi", F.max("c").over(group)).where("lo < hi").select("token", "node", "meta", "c"))
    scratch.drop(met)
    scratch.release()
    # Of a node's shingles before this one: how many can be met at all (the others are its own alone, or meet one
    # component), and which, as a bitmap of a bit for each by hash.
    ranked = scratch.save(with_marks(open_))
    scratch.drop(open_)
    side = lambda n: ranked.select("token", F.col("node").alias(n), *[F.col(c).alias(f"{c}{n}") for c in ("meta", "c", "r", "low", "high")])
    near = side("a").join(side("b"), "token").where("ca < cb").where(_reachable(percent)).withColumnsRenamed({"metaa": "ma", "metab": "mb"})
    done = tried.select(F.least("a", "b").alias("ta"), F.greatest("a", "b").alias("tb"))
    rest = _candidates(near, percent)
    rest = rest.join(done, (F.least("a", "b") == F.col("ta")) & (F.greatest("a", "b") == F.col("tb")), "left_anti")
    rest = scratch.save(rest)
    more = verify(texts, rest, size, percent, scratch)
    final = scratch.save(components(links.union(more), scratch))
    scratch.release()

    nodes = rows.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("least"))
    whole = nodes.join(final, "node", "left").withColumn("c", F.coalesce("component", "node"))
    # Written out, so that the join below shuffles both sides and Spark can split a large component.
    smallest = scratch.save(whole.groupBy("c").agg(F.min("least").alias("component_id")))
    ids = whole.select("node", "c").join(smallest, "c").select("node", "component_id")
    out = rows.join(ids, "node", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def with_marks(rows: DataFrame) -> DataFrame:
    """``rows`` (token, node, meta, c) with ``r``, the number of rows of the node before, and their bitmap ``low``, ``high``."""
    order = Window.partitionBy("node").orderBy("meta")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    bit = F.expr("cast(pmod(xxhash64(token), 128) as int)")
    marks = lambda half: F.coalesce(F.bit_or(F.when(F.floor(bit / 64) == half, F.expr("shiftleft(1L, cast(pmod(xxhash64(token), 64) as int))"))).over(before), F.lit(0).cast("long"))
    return rows.withColumns({"r": F.row_number().over(order) - 1, "low": marks(0), "high": marks(1)})


def _reachable(percent: int):
    """At one shared shingle of a and b: lengths fit, and the shingles from it on, with those before it that both can have,
    reach the overlap. A bit that one has and the other lacks is a shingle, or more, that the other lacks."""
    na, nb = F.shiftright("metaa", 34), F.shiftright("metab", 34)
    ia, ib = (F.shiftright(m, 8).bitwiseAND(F.lit((1 << 26) - 1)) for m in ("metaa", "metab"))
    lacking = lambda x, y: F.expr(f"bit_count(low{x} & ~low{y}) + bit_count(high{x} & ~high{y})")
    both = F.least(F.col("ra") - lacking("a", "b"), F.col("rb") - lacking("b", "a"))
    return (F.least(na, nb) * 100 >= F.greatest(na, nb) * percent) & ((both + F.least(na - ia, nb - ib)) * (100 + percent) >= (na + nb) * percent)


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_components(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))
