"""Exact ranked search over dual-sorted inverted lists.

An index is a table of shards. A shard numbers its documents (like ones together: by commonest term, then length) and
lists for each term its postings by falling impact, one list after another. Over this sequence of document numbers
stands a wavelet tree: a bitmap for each bit of the numbers, highest first, with the sequence stably parted by the bits
above. A node of the tree is a range of document numbers, and a list's part in a node is a stretch that rank counts
give, still by falling impact. So the first posting of each stretch bounds what the node's documents can score, and a
search takes the lists of a query down together, the nodes of the highest bounds first, and ends where no bound reaches
the k-th score. Floors go on from shard to shard within a task.

The impact of a posting is ``1000000000 tf div (1000 tf + 12 m)`` with ``m = 75 + 25 n N div L``, its score the sum over the
query's terms of ``w = floor(1000 ln((2 N + 2) / (2 df + 1)))`` times the impact, repeats included.

Defined results: a null text has no terms; documents without an id are ranked as others and come last among equal
scores, as null; rows of one id are documents of their own; each row of the queries is a query of its own; a query
without terms, or without a document that scores above 0, gives no rows; an empty table gives none. Terms are told
apart by 64-bit hashes. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folioframe.llm.textkernel import chunks, release_memory, span_hashes, words
from folioframe.scratch import Scratch

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
SHARD_BYTES = 8 << 20
BLOCK_TERMS = 1 << 18
NODES = 128
INDEX = "documents int, ids binary, has_id binary, terms binary, counts binary, impacts binary, bits binary"
INSIDE = np.ones(256, dtype=bool)
for _low, _high in ((0x00, 0x30), (0x3A, 0x41), (0x5B, 0x61), (0x7B, 0x80)):
    INSIDE[_low:_high] = False


# ---------------------------------------------------------------- terms


def _summed(doc: np.ndarray, term: np.ndarray, tf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One row for each (term, document), in that order, with the sum of ``tf``."""
    order = np.lexsort((doc, term))
    doc, term, tf = doc[order], term[order], tf[order]
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (term[1:] != term[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    return doc[first], term[first], np.add.reduceat(tf, first) if len(first) else tf[:0]


def _occurrences(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, first = words(raw, offsets, INSIDE)
    return np.repeat(np.arange(len(offsets) - 1), np.diff(first)), span_hashes(raw, starts, ends)


def term_counts(raw: np.ndarray, offsets: np.ndarray, block: int = SHARD_BYTES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, term, occurrences) of texts that lie one after another; one long text goes in blocks cut outside terms."""
    if len(offsets) > 2 or len(raw) <= block:
        doc, term = _occurrences(raw, offsets)
        return _summed(doc, term, np.ones(len(doc), dtype=np.int64))
    total = (np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64))
    first = 0
    while first < len(raw):
        stop = min(len(raw), first + block)
        while stop < len(raw) and INSIDE[raw[stop]]:
            stop += 1
        part = raw[first:stop]
        doc, term = _occurrences(part, np.array([0, len(part)]))
        total = _summed(*[np.concatenate(p) for p in zip(total, (doc, term, np.ones(len(doc), dtype=np.int64)), strict=True)])
        first = stop
    return total


# ---------------------------------------------------------------- shards


def length_terms(n: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """m of documents of n terms, given the numbers of documents and of terms of the corpus."""
    if len(n) and 25 * int(n.max()) * documents >= 1 << 63:
        n = n.astype(object)
    return (75 + 25 * n * documents // max(terms, 1)).astype(np.int64)


def build_shard(doc: np.ndarray, term: np.ndarray, tf: np.ndarray, n_docs: int, documents: int, terms: int) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """(the document at each number, arrays of the shard) from rows by (term, document)."""
    n = np.bincount(doc, weights=tf, minlength=n_docs).astype(np.int64)
    commonest = np.zeros(n_docs, dtype=np.uint64)
    by_tf = np.lexsort((tf, doc))
    commonest[doc[by_tf]] = term[by_tf]  # the last of a document stays
    place = np.lexsort((n, commonest))
    number = np.empty(n_docs, dtype=np.int64)
    number[place] = np.arange(n_docs)
    impact = 1_000_000_000 * tf // (1000 * tf + 12 * length_terms(n, documents, terms)[doc])
    listed, counts = np.unique(term, return_counts=True)
    of = np.repeat(np.arange(len(listed)), counts)
    order = np.lexsort((number[doc], -impact, of))
    sequence, impact = number[doc][order], impact[order].astype(np.int32)
    bits = []
    for shift in range(max(1, (n_docs - 1).bit_length()) - 1, -1, -1):
        bit = (sequence >> shift & 1).astype(bool)
        bits.append(np.packbits(bit))
        sequence = np.concatenate([sequence[~bit], sequence[bit]])
    return place, {"terms": listed, "counts": counts.astype(np.uint32), "impacts": impact, "bits": np.concatenate(bits) if bits else np.zeros(0, np.uint8)}


def _building(documents: int, terms: int, shard_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for first, raw, offsets in chunks(batch.column(1), shard_bytes):
                n = len(offsets) - 1
                doc, term, tf = term_counts(raw, offsets, shard_bytes)
                if not len(doc):
                    continue
                place, shard = build_shard(doc, term, tf, n, documents, terms)
                own = ids.slice(first, n)
                row = {"ids": own.fill_null(0).to_numpy(zero_copy_only=False)[place], "has_id": own.is_valid().to_numpy(zero_copy_only=False)[place].astype(np.uint8), **shard}
                yield pa.RecordBatch.from_arrays([pa.array([n], pa.int32()), *[pa.array([v.tobytes()], pa.binary()) for v in row.values()]], names=["documents", *row])
        release_memory()

    return run


def build_index(
    spark: SparkSession, documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shard_bytes: int = SHARD_BYTES
) -> tuple[DataFrame, int, int]:
    """(a row for each shard, number of documents with a term, number of terms) of all documents."""
    texts = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    n = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(TERM)).cast("long")
    n_docs, n_terms = texts.select(n.alias("n")).select(F.coalesce(F.sum(F.expr("if(n > 0, 1L, 0L)")), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).head()
    return Scratch(spark, "lexical").save(texts.mapInArrow(_building(n_docs, n_terms, shard_bytes), INDEX)), n_docs, n_terms


class Shard:
    """A shard's lists and, once asked for, its tree."""

    def __init__(self, row: dict):
        of = lambda name, kind: np.frombuffer(row[name].as_buffer(), dtype=kind)
        self.n_docs = row["documents"].as_py()
        self.ids, self.has_id, self.terms = of("ids", np.int64), of("has_id", np.uint8), of("terms", np.uint64)
        self.begin = np.concatenate([[0], np.cumsum(of("counts", np.uint32).astype(np.int64))])
        self.impacts, self.bits = of("impacts", np.int32), of("bits", np.uint8)
        self.levels = max(1, (self.n_docs - 1).bit_length())
        self.zeros = None

    def open(self) -> None:
        """Rank counts and the impacts in the order of each level."""
        size = len(self.impacts)
        bits = self.bits.reshape(self.levels, -1)
        self.zeros = np.zeros((self.levels, size + 1), dtype=np.int32)
        self.at = np.empty((self.levels + 1, size), dtype=np.int32)
        self.at[0] = self.impacts
        for level in range(self.levels):
            bit = np.unpackbits(bits[level], count=size).astype(bool)
            np.cumsum(~bit, out=self.zeros[level, 1:])
            low = self.at[level][~bit]
            self.at[level + 1, : len(low)] = low
            self.at[level + 1, len(low) :] = self.at[level][bit]

    def search(self, lists: np.ndarray, weights: np.ndarray, k: int, floor: int, nodes: int = NODES, counted: list | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(numbers, scores) of documents that hold all of the k best with a score of ``floor`` at least."""
        low, high = self.begin[lists][None, :], self.begin[lists + 1][None, :]
        bound = np.array([int((self.impacts[low[0]].astype(np.int64) * weights).sum())])
        level, prefix = np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64)
        found, scores = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        while True:
            live = np.flatnonzero(bound >= floor)
            if not len(live):
                return found, scores
            if self.zeros is None:
                self.open()
            if len(live) > nodes:
                live = live[np.argpartition(-bound[live], nodes - 1)]
            now, rest = live[:nodes], live[nodes:]
            at, a, b = level[now][:, None], low[now], high[now]
            a0, b0, none = self.zeros[at, a], self.zeros[at, b], self.zeros[level[now], -1][:, None]
            child_low, child_high = np.concatenate([a0, none + a - a0]).astype(np.int64), np.concatenate([b0, none + b - b0]).astype(np.int64)
            child_level, child = np.tile(level[now] + 1, 2), np.concatenate([2 * prefix[now], 2 * prefix[now] + 1])
            here = child_high > child_low
            first = self.at[child_level[:, None], np.minimum(child_low, len(self.impacts) - 1)]
            child_bound = np.where(here, first, 0) @ weights
            if counted is not None:
                counted.append(len(child))
            leaf = child_level == self.levels
            done = leaf & (child_bound >= floor)
            found, scores = np.concatenate([found, child[done]]), np.concatenate([scores, child_bound[done]])
            if len(scores) > k:
                floor = max(floor, int(np.partition(scores, len(scores) - k)[len(scores) - k]))
                kept = scores >= floor
                found, scores = found[kept], scores[kept]
            on = ~leaf & (child_bound >= floor)
            low, high = np.concatenate([low[rest], child_low[on]]), np.concatenate([high[rest], child_high[on]])
            bound, level, prefix = np.concatenate([bound[rest], child_bound[on]]), np.concatenate([level[rest], child_level[on]]), np.concatenate([prefix[rest], child[on]])


def _best(found: list[tuple[int, bool, int]], k: int) -> list[tuple[int, bool, int]]:
    return sorted(found)[:k]


def _searching(terms: np.ndarray, queries: list[tuple[int, np.ndarray, np.ndarray]], k: int):
    """``queries``: number, places of its terms in ``terms``, weights."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list] = [[] for _ in queries]  # (-score, has no id, id)
        for batch in batches:
            for r in range(batch.num_rows):
                shard = Shard({name: batch.column(c)[r] for c, name in enumerate(batch.schema.names)})
                place = np.minimum(np.searchsorted(shard.terms, terms), len(shard.terms) - 1)
                known = shard.terms[place] == terms
                for q, (_, own, weights) in enumerate(queries):
                    held = known[own]
                    if not held.any():
                        continue
                    floor = -best[q][-1][0] if len(best[q]) == k else 1
                    numbers, scores = shard.search(place[own[held]], weights[held], k, floor)
                    if len(numbers):
                        more = zip((-scores).tolist(), (shard.has_id[numbers] == 0).tolist(), shard.ids[numbers].tolist(), strict=True)
                        best[q] = _best([*best[q], *more], k)
        rows = [(queries[q][0], None if no_id else i, -s) for q, b in enumerate(best) for s, no_id, i in b]
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], pa.int64()) for c in range(3)], names=["query", "doc_id", "score"])
        release_memory()

    return run


def _dictionary(terms: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(terms), dtype=np.int64)
        for batch in batches:
            for listed, counts in zip(batch.column(0), batch.column(1), strict=True):
                own = np.frombuffer(listed.as_buffer(), np.uint64)
                place = np.minimum(np.searchsorted(own, terms), len(own) - 1)
                total += np.where(own[place] == terms, np.frombuffer(counts.as_buffer(), np.uint32)[place], 0)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["term", "n"])

    return run


def _query_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, raw, offsets in chunks(batch.column(1)):
            doc, term, tf = term_counts(raw, offsets)
            order = np.argsort(doc, kind="stable")
            bounds = np.searchsorted(doc[order], np.arange(len(offsets)))
            cut = lambda a, k: a[order[bounds[k] : bounds[k + 1]]].tobytes()  # noqa: B023, E731
            n = len(offsets) - 1
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(first, n), pa.array([cut(term, k) for k in range(n)], pa.binary()), pa.array([cut(tf, k) for k in range(n)], pa.binary())], names=["item_id", "terms", "tf"]
            )


def _blocks(items: DataFrame, block_terms: int) -> Iterator[list]:
    """The queries in blocks of about so many terms; the driver holds one block at a time."""
    block, size = [], 0
    for r in items.toLocalIterator():
        if r["terms"]:
            block.append((r["item_id"], np.frombuffer(bytes(r["terms"]), np.uint64), np.frombuffer(bytes(r["tf"]), np.int64)))
            size += len(block[-1][1])
        if size >= block_terms:
            yield block
            block, size = [], 0
    if block:
        yield block


def search(
    spark: SparkSession, index: DataFrame, n_docs: int, items: DataFrame, *, item_col: str = "item_id", text_col: str = "text", k: int = 20, block_terms: int = BLOCK_TERMS
) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of each row of ``items``. Every shard meets every block of
    queries; the k best of each task are what is shuffled."""
    scratch = Scratch(spark, "lexical_found")
    kind = items.schema[item_col].dataType.simpleString()
    asked = scratch.save(items.select(F.col(item_col).alias("item_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(_query_terms, f"item_id {kind}, terms binary, tf binary"))
    out = None
    for block in _blocks(asked, block_terms):
        terms = np.unique(np.concatenate([t for _, t, _ in block]))
        df = np.zeros(len(terms), dtype=np.int64)
        for r in index.select("terms", "counts").mapInArrow(_dictionary(terms), "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
            df[r["term"]] = r["n"]
        weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df], dtype=np.int64)
        queries = []
        for q, (_, own, tf) in enumerate(block):
            place = np.searchsorted(terms, own)
            kept = (df[place] > 0) & (weight[place] > 0)
            queries.append((q, place[kept], (weight[place] * tf)[kept]))
        found = index.mapInArrow(_searching(terms, queries, k), "query long, doc_id long, score long")
        order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        names = spark.createDataFrame([(q, item) for q, (item, _, _) in enumerate(block)], f"query long, item_id {kind}")
        ranked = ranked.join(F.broadcast(names), "query").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
        ranked = scratch.save(ranked)
        out = ranked if out is None else out.unionByName(ranked)
    return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long") if out is None else out


def op11_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    index, n_docs, _ = build_index(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return search(spark, index, n_docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


OP11_SQL = r"""
WITH split AS (
  SELECT row_number() OVER () AS row_no, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
totals AS (SELECT CAST(sum(CASE WHEN len(terms) > 0 THEN 1 ELSE 0 END) AS BIGINT) AS big_n, CAST(sum(len(terms)) AS BIGINT) AS big_l FROM split),
asked AS (
  SELECT item_no, item_id, term, CAST(count(*) AS BIGINT) AS times
  FROM (SELECT item_no, item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM (SELECT row_number() OVER () AS item_no, * FROM benchmark) b) x
  GROUP BY item_no, item_id, term),
postings AS (
  SELECT row_no, doc_id, n, term, CAST(count(*) AS BIGINT) AS tf
  FROM (SELECT row_no, doc_id, CAST(len(terms) AS BIGINT) AS n, unnest(terms) AS term FROM split) y
  WHERE term IN (SELECT term FROM asked)
  GROUP BY row_no, doc_id, n, term),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * big_n + 2) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM (SELECT term, CAST(count(*) AS BIGINT) AS df FROM postings GROUP BY term) d, totals),
impacts AS (
  SELECT p.row_no, p.doc_id, p.term, w.w * ((1000000000 * p.tf) // (1000 * p.tf + 12 * (75 + (25 * p.n * t.big_n) // t.big_l))) AS part
  FROM postings p JOIN weights w ON p.term = w.term, totals t),
scored AS (
  SELECT a.item_no, a.item_id, i.row_no, i.doc_id, CAST(sum(a.times * i.part) AS BIGINT) AS score
  FROM asked a JOIN impacts i ON a.term = i.term GROUP BY a.item_no, a.item_id, i.row_no, i.doc_id),
numbered AS (SELECT *, row_number() OVER (PARTITION BY item_no ORDER BY score DESC, doc_id NULLS LAST) AS r FROM scored WHERE score > 0)
SELECT item_id, CAST(r AS INTEGER) AS rank, doc_id, score FROM numbered WHERE r <= 20
"""
