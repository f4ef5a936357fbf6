"""Approximate nearest neighbours: a neighbour graph by NN-descent, searched greedily.

Equal vectors are one node, and there is one graph over all nodes. It starts from blocks of nodes that random
projections put together; then each round joins the neighbours of neighbours: for every node, its neighbours and a
bounded number of nodes that have it as neighbour are brought together by joins with the table of nodes, scored
pairwise, and each gets the better pairs as proposals.

Queries walk the graph together, a hop of all in each round of joins: a query's state is one row with its pool, the EF
best nodes met. The best EXPAND nodes of the pool that were not yet expanded are joined with their edges, both ways,
and what these lead to with the table of nodes; a query is done when all nodes of its pool have been expanded, or after HOPS
hops. It starts at its own node and at a few entry nodes, the same for all.

Graph and walk use vectors rounded to 8 and 16 bits, each with a scale of its own; the best 3 * k + 8 of a query's pool are scored
on the original vectors in double precision, and every score returned is of that kind. Nothing depends on how many
nodes there are, but for the number of blocks; recall is measured against brute force.

Defined results: vectors that are null, zero, or hold null or non-finite components, or have another length than most,
take no part; a query of several rows uses the least vector and meets no row of its own id; equal vectors rank by id;
scores beyond the range of doubles are infinite, or not a number where infinities cancel; a node has NEIGHBOURS edges
if there are as many other nodes, so each query finds k rows if they exist; an empty table gives no rows. Other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folioframe.llm import textkernel as tk
from folioframe.llm.vectors import one_per_id, ranked, usable
from folioframe.scratch import Scratch

NEIGHBOURS = 40
BLOCK = 256
TREES = 4
ROUNDS = 5
PROPOSALS = 6
EF = 128
EXPAND = 32
ENTRIES = 32
HOPS = 8
JOIN_ROWS, HOP_ROWS = 512, 64  # of an Arrow batch, whose rows hold the vectors of a neighbourhood or of all nodes reached


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Plans made inside send at most ``rows`` rows at once to Python, so that what a batch holds stays some MB."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, rows)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def packed(x: np.ndarray, kind: type = np.int8) -> list[bytes]:
    """Vectors as a factor in 4 bytes and whole numbers of one or two bytes each."""
    most = np.iinfo(kind).max
    factor = (np.abs(x).max(1, initial=0.0) / most).astype(np.float32)
    small = np.rint(np.divide(x, factor[:, None], out=np.zeros(x.shape), where=factor[:, None] > 0)).clip(-most, most).astype(kind)
    return [f.tobytes() + r.tobytes() for f, r in zip(factor, small, strict=True)]


def _matrix(values, kind: type = np.int8) -> np.ndarray:
    raw = np.frombuffer(b"".join(values), np.uint8).reshape(len(values), -1)
    return np.ascontiguousarray(raw[:, 4:]).view(kind).astype(np.float32) * np.ascontiguousarray(raw[:, :4]).view(np.float32)


def _rounded(batches: Iterator[pa.RecordBatch], scale: float) -> Iterator[pa.RecordBatch]:
    for b in batches:
        if b.num_rows:
            x = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1) * scale
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(packed(x), pa.binary()), pa.array(packed(x, np.int16), pa.binary())], names=["node", "x", "fine"])


def _codes(bits: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = _matrix(b.column(1).to_pylist())
            plane = np.random.default_rng(seed).normal(size=(x.shape[1], max(1, bits))).astype(np.float32)
            code = ((x @ plane) > 0) @ (1 << np.arange(max(1, bits))) if bits else np.zeros(len(x), np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(code.astype(np.int64))], names=["node", "x", "code"])
        tk.release_memory()

    return run


def _within(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """The best pairs of a block of nodes."""
    ids, x = rows["node"].to_numpy(np.int64), _matrix(rows["x"].tolist())
    k = min(NEIGHBOURS, len(ids) - 1)
    if k < 1:
        return pd.DataFrame({"u": np.zeros(0, np.int64), "v": np.zeros(0, np.int64), "s": np.zeros(0, np.float32)})
    s = x @ x.T
    np.fill_diagonal(s, -np.inf)
    best = np.argpartition(-s, k - 1, axis=1)[:, :k]
    return pd.DataFrame({"u": np.repeat(ids, k), "v": ids[best].ravel(), "s": np.take_along_axis(s, best, 1).ravel()})


def _local_join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs among the nodes brought together at one node that beat the worst neighbour of either side."""
    for batch in batches:
        us, vs, ss = [], [], []
        for at in range(0, batch.num_rows, 128):
            lists = batch.column(0).slice(at, 128)
            size = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten()
            ids, worst = (flat.field(n).to_numpy(zero_copy_only=False) for n in ("v", "worst"))
            x = _matrix(flat.field("x").to_pylist()) if len(ids) else np.zeros((0, 1), np.float32)
            m, d = int(size.max()) if len(size) else 0, x.shape[1]
            if m < 2:
                continue
            row = np.repeat(np.arange(len(size)), size)
            place = np.arange(len(ids)) - np.repeat(np.cumsum(size) - size, size)
            full, node, least = np.zeros((len(size), m, d), np.float32), np.full((len(size), m), -(2**63), np.int64), np.full((len(size), m), np.inf, np.float32)
            full[row, place], node[row, place], least[row, place] = x, ids, worst
            s = full @ full.transpose(0, 2, 1)
            s[(node[:, :, None] == node[:, None, :]) | (least[:, None, :] == np.inf) | (s <= least[:, :, None])] = -np.inf
            k = min(PROPOSALS, m - 1)
            best = np.argpartition(-s, k - 1, axis=2)[:, :, :k]
            score = np.take_along_axis(s, best, 2)
            b, i, j = np.nonzero(score > -np.inf)
            us.append(node[b, i])
            vs.append(node[b, best[b, i, j]])
            ss.append(score[b, i, j])
        if us:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(us)), pa.array(np.concatenate(vs)), pa.array(np.concatenate(ss).astype(np.float32))], names=["u", "v", "s"])
    tk.release_memory()


def _best(pairs: DataFrame) -> DataFrame:
    """(u, edges): the best different neighbours of each node. A pair is proposed wherever both meet, so it counts once
    before the limit, which works before the shuffle too."""
    once = pairs.groupBy("u", "v").agg(F.max("s").alias("s"))
    order = Window.partitionBy("u").orderBy(F.desc("s"), F.asc("v"))
    few = once.withColumn("n", F.row_number().over(order)).where(F.col("n") <= NEIGHBOURS)
    listed = few.groupBy("u").agg(F.array_sort(F.collect_list(F.struct((-F.col("s")).alias("far"), F.col("v")))).alias("edges"))
    return listed.select("u", "edges")


def back_edges(edges: DataFrame, seed: int) -> DataFrame:
    """(u, v): of the nodes v with an edge to u a bounded number, which hubs' tasks choose before the shuffle."""
    back = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
    some = Window.partitionBy("u").orderBy(F.xxhash64("v", F.lit(seed)))
    return back.withColumn("n", F.row_number().over(some)).where(F.col("n") <= NEIGHBOURS).drop("n")


def build_graph(spark: SparkSession, nodes: DataFrame, scratch: Scratch, n: int, rounds: int = ROUNDS) -> DataFrame:
    """(u, edges array<struct<far, v>>) from ``n`` ``nodes`` (node, x)."""
    bits = max(0, min(40, int(np.log2(max(1, n / BLOCK)))))
    first = None
    for t in range(TREES):
        coded = nodes.mapInArrow(_codes(bits, t), "node long, x binary, code long")
        sizes = coded.groupBy("code").agg(F.count(F.lit(1)).alias("size"))
        parted = coded.join(sizes, "code").withColumn("part", F.pmod(F.xxhash64("node", F.lit(t)), F.ceil(F.col("size") / BLOCK)).cast("int"))
        pairs = parted.groupBy("code", "part").applyInPandas(_within, "u long, v long, s float")
        first = pairs if first is None else first.union(pairs)
    graph = scratch.save(_best(first))
    for r in range(rounds):
        edges = graph.select("u", F.explode("edges").alias("e")).select("u", F.col("e.v").alias("v"))
        info = nodes.join(graph, nodes["node"] == graph["u"]).select(
            F.col("node").alias("v"), "x", F.when(F.size("edges") >= NEIGHBOURS, -F.element_at("edges", -1)["far"]).otherwise(F.lit(float("-1e30"))).cast("float").alias("worst")
        )
        met = edges.union(back_edges(edges, r)).distinct().join(info, "v").groupBy("u").agg(F.collect_list(F.struct("v", "worst", "x")).alias("met"))
        better = met.select("met").mapInArrow(_local_join, "u long, v long, s float")
        old = graph.select("u", F.explode("edges").alias("e")).select("u", F.col("e.v").alias("v"), (-F.col("e.far")).alias("s"))
        with batches_of(spark, JOIN_ROWS):
            after = scratch.save(_best(old.union(better)))
        scratch.drop(graph)
        scratch.release()
        graph = after
    return graph


STATE = "query_id long, q binary, pool array<long>, scores array<float>, done array<boolean>, frontier array<long>"


def _ragged(rows: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in rows]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(rows) if rows else [], kind))


def advance(ids: np.ndarray, scores: np.ndarray, done: np.ndarray, ef: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The pool of the ``ef`` best different nodes, those that were expanded, and the best of the others, which are next."""
    order = np.lexsort((ids, ~done))  # of one node the entry that was expanded, if there is one
    order = order[np.unique(ids[order], return_index=True)[1]]
    order = order[np.lexsort((ids[order], -scores[order]))][:ef]
    ids, scores, done = ids[order], scores[order], done[order].copy()
    next_ = np.flatnonzero(~done)[:EXPAND]
    done[next_] = True
    return ids, scores, done, ids[next_]


def _hop(ef: int, entries: np.ndarray, entry_x: np.ndarray, first: bool):
    """At ``first`` (query_id, q, own node), else a state and ``met``, the nodes reached with their vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            vectors = _matrix(b.column(1).to_pylist(), np.int16)
            out = []
            for k, q in enumerate(vectors):
                if first:
                    own = np.array([b.column(2)[k].as_py()], np.int64)
                    ids = np.concatenate((own, entries))
                    scores = np.concatenate(([q @ q], entry_x @ q)).astype(np.float32)
                    done = np.zeros(len(ids), bool)
                else:
                    ids, scores, done = (b.column(c)[k].values.to_numpy(zero_copy_only=False) for c in (2, 3, 4))
                    met = b.column(5)[k].values
                    if met is not None and len(met):
                        ids = np.concatenate((ids, met.field("v").to_numpy(zero_copy_only=False)))
                        found = _matrix(met.field("x").to_pylist(), np.int16) @ q
                        scores, done = np.concatenate((scores, found)).astype(np.float32), np.concatenate((done, np.zeros(len(found), bool)))
                out.append(advance(ids, scores, done, ef))
            kinds = (pa.int64(), pa.float32(), pa.bool_(), pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *[_ragged([r[j] for r in out], t) for j, t in enumerate(kinds)]], names=["query_id", "q", "pool", "scores", "done", "frontier"])
        tk.release_memory()

    return run


def walk(asked: DataFrame, nodes: DataFrame, graph: DataFrame, scratch: Scratch, ef: int) -> DataFrame:
    """The final states of ``asked`` (query_id, q, node), which go hop by hop together."""
    held = nodes.orderBy(F.xxhash64("node"), "node").limit(ENTRIES).collect()
    entries, entry_x = np.array([r["node"] for r in held], np.int64), _matrix([r["fine"] for r in held], np.int16)
    forward = graph.select("u", F.explode("edges").alias("e")).select("u", F.col("e.v").alias("v"))
    # Edges both ways, so that a node is reached from what is near it even if it is near to none of these.
    both = scratch.save(forward.union(back_edges(forward, -1)).groupBy(F.col("u").alias("node")).agg(F.collect_set("v").alias("to")))
    state = scratch.save(asked.select("query_id", "q", "node").mapInArrow(_hop(ef, entries, entry_x, True), STATE))
    finished = None
    for _ in range(HOPS):
        open_ = state.where(F.size("frontier") > 0)
        over = state.where(F.size("frontier") == 0)
        finished = over if finished is None else finished.unionByName(over)
        if open_.isEmpty():
            return finished
        reached = open_.select("query_id", F.explode("frontier").alias("node")).join(both, "node").select("query_id", F.explode("to").alias("v")).distinct()
        met = reached.join(nodes.select(F.col("node").alias("v"), F.col("fine").alias("x")), "v").groupBy("query_id").agg(F.collect_list(F.struct("v", "x")).alias("met"))
        rows = open_.join(met, "query_id", "left").select("query_id", "q", "pool", "scores", "done", "met")
        with batches_of(scratch.spark, HOP_ROWS):
            state = scratch.save(rows.mapInArrow(_hop(ef, entries, entry_x, False), STATE))
        scratch.release()
    return finished.unionByName(state)


def nearest(spark: SparkSession, table: DataFrame, is_query: str, *, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 20, ef: int = EF) -> DataFrame:
    """The k nearest rows found for each query by inner product: query_id, rank, vec_id, score. ``is_query``: SQL over vec_id."""
    scratch = Scratch(spark, "nn-descent")
    rows = scratch.save(usable(table, id_col, vector_col, zero=False))
    full = scratch.save(rows.groupBy("v").agg(F.min("vec_id").alias("node")).select("node", "v"))
    n, largest = full.select(F.count(F.lit(1)), F.max(F.expr("array_max(transform(v, x -> abs(x)))"))).head()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    scale = 1.0 / largest if largest > 1e-300 else 1.0
    nodes = scratch.save(full.mapInArrow(lambda b: _rounded(b, scale), "node long, x binary, fine binary"))
    graph = build_graph(spark, nodes.select("node", "x"), scratch, n)

    queries = one_per_id(rows.where(is_query)).withColumnRenamed("vec_id", "query_id")
    placed = scratch.save(queries.join(full, "v").select("query_id", "node", "v"))
    asked = placed.join(nodes, "node").select("query_id", F.col("fine").alias("q"), "node")
    keep = 3 * k + 8
    found = walk(asked, nodes, graph, scratch, max(ef, keep)).select("query_id", F.explode(F.slice("pool", 1, keep)).alias("node"))
    # Exact scores. A node stands for all rows of its vector: of each the k + 1 smallest ids, as one may be the query's own.
    pairs = found.join(full, "node").join(placed.select("query_id", F.col("v").alias("q")), "query_id")
    exact = pairs.select("query_id", "node", F.expr("aggregate(zip_with(q, v, (a, b) -> a * b), 0D, (s, x) -> s + x)").alias("score"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("node"))
    few = exact.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1).select("query_id", "node", "score")
    of_node = Window.partitionBy("node").orderBy("vec_id")
    members = rows.join(full, "v").select("node", "vec_id").withColumn("n", F.row_number().over(of_node)).where(F.col("n") <= k + 1).select("node", "vec_id")
    return ranked(few.join(members, "node").where("vec_id <> query_id").select("query_id", "vec_id", "score"), k, "double")


def op3_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(spark, spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "vec_id % 20 = 0")
