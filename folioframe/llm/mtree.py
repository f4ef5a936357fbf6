"""Exact top-k by inner product over integer vectors with M-trees of paged nodes and best-first search.

Vectors become points of a metric space: one more coordinate lifts all candidates to one length, so that the nearest
point by Euclidean distance is the one of the largest inner product. A bounded number of routing points, those of least
hash, part the candidates; a part has a covering radius and is dealt to shards of a bounded number of points. Each
shard is bulk-loaded into an M-tree and written as a table of pages. An entry of a page holds its point, its distance to
the page's own routing point and, above the leaves, a covering radius.

A query first searches one shard of its nearest part. The k-th best there bounds the rest: shards of parts that the
distance to the routing point and the radius rule out are never visited, the others start from that bound. Within a
tree pages are visited in order of the least possible distance, and entries whose stored distances rule them out by the
triangle inequality are passed over without computing their distance.

Scores are exact integers; distances, on coordinates scaled to at most 1, only rule out, with a margin above rounding.

Defined results: vectors that are null, or hold null or non-finite components, or have another length than most, take
no part; the zero vector does; rows of one id are candidates of their own, a query of several rows uses the least
vector and meets no row of its own id; ties go to the smaller id; with fewer candidates than k all are returned; scores
that 64 bits can't hold are given as the nearest number that fits, and rank as that; an empty table gives no rows. Other
columns are ignored.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioframe.llm.vectors import one_per_id, ranked, usable
from folioframe.scratch import Scratch

PAGE = 64
SHARD = 4096
ROUTES = 1024
QUERY_BLOCK = 1024
MARGIN = 1e-6
LEAST, MOST = -(2**63), 2**63 - 1
PAGES = "shard int, page int, leaf boolean, ids binary, vectors binary, child binary, radius binary, to_parent binary"
FOUND = "query_id long, vec_id long, score long"


class Space:
    """The integers that stand for vectors, and the coordinates that distances are computed on."""

    def __init__(self, scale: int, largest: float, d: int):
        self.scale, self.d = scale, d
        self.exponent = max(0, math.frexp(largest)[1])
        bound = (largest * scale + 1) ** 2 * d if largest < 2.0**400 else math.inf
        self.exact = bound < 2.0**62  # products and sums fit 64 bits
        self.top = 0.0

    def integers(self, v: np.ndarray) -> np.ndarray:
        if self.exact:
            return np.floor(self.scale * v).astype(np.int64)
        whole = [[math.floor(x * self.scale) if abs(x) < 2.0**900 else int(x) * self.scale for x in row] for row in v.tolist()]
        return np.array(whole, dtype=object).reshape(len(v), self.d)

    def coordinates(self, v: np.ndarray) -> np.ndarray:
        """Near the integers, divided by the scale and a power of two."""
        small = np.abs(v) < 2.0**40
        return np.ldexp(np.where(small, np.floor(np.where(small, v, 0.0) * self.scale) / self.scale, v), -self.exponent)

    def lifted(self, v: np.ndarray) -> np.ndarray:
        x = self.coordinates(v)
        return np.column_stack((x, np.sqrt(np.maximum(self.top - (x * x).sum(1), 0.0))))

    def least_square(self) -> str:
        """SQL of a bound on the squared length of the coordinates of ``v``."""
        unit = repr(math.ldexp(1.0, -self.exponent))
        return f"aggregate(v, 0D, (s, x) -> s + pow((abs(x) + {1 / self.scale!r}D) * {unit}D, 2))"

    def reach(self, qq: float, score: int | None) -> float:
        """The distance beyond which no point of at least that score lies."""
        if score is None or score <= LEAST:
            return math.inf
        square = qq + self.top - 2.0 * math.ldexp(float(score) / self.scale / self.scale, -2 * self.exponent)
        return math.sqrt(max(square, 0.0)) + MARGIN * (1.0 + math.sqrt(qq + self.top))


def _distances(points: np.ndarray, squares: np.ndarray, p: np.ndarray, p_square: float) -> np.ndarray:
    return np.sqrt(np.maximum(squares + p_square - 2.0 * (points @ p), 0.0))


def bulk_load(full: np.ndarray, page: int = PAGE, seed: int = 7) -> list[dict]:
    """Pages of an M-tree over the points ``full``, the root first; ``rows`` are the points' numbers."""
    squares = (full * full).sum(1)
    rng = np.random.default_rng(seed)
    pages: list[dict] = []

    def make(rows: np.ndarray, routing: int | None) -> int:
        """The page number of a subtree over ``rows``; ``routing`` is the point that the entry above holds."""
        me = len(pages)
        pages.append({})
        to_parent = (lambda r: _distances(full[r], squares[r], full[routing], squares[routing])) if routing is not None else (lambda r: np.zeros(len(r)))
        if len(rows) <= page:
            pages[me] = {"leaf": True, "rows": rows, "child": np.full(len(rows), -1), "radius": np.zeros(len(rows)), "to_parent": to_parent(rows)}
            return me
        k = min(page, -(-len(rows) // page) + 1)
        pivots = rng.choice(rows, k, replace=False)
        d = np.stack([_distances(full[rows], squares[rows], full[p], squares[p]) for p in pivots], 1)
        near = d.argmin(1)
        sizes = np.bincount(near, minlength=k)
        if sizes.max() > 0.9 * len(rows):  # points that no pivot parts, such as equal ones: even parts
            near = np.arange(len(rows)) % k
            sizes = np.bincount(near, minlength=k)
        keep = [j for j in range(k) if sizes[j]]
        children, radius = [], []
        for j in keep:
            part = near == j
            radius.append(d[part, j].max())
            children.append(make(rows[part], int(pivots[j])))
        held = pivots[keep]
        pages[me] = {"leaf": False, "rows": held, "child": np.array(children), "radius": np.array(radius), "to_parent": to_parent(held)}
        return me

    if len(full):
        make(np.arange(len(full)), None)
    return pages


def search(pages: list[dict], space: Space, vector: np.ndarray, own: int, k: int, floor: int | None = None, counted: list[int] | None = None) -> list[tuple[int, int]]:
    """The k best (score, id) of a tree, without rows of the id ``own`` and without what scores below ``floor``; ``pages``
    as ``_load`` gives them. ``counted`` gets the number of distances computed at each page."""
    query = space.integers(vector[None, :])[0]
    q = np.append(space.coordinates(vector), 0.0)
    qq = float(q @ q)
    best: list[tuple[int, int]] = []  # a heap of (score, -id): the worst on top
    limit = space.reach(qq, floor)
    queue: list[tuple[float, int, float]] = [(0.0, 0, -1.0)] if pages else []
    while queue:
        least, number, to_routing = heapq.heappop(queue)
        if least > limit:
            break
        p = pages[number]
        use = slice(None)
        if to_routing >= 0 and limit < math.inf:
            use = np.flatnonzero(np.abs(to_routing - p["to_parent"]) - p["radius"] <= limit)
            if not len(use):
                continue
        d = np.sqrt(np.maximum(p["squares"][use] + qq - 2.0 * (p["full"][use] @ q), 0.0))
        if counted is not None:
            counted.append(len(d))
        if not p["leaf"]:
            low = np.maximum(d - p["radius"][use], 0.0)
            for j in np.flatnonzero(low <= limit):
                heapq.heappush(queue, (float(low[j]), int(p["child"][use][j]), float(d[j])))
            continue
        near = np.flatnonzero(d <= limit)
        if not len(near):
            continue
        scores = p["integers"][use][near] @ query
        for score, i in zip(scores.tolist(), p["ids"][use][near].tolist(), strict=True):
            if i == own:
                continue
            score = min(MOST, max(LEAST, score))
            if len(best) < k:
                heapq.heappush(best, (score, -i))
            elif (score, -i) > best[0]:
                heapq.heapreplace(best, (score, -i))
        if len(best) == k:
            # What lies beyond the k-th best, with room for rounding, can't even tie.
            limit = min(limit, space.reach(qq, best[0][0]))
    return [(s, -i) for s, i in best]


def _vectors(column) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


def _route(space: Space, points: np.ndarray):
    """Adds each row's nearest routing point and the distance to it."""
    squares = (points * points).sum(1)

    def run(batches):
        for b in batches:
            if len(b):
                full = space.lifted(_vectors(b["v"]))
                far = np.sqrt(np.maximum((full * full).sum(1)[:, None] + squares - 2.0 * (full @ points.T), 0.0))
                near = far.argmin(1)
                yield b.assign(route=near.astype(np.int32), far=far[np.arange(len(b)), near])

    return run


def _build(space: Space, page: int):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("vec_id", kind="stable")
        ids, v = rows["vec_id"].to_numpy(np.int64), _vectors(rows["v"])
        out = []
        for n, p in enumerate(bulk_load(space.lifted(v), page)):
            r = p["rows"]
            out.append((int(key[0]), n, p["leaf"], ids[r].tobytes(), v[r].tobytes(), p["child"].astype(np.int64).tobytes(), p["radius"].tobytes(), p["to_parent"].tobytes()))
        return pd.DataFrame(out, columns=["shard", "page", "leaf", "ids", "vectors", "child", "radius", "to_parent"])

    return run


def _load(rows: pd.DataFrame, space: Space) -> list[dict]:
    out = []
    for r in rows.sort_values("page").itertuples():
        v = np.frombuffer(r.vectors, np.float64).reshape(-1, space.d)
        full = space.lifted(v)
        out.append(
            {
                "leaf": r.leaf, "ids": np.frombuffer(r.ids, np.int64), "integers": space.integers(v) if r.leaf else None, "full": full, "squares": (full * full).sum(1),
                "child": np.frombuffer(r.child, np.int64), "radius": np.frombuffer(r.radius, np.float64), "to_parent": np.frombuffer(r.to_parent, np.float64),
            }
        )
    return out


def _answer(space: Space, k: int):
    def run(key: tuple, pages: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        tree = _load(pages, space) if len(queries) else []
        found = []
        for q, v, floor in zip(queries["vec_id"].tolist(), queries["v"], queries["floor"], strict=True):
            found += [(q, i, s) for s, i in search(tree, space, np.asarray(v, np.float64), q, k, None if floor is None or pd.isna(floor) else int(floor))]
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"], dtype="int64")

    return run


def _shards(space: Space, points: np.ndarray, radius: np.ndarray, first_shard: np.ndarray, n_shards: np.ndarray, first: bool):
    """The shards that a query visits: one of its nearest part at ``first``, then all others that may hold a row of at
    least the score ``floor``. A null floor rules nothing out."""
    squares = (points * points).sum(1)

    def run(batches):
        for b in batches:
            ids, vs, floors, shards = [], [], [], []
            for q, v, floor in zip(b["vec_id"].tolist(), b["v"], b["floor"], strict=True):
                x = np.append(space.coordinates(np.asarray(v, np.float64)), 0.0)
                qq = float(x @ x)
                far = _distances(points, squares, x, qq)
                near = int(far.argmin())
                own = int(first_shard[near] + q % n_shards[near])
                if first:
                    to = [own]
                else:
                    score = None if floor is None or floor == "" else int(floor)
                    open_ = np.flatnonzero(far - radius <= space.reach(qq, score))
                    to = [int(s) for r in open_ for s in range(first_shard[r], first_shard[r] + n_shards[r]) if s != own]
                ids += [q] * len(to)
                vs += [v] * len(to)
                floors += [floor or None] * len(to)
                shards += to
            yield pd.DataFrame({"vec_id": pd.Series(ids, dtype="int64"), "v": pd.Series(vs, dtype=object), "floor": pd.Series(floors, dtype=object), "shard": pd.Series(shards, dtype="int32")})

    return run


def top_k(
    spark: SparkSession, table: DataFrame, is_query: str, *, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 10, scale: int = 1024, shard: int = SHARD, page: int = PAGE, routes: int = ROUTES
) -> DataFrame:
    """The k rows of the largest inner product of each query: query_id, rank, vec_id, score. ``is_query``: SQL over vec_id."""
    scratch = Scratch(spark, "mtree")
    rows = scratch.save(usable(table, id_col, vector_col, zero=True))
    n, largest, d = rows.select(F.count(F.lit(1)), F.max(F.expr("array_max(transform(v, x -> abs(x)))")), F.max(F.size("v"))).head()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    space = Space(scale, largest, d)
    space.top = float(rows.select(F.max(F.expr(space.least_square()))).head()[0])
    # Routing points: at most ``routes``, whatever the number of rows; larger parts have several shards.
    held = rows.orderBy(F.xxhash64("vec_id", "v"), "vec_id", "v").select("v").limit(min(routes, max(1, -(-n // shard)))).collect()
    points = space.lifted(np.array([r["v"] for r in held], np.float64))
    routed = scratch.save(rows.mapInPandas(_route(space, points), "vec_id long, v array<double>, route int, far double"))
    parts = {r["route"]: r for r in routed.groupBy("route").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("far")).collect()}
    number = np.array([-(-parts[r]["n"] // shard) if r in parts else 0 for r in range(len(points))])
    radius = np.array([parts[r]["far"] * (1 + 1e-9) + MARGIN if r in parts else -math.inf for r in range(len(points))])
    points, radius, kept = points[number > 0], radius[number > 0], np.flatnonzero(number > 0)
    number = number[kept]
    start = np.cumsum(number) - number
    dealing = spark.createDataFrame([(int(r), int(s), int(m)) for r, s, m in zip(kept, start, number, strict=True)], "route int, start int, number int")
    dealt = routed.join(F.broadcast(dealing), "route").select("vec_id", "v", (F.col("start") + F.pmod(F.xxhash64("vec_id", "v"), F.col("number"))).cast("int").alias("shard"))
    pages = scratch.save(dealt.groupBy("shard").applyInPandas(_build(space, page), PAGES))

    queries = scratch.save(one_per_id(rows.where(is_query)))
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    copies = pages.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def asked(with_floor: DataFrame, first: bool) -> DataFrame:
        to = with_floor.mapInPandas(_shards(space, points, radius, start, number, first), "vec_id long, v array<double>, floor string, shard int")
        to = to.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
        return copies.groupBy("shard", "block").cogroup(to.groupBy("shard", "block")).applyInPandas(_answer(space, k), FOUND)

    near = scratch.save(asked(queries.withColumn("floor", F.lit(None).cast("string")), True))
    # A floor is known where the first shard gave k rows; it goes as text, since null would turn numbers into doubles.
    floors = near.groupBy(F.col("query_id").alias("vec_id")).agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).cast("string").alias("floor"))
    far = asked(queries.join(floors, "vec_id", "left").select("vec_id", "v", "floor"), False)
    return ranked(near.unionByName(far), k, "long")


def op9_mtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(spark, spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "vec_id % 100 = 0")


OP9_SQL = """
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0),
sized AS (SELECT * FROM usable WHERE len(x) = (SELECT len(x) FROM usable GROUP BY len(x) ORDER BY count(*) DESC, len(x) LIMIT 1)),
queries AS (SELECT vec_id, min(x) AS x FROM sized WHERE vec_id % 100 = 0 GROUP BY vec_id),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.x, c.x), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM queries q JOIN sized c ON q.vec_id <> c.vec_id),
numbered AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM scored)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM numbered WHERE n <= 10
"""
