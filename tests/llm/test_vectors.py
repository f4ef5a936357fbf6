import numpy as np
import pytest

from folioframe.llm import mtree, nn_descent

SCHEMA = "vec_id long, embedding array<float>, label int, score double, node int"


def rows(n=300, d=8, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)).astype(np.float32)
    x[10:40] = x[0]  # one very common vector
    out = [(k, [float(y) for y in v], 0, 0.0, 1) for k, v in enumerate(x)]
    out += [(n, None, 0, 0.0, 1), (n + 1, [None] * d, 0, 0.0, 1), (n + 2, [float("nan")] * d, 0, 0.0, 1), (n + 3, [float("inf")] * d, 0, 0.0, 1), (n + 4, [0.0] * d, 0, 0.0, 1), (n + 5, [1.0], 0, 0.0, 1), (None, [1.0] * d, 0, 0.0, 1), (n + 6, [], 0, 0.0, 1)]
    out.append(out[5])
    return out


def usable(rs, d=8, zero=True):
    return [(r[0], np.array(r[1], np.float64)) for r in rs if r[0] is not None and r[1] and len(r[1]) == d and None not in r[1] and np.isfinite(r[1]).all() and (zero or np.any(r[1]))]


@pytest.mark.parametrize(("shard", "routes"), [(40, 1024), (40, 2), (4096, 1024)])
def test_mtree(spark, shard, routes):
    rs = rows()
    data = [(k, np.floor(1024 * v).astype(int)) for k, v in usable(rs)]
    expected = []
    for q, x in {k: v for k, v in data if k % 50 == 0}.items():
        best = sorted(((-int(x @ v), k) for k, v in data if k != q))[:10]
        expected += [(q, n, k, -s) for n, (s, k) in enumerate(best, 1)]
    out = mtree.top_k(spark, spark.createDataFrame(rs, SCHEMA).repartition(3), "vec_id % 50 = 0", shard=shard, page=8, routes=routes).collect()
    assert sorted(map(tuple, out)) == sorted(expected)
    assert mtree.top_k(spark, spark.createDataFrame([], SCHEMA), "vec_id % 50 = 0").count() == 0


def test_pages_pass_over():
    """Clusters: the bounds rule out most distances, and the result stays exact."""
    rng = np.random.default_rng(1)
    x = np.floor(np.repeat(rng.normal(size=(20, 6)) * 1000, 50, axis=0) + rng.normal(size=(1000, 6)))
    space = mtree.Space(1, float(np.abs(x).max()), 6)
    space.top = float((space.coordinates(x) ** 2).sum(1).max())
    full = space.lifted(x)
    pages = mtree.bulk_load(full, page=16)
    for p in pages:
        r = p["rows"]
        p |= {"ids": r, "integers": x[r].astype(np.int64), "full": full[r], "squares": (full[r] * full[r]).sum(1)}
    whole, bounded = [], []
    for q in range(0, 1000, 111):
        best = [(-s, k) for s, k in sorted((-int(x[q] @ x[k]), k) for k in range(1000) if k != q)[:5]]
        assert sorted(mtree.search(pages, space, x[q], q, 5, counted=whole), key=lambda t: (-t[0], t[1])) == best
        got = mtree.search(pages, space, x[q], q, 5, floor=best[-1][0], counted=bounded)
        assert sorted(got, key=lambda t: (-t[0], t[1])) == best
    assert sum(bounded) <= sum(whole) < 0.5 * 10 * sum(len(p["rows"]) for p in pages)


def test_shards_passed_over():
    """Two far clusters: with a floor a query visits only the shards of its own."""
    import pandas as pd

    x = np.array([[100.0, 0.0], [0.0, 100.0]])
    space = mtree.Space(1, 100.0, 2)
    space.top = float((space.coordinates(x) ** 2).sum(1).max())
    run = mtree._shards(space, space.lifted(x), np.array([0.05, 0.05]), np.array([0, 3]), np.array([3, 2]), False)
    ask = lambda floor: next(run([pd.DataFrame({"vec_id": [1], "v": [x[0]], "floor": [floor]})]))["shard"].tolist()
    assert ask(None) == [0, 2, 3, 4] and ask("9000") == [0, 2]


def test_large_components(spark):
    """Products beyond 64 bits neither crash nor lose order among those that fit."""
    rs = [(0, [4e6, 1.0]), (1, [4e6, 2.0]), (2, [1e300, 0.0]), (3, [-1e308, 5.0]), (4, [1.5, 0.25]), (5, [0.0, 0.0]), (6, [-3.0, 1e-300]), (50, [1.0, -1.0])]
    ints = lambda v: [int(np.floor(1024 * y)) if abs(y) < 2.0**900 else int(y) * 1024 for y in v]
    clip = lambda s: min(2**63 - 1, max(-(2**63), s))
    expected = []
    for q, x in rs:
        if q % 50 == 0:
            best = sorted((-clip(sum(a * b for a, b in zip(ints(x), ints(v)))), k) for k, v in rs if k != q)[:10]
            expected += [(q, n, k, -s) for n, (s, k) in enumerate(best, 1)]
    table = spark.createDataFrame(rs, "vec_id long, embedding array<double>")
    for shard in (2, 4096):
        out = mtree.top_k(spark, table, "vec_id % 50 = 0", shard=shard, page=2).collect()
        assert sorted(map(tuple, out)) == sorted(expected)


def test_nn_descent(spark):
    rs = rows(400)
    data = usable(rs, zero=False)
    out = nn_descent.nearest(spark, spark.createDataFrame(rs, SCHEMA).repartition(3), "vec_id % 20 = 0").collect()
    found, hit, total = {}, 0, 0
    for r in out:
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    for q, x in {k: v for k, v in data if k % 20 == 0}.items():
        best = sorted(((-float(x @ v), k) for k, v in data if k != q))[:20]
        got = sorted(found[q])
        assert [n for n, _, _ in got] == list(range(1, len(got) + 1)) and len(got) == 20
        assert all(any(k == i and abs(s - float(x @ v)) < 1e-9 for i, v in data) for _, k, s in got)
        hit += len({k for _, k in best} & {k for _, k, _ in got})
        total += 20
    assert hit / total >= 0.95
    assert nn_descent.nearest(spark, spark.createDataFrame([], SCHEMA), "vec_id % 20 = 0").count() == 0


@pytest.mark.parametrize("n", [1, 2, 15])
def test_fewer_candidates_than_wanted(spark, n):
    """All there are, in order, also where components are as large as doubles get."""
    rng = np.random.default_rng(n)
    x = np.concatenate((rng.normal(size=(n - n // 3, 4)), 1e150 * rng.normal(size=(n // 3, 4))))
    out = nn_descent.nearest(spark, spark.createDataFrame([(k, v) for k, v in enumerate(x.tolist())], "vec_id long, embedding array<double>"), "vec_id % 20 = 0").orderBy("rank").collect()
    scores = [sum(float(a) * float(b) for a, b in zip(x[0], v)) for v in x]
    best = sorted(range(1, n), key=lambda k: (-scores[k], k))
    assert [r["vec_id"] for r in out] == best and np.allclose([r["score"] for r in out], [scores[k] for k in best], rtol=1e-12, atol=0)


def recall(x, step, out):
    s = x[::step] @ x.T
    s[np.arange(len(s)), np.arange(0, len(x), step)] = -np.inf
    best = np.argsort(-s, axis=1)[:, :20]
    return sum(len(set(b.tolist()) & set(out.loc[out["query_id"] == step * k, "vec_id"])) for k, b in enumerate(best)) / best.size


@pytest.mark.parametrize("clusters", [12, 48])
def test_nn_descent_on_clusters(spark, clusters):
    """Tight clusters, far from each other: nodes keep their edges, and a walk gets what lies in the query's cluster."""
    from folioframe.scratch import Scratch

    rng = np.random.default_rng(3)
    x = np.repeat(rng.normal(size=(clusters, 32)), 2400 // clusters, axis=0) + 0.05 * rng.normal(size=(2400, 32))
    x = (x / np.linalg.norm(x, axis=1)[:, None]).astype(np.float32).astype(np.float64)
    table = spark.createDataFrame([(k, v) for k, v in enumerate(x.tolist())], "vec_id long, embedding array<double>").repartition(3)
    assert recall(x, 20, nn_descent.nearest(spark, table, "vec_id % 20 = 0").toPandas()) >= 0.95
    nodes = spark.createDataFrame([(k, v) for k, v in enumerate(nn_descent.packed(x))], "node long, x binary")
    edges = nn_descent.build_graph(spark, nodes, Scratch(spark, "clusters"), 2400).toPandas()["edges"]
    assert len(edges) == 2400 and edges.map(len).min() == nn_descent.NEIGHBOURS
    assert edges.map(lambda e: len({v["v"] for v in e})).min() == nn_descent.NEIGHBOURS


def test_recall_on_ten_thousand(spark):
    x = np.random.default_rng(8).normal(size=(10_000, 32))
    x = (x / np.linalg.norm(x, axis=1)[:, None]).astype(np.float32).astype(np.float64)
    table = spark.createDataFrame([(k, v) for k, v in enumerate(x.tolist())], "vec_id long, embedding array<double>").repartition(4)
    assert recall(x, 100, nn_descent.nearest(spark, table, "vec_id % 100 = 0").toPandas()) >= 0.9


def test_advance():
    ids, scores, done = np.array([5, 3, 5, 9, 1]), np.array([0.5, 0.9, 0.5, 0.1, 0.9], np.float32), np.array([True, False, False, False, False])
    pool, s, d, frontier = nn_descent.advance(ids, scores, done, 3)
    assert pool.tolist() == [1, 3, 5] and frontier.tolist() == [1, 3] and d.tolist() == [True, True, True]
