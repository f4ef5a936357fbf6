"""Ranked search against a scan of all documents, and as SQL."""

import math
import os
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from folioframe.llm import lexical

SF = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def brute(docs, items, k=20):
    counted = [(d, Counter(terms(t))) for d, t in docs]
    counted = [(d, c, sum(c.values())) for d, c in counted if c]
    big_n, big_l = len(counted), sum(n for _, _, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    out = []
    for item, text in items:
        asked = Counter(terms(text))
        scores = []
        for d, c, n in counted:
            m = 75 + 25 * n * big_n // big_l
            s = sum(times * math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t, times in asked.items() if t in c)
            if s > 0:
                scores.append((-s, d is None, d or 0, d))
        out += [(item, rank, x[3], -x[0]) for rank, x in enumerate(sorted(scores, key=lambda x: x[:3])[:k], 1)]
    return out


def run(spark, docs, items, **how):
    shard_bytes = how.pop("shard_bytes", lexical.SHARD_BYTES)
    index, n, _ = lexical.build_index(spark, docs, shard_bytes=shard_bytes)
    return [tuple(r) for r in lexical.search(spark, index, n, items, **how).collect()]


def key(r):
    return tuple((x is None, x) for x in r)


def test_edges(spark, docs, doc_rows, no_docs):
    """Nulls, empty and long texts, ties, repeated rows, clashing columns; several shards and blocks of queries."""
    words = terms(" ".join(r[1] or "" for r in doc_rows))
    r = random.Random(1)
    items = [(k, " ".join(r.choice(words) for _ in range(r.randrange(1, 12)))) for k in range(12)]
    items += [(50, None), (51, ""), (52, "zzzz"), (53, "THE the tHe"), (None, "an the"), (53, "qu ß É"), (54, doc_rows[8][1]), (55, "4111 a.b")]
    table = spark.createDataFrame([(i, t, 0, "x") for i, t in items], "item_id int, text string, doc_id int, rank string")
    expected = brute([(x[0], x[1]) for x in doc_rows], items)
    for shard_bytes, block_terms in ((lexical.SHARD_BYTES, lexical.BLOCK_TERMS), (300, 20), (5000, 1)):
        assert sorted(run(spark, docs, table, shard_bytes=shard_bytes, block_terms=block_terms), key=key) == sorted(expected, key=key)
    assert run(spark, no_docs, table) == []
    assert run(spark, docs, table.where("item_id = 51")) == []


def test_equal_copies(spark):
    """Hundreds of equal documents: the smallest ids win."""
    rows = [(k, "the same old words") for k in range(500, 0, -1)] + [(1000 + k, f"other words {k}") for k in range(100)]
    items = [(1, "old words"), (2, "same")]
    got = run(spark, spark.createDataFrame(rows, "doc_id int, text string").repartition(5), spark.createDataFrame(items, "item_id int, text string"), shard_bytes=700, k=7)
    assert sorted(got) == sorted(brute(rows, items, 7))
    assert [x[2] for x in sorted(got) if x[0] == 2] == [1, 2, 3, 4, 5, 6, 7]


def one_shard(rows):
    raw = [t.encode() for _, t in rows]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in raw])])
    return lexical.term_counts(np.frombuffer(b"".join(raw), np.uint8), offsets), len(rows)


def test_tree_passes_over():
    """Documents of two vocabularies: the bounds rule out the subtrees of the other one, and the result stays exact."""
    import pyarrow as pa

    r = random.Random(3)
    vocabulary = [[f"{c}{k}" for k in range(300)] for c in "ab"]
    rows = [(k, " ".join(r.choices(vocabulary[k % 2], weights=[1 / (j + 1) for j in range(300)], k=r.randrange(5, 60)))) for k in range(2000)]
    (doc, term, tf), n = one_shard(rows)
    total = int(tf.sum())
    place, arrays = lexical.build_shard(doc, term, tf, n, n, total)
    shard = lexical.Shard({"documents": pa.scalar(n), "ids": pa.scalar(place.tobytes()), "has_id": pa.scalar(b"\1" * n), **{k: pa.scalar(v.tobytes()) for k, v in arrays.items()}})
    for text in ("a250 a7 a8 a9", "b299 b4", "a1 a1 b2"):
        asked = Counter(terms(text))
        own = lexical._occurrences(np.frombuffer(" ".join(asked).encode(), np.uint8), np.array([0, len(" ".join(asked))]))[1]
        lists = np.searchsorted(shard.terms, own)
        df = np.diff(shard.begin)[lists]
        weights = np.array([t * math.floor(1000 * math.log((2 * n + 2) / (2 * int(d) + 1))) for t, d in zip(asked.values(), df, strict=True)])
        for nodes in (4, 128):
            counted = []
            numbers, scores = shard.search(lists, weights, 10, 1, nodes=nodes, counted=counted)
            got = sorted(zip((-scores).tolist(), shard.ids[numbers].tolist(), strict=True))[:10]
            assert [(i, -s) for s, i in got] == [(d, s) for _, _, d, s in brute(rows, [(0, text)], 10)]
            if nodes == 4 and text.startswith("a250"):
                assert sum(counted) < 1000  # of about 4000 nodes


def test_long_text(spark):
    """A text of some megabytes goes in blocks, and counts as if whole."""
    long = "alpha beta gammÄ " * 200_000
    raw = np.frombuffer(long.encode(), np.uint8)
    for block in (1000, 1 << 20):
        doc, term, tf = lexical.term_counts(raw, np.array([0, len(raw)]), block)
        assert sorted(tf.tolist()) == [200_000] * 3
    rows = [(1, long), (2, "alpha"), (3, "beta beta delta")]
    items = [(9, "alpha beta delta")]
    assert sorted(run(spark, spark.createDataFrame(rows, "doc_id int, text string"), spark.createDataFrame(items, "item_id int, text string"))) == sorted(brute(rows, items))


def test_large_lengths():
    """m beyond 64 bits in between."""
    n = np.array([10**9, 5])
    assert lexical.length_terms(n, 10**12, 10**13).tolist() == [75 + 25 * 10**9 * 10**12 // 10**13, 75 + 25 * 5 * 10**12 // 10**13]


def test_sql(spark):
    if not os.path.isdir(SF):
        pytest.skip("no tables")
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    got = lexical.op11_lexical(spark, SF)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect())) == sorted(con.execute(lexical.OP11_SQL).fetchall())
