"""The audit of filters against runs of every order, and as SQL."""

import os
from collections import defaultdict
from itertools import permutations

import duckdb
import pytest
from pyspark.sql import functions as F

from folioframe.llm import filter_audit

SF = "/root/testdata/sf0.001"
LABELS = [(0, 1, 0), (8, 1, 1), (9, 0, 1), (9, 1, 0), (30, 1, None), (None, 1, 1), (12, 0, 0), (500, 1, 1), (14, 1, 0)]


def brute(rows, labels):
    """Runs the five filters one after another, for each order."""
    import re

    first = {}
    for d, t, _ in rows:
        if d is not None:
            first[t or ""] = min(d, first.get(t or "", d))
    good = {d for d, q, _ in labels if d is not None and q == 1}
    toxic = {d for d, _, x in labels if d is not None and x == 1}
    parts = defaultdict(list)
    for d, t, part in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = set()
        fails |= {"A"} if len(w) < 200 else set()
        fails |= {"B"} if 100 * len(set(w)) < 50 * len(w) else set()
        fails |= {"C"} if 100 * len(re.findall("[A-Z]", t)) > 3 * len(t) else set()
        fails |= {"D"} if re.search(r"[#$%&*|]", t) else set()
        fails |= {"E"} if d is not None and first[t] < d else set()
        parts[part or ""].append((d, fails))
    out = set()
    for part, docs in parts.items():
        shapley, rows_ = defaultdict(int), []
        for order in permutations("ABCDE"):
            left = docs
            for step, f in enumerate(order, 1):
                gone = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                failing = sum(f in x[1] for x in docs)
                shapley[f] += len(gone)
                rows_.append(("".join(order), step, len(left), len(gone), failing - len(gone), sum(x[1] == {f} for x in docs), sum(x[0] in good for x in gone), sum(x[0] in toxic for x in gone), f))
        out |= {(part, *r[:-1], shapley[r[-1]]) for r in rows_}
    return out


COLUMNS = "part filter_order step kept removed redundant unique_fails good_lost toxic_lost shapley".split()


def test_every_order(spark, docs, doc_rows, no_docs):
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int").withColumn("text", F.lit("clash"))
    got = filter_audit.audit_documents(docs, labels).select(*COLUMNS)
    assert got.columns == COLUMNS
    expected = brute([(r[0], r[1], r[2]) for r in doc_rows], LABELS)
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(expected) == 600 * len({r[0] for r in rows})
    assert set(rows) == expected
    assert filter_audit.audit_documents(no_docs, labels).count() == 0


def test_hot_copies_and_ties(spark):
    """A third of all rows is one text, some of them with equal ids: the rows of the least id are no copies."""
    rows = [(5, "Same #", "x"), (5, "Same #", "x")] + [(k, "Same #", "x") for k in range(6, 300)] + [(k, f"Text {k} " + "a b " * 150, "y") for k in range(1000, 1600)]
    got = filter_audit.audit_documents(spark.createDataFrame(rows, "doc_id int, text string, lang string"), spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert {tuple(r) for r in got.select(*COLUMNS).collect()} == brute(rows, [])


def test_long_text(spark):
    """Some megabytes of one text."""
    rows = [(1, "Word & " * 700_000, None)]
    got = filter_audit.audit_documents(spark.createDataFrame(rows, "doc_id int, text string, lang string"), spark.createDataFrame([(1, 1, 1)], "doc_id long, quality int, toxic int"))
    assert {tuple(r) for r in got.select(*COLUMNS).collect()} == brute(rows, [(1, 1, 1)])


def test_sql(spark):
    if not os.path.isdir(SF):
        pytest.skip("no tables")
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    expected = con.execute(filter_audit.OP13_SQL).fetchall()
    order = [d[0] for d in con.execute(filter_audit.OP13_SQL).description]
    assert sorted(order) == sorted(COLUMNS)
    assert sorted(map(tuple, filter_audit.op13_filter_audit(spark, SF).select(*order).collect())) == sorted(expected)
