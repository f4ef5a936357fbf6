"""Every query with SQL against DuckDB on the smallest tables, and what SQL cannot say on small fixtures."""

import os
from difflib import SequenceMatcher

import duckdb
import pytest
from pyspark.sql import functions as F

from folioframe.functions import text as t
from folioframe.operators import footnotes, names, sequence, validate
from folioframe.operators.select import parse_spec
from folioframe.plans import catalogue

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents pages benchmark labels conversations embeddings".split()


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return con


def rows(frame):
    """Rows in order of their text; a number that pandas widened for the sake of nulls counts as the integer it was."""
    names_ = sorted(frame.columns)
    values = frame[names_].astype(object).where(frame[names_].notna(), None).values.tolist()
    return sorted(repr([int(x) if isinstance(x, float) and x.is_integer() else x for x in r]) for r in values)


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_oracle(spark, duck, name):
    if not os.path.isdir(SF):
        pytest.skip("no tables")
    got, expected = catalogue.QUERIES[name](spark, SF).toPandas(), duck.execute(catalogue.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(expected.columns)
    assert rows(got) == rows(expected)


def test_spec():
    assert parse_spec("1,4-6,4") == [1, 4, 5, 6]
    for bad in ("", "a", "5-2"):
        with pytest.raises(ValueError):
            parse_spec(bad)


def test_coverage():
    assert validate._coverage("a b c d", "a x c d") == 0.75
    assert validate._coverage("", "x") == 1.0
    assert validate._coverage("a b", "") == 0.0


def test_fuzzy():
    assert names.most_similar("thach sanh", "xua co thach sanf o".split())[1] == "thach sanf"
    assert names.most_similar("thach sanh", "khong co gi".split()) is None


def test_fuzzy_in_whole_documents(spark, tmp_path):
    listed = ["Thach Sanh di", "Tam Cam va", "Ha ha x"]
    long = "xua co " * 300
    texts = [f"{long} thach sanf di", f"{long} tam cam va {long} tan cam va", "ha ha x", "thach sanh dj", long, None, ""]
    spark.createDataFrame([(k, f"{n} more words") for k, n in enumerate(listed)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    data = [(k, t, None if k == 3 else len(t or "")) for k, t in enumerate(texts)]
    spark.createDataFrame(data, "doc_id long, text string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    got = catalogue.QUERIES["name_fuzzy"](spark, str(tmp_path)).collect()
    hits = [(k, d, names.most_similar(n.lower(), (t or "").lower().split())) for k, n in enumerate(listed) for d, t in enumerate(texts)]
    expected = [(k, d, round(h[0], 6), h[1]) for k, d, h in hits if h]
    assert sorted(map(tuple, got)) == sorted(expected) and {(0, 0), (0, 3), (1, 1), (2, 2)} == {e[:2] for e in expected}


def test_likely_windows(monkeypatch):
    import random

    monkeypatch.setattr(names, "WORDS_AT_ONCE", 7)
    r = random.Random(4)
    word = lambda: "".join(r.choice("abé") for _ in range(r.randint(1, 4)))
    for _ in range(60):
        words, listed = [word() for _ in range(r.randint(0, 40))], [" ".join(word() for _ in range(r.randint(1, 3))) for _ in range(6)]
        for n, windows in zip(listed, names.likely_windows(listed, words, 0.7), strict=True):
            got = names.most_similar(n, words, 0.7, windows)
            every = [(SequenceMatcher(None, " ".join(words[a : a + s]), n, autojunk=False).ratio(), s == len(n.split()), -s, -a) for s in range(len(n.split()) - 1, len(n.split()) + 2) if s for a in range(len(words) - s + 1)]
            best = max(every, default=(0.0,))
            assert (got is None) == (best[0] < 0.7)
            if got:
                assert got == (best[0], " ".join(words[-best[3] : -best[3] - best[2]]), -best[3])


def test_tiers(spark):
    q = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    a, b = spark.createDataFrame([(1, "x")], "k int, v string"), spark.createDataFrame([(1, "y"), (2, "z"), (2, "w")], "k int, v string")
    got = sequence.first_match_by_tier(q, "k", [a, b]).collect()
    assert sorted(tuple(r) for r in got) == [(1, "x", 1), (2, "w", 2), (2, "z", 2)]


def test_empty_gap_islands(spark):
    df = spark.createDataFrame([], "k int, p int")
    assert sequence.gap_islands(df, ["k"], "p", 3).count() == 0


def test_ranges_without_owner(spark):
    points = spark.createDataFrame([(1, 5), (1, 70), (1, 64), (2, 5), (1, -3), (None, 5), (1, None)], "k int, at int")
    ranges = spark.createDataFrame([(1, 0, 130, "a", 1), (1, 60, 64, "b", 2), (1, 9, 8, "none", 3), (1, -70, -2, "c", 4)], "k int, s int, e int, owner string, n int")
    got = {(r["k"], r["at"]): r["owner"] for r in sequence.range_owner(points, ranges, ["k"], "at", "s", "e", "owner", "n").collect()}
    assert got == {(1, 5): "a", (1, 70): "a", (1, 64): "b", (2, 5): None, (1, -3): "c", (None, 5): None, (1, None): None}


def test_second_tier_and_none(spark, tmp_path):
    rows = [(1, "red ring"), (2, "red"), (3, "blue"), (4, None)]
    spark.createDataFrame(rows, "p_partkey long, p_name string").write.parquet(f"{tmp_path}/part.parquet")
    got = catalogue.QUERIES["alias_resolution"](spark, str(tmp_path)).collect()
    assert {(r["p_partkey"], r["target"], r["tier"]) for r in got} == {(1, 1, 1), (2, 2, 1), (3, 3, 1), (4, None, None)}
    q = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    first, second = spark.createDataFrame([("a", 1)], "k string, v int"), spark.createDataFrame([("a", 2), ("b", 3)], "k string, v int")
    assert {tuple(r) for r in sequence.first_match_by_tier(q, "k", [first, second]).collect()} == {("a", 1, 1), ("b", 3, 2)}


def test_numbers_as_printed(spark):
    got = spark.createDataFrame([(0.1235,), (0.0005,), (2.5,), (None,)], "x double").select(t.fixed_point(3)("x").alias("y")).collect()
    assert [r["y"] for r in got] == ["0.123", "0.001", "2.500", None]


def test_numbers_of_notes(spark):
    value = "1 Theo 4465758382889437 x 99999999999 A. 2 B."
    n = spark.createDataFrame([(value,)], "x string").select(footnotes.split_notes(F.col("x")).alias("n")).head()["n"]
    assert [(x["num"], x["continued"]) for x in n] == [(1, False), (2, False)]


def test_no_local_folder_on_a_cluster(spark, monkeypatch):
    from types import SimpleNamespace

    from folioframe import scratch

    conf = SimpleNamespace(get=lambda key, default=None: default)
    for master, ok in (("local[4]", True), ("local", True), ("local-cluster[2,1,1024]", False), ("yarn", False), ("spark://host:7077", False)):
        session = SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))
        if ok:
            assert scratch.shared_dir(session).startswith("file://")
        else:
            with pytest.raises(RuntimeError):
                scratch.shared_dir(session)


def test_missing_manifests(spark, tmp_path):
    from folioframe.sources import layout as source

    for name, text in (("a", '{"n": 1}'), ("b", ""), ("c", "no json")):
        (tmp_path / name).mkdir()
        (tmp_path / name / "table_of_contents.json").write_text(text)
    found = source.read_manifests(spark, str(tmp_path), "n int")
    expected = [f"file:{tmp_path}/{n}/table_of_contents.json" for n in "abcd"]
    got = {r["path"].split("/")[-2]: (r["status"], r["manifest"] and r["manifest"]["n"]) for r in source.with_missing(spark, found.withColumn("path", F.regexp_replace("path", "^file:/+", "file:/")), expected).collect()}
    assert {k: v[0] for k, v in got.items()} == {"a": "OK", "b": "EMPTY", "c": "UNREADABLE", "d": "MISSING"} and got["a"][1] == 1
