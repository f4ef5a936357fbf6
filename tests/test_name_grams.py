"""Names by shared grams against every name in every text."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioframe.operators import name_grams, name_pieces, names


def similar_by_all(listed, texts, threshold):
    hits = [(k, d, names.most_similar(n.lower(), t.lower().split(), threshold)) for k, n in listed if n for d, t in texts if t]
    return sorted(((k, d, round(h[0], 6), h[1]) for k, d, h in hits if h), key=repr)


def random_case(r, alphabet, n_names, n_texts):
    word = lambda: "".join(r.choice(alphabet) for _ in range(r.randint(1, 6)))
    listed = [" ".join(word() for _ in range(r.randint(1, 4))) for _ in range(n_names)]

    def smudged(s):
        s = list(s)
        for _ in range(r.randint(0, 3)):
            s[r.randrange(len(s))] = r.choice([*alphabet, "", " "])
        return "".join(s)

    texts = ["  ".join(r.choice([word(), word(), smudged(r.choice(listed))]) for _ in range(r.randint(0, 40))) for _ in range(n_texts)]
    return list(enumerate(listed)), list(enumerate(texts))


@pytest.mark.parametrize(("seed", "threshold", "alphabet"), [(1, 0.9, "abcdeé"), (2, 0.9, "ab"), (3, 0.75, "abcdefgh"), (4, 0.6, "abc"), (5, 1.0, "abcđ")])
def test_similar(spark, seed, threshold, alphabet):
    listed, texts = random_case(random.Random(seed), alphabet, 40, 30)
    listed += [(100, None), (101, ""), (102, "A"), (103, "ab " * 40 + "c"), (None, "ab c")]
    texts += [(200, None), (201, ""), (202, "a"), (None, "x ab c"), (203, "z " * 50 + "ab " * 40 + "c"), (203, "ab d"), (204, "tab\tab\n c")]
    n = spark.createDataFrame(listed, "k long, name string")
    t = spark.createDataFrame(texts, "d long, s string").withColumn("name", F.lit("clash")).repartition(3)
    got = [tuple(x) for x in names.fuzzy(n, t, "k", "name", "d", "s", threshold).collect()]
    assert sorted(got, key=repr) == similar_by_all(listed, texts, threshold)


def test_long_texts_go_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(name_grams, "AT_ONCE", 16)
    listed, texts = random_case(random.Random(6), "abcde", 20, 8)
    t = spark.createDataFrame(texts, "d long, s string")
    listed_rows = name_grams._listed(spark.createDataFrame([(i, n) for i, n in listed], "name_id long, name string"), 0.9, np.zeros(1 << name_grams.COUNTER_BITS, dtype=np.int64))
    places = name_grams._places(t.select(F.col("d").alias("text_id"), "s"), listed_rows)
    wanted = {r["gram"] for r in listed_rows.collect()}
    expected = {(int(c), d, p) for d, s in texts for q in (1, 2, 3) for p, c in enumerate(name_grams.grams(name_grams.points(s), q).view(np.int64)) if int(c) in wanted}
    got = {tuple(x) for x in places.collect() if x["gram"] in wanted}
    sizes = {r["q"] for r in listed_rows.collect()}
    assert got == {e for e in expected if {1: 1, 2: 2, 3: 3}[1 + (e[0] >> 21 > 0) + (e[0] >> 42 > 0)] in sizes}


@pytest.mark.parametrize("fold", [True, False])
def test_containing(spark, fold):
    listed, texts = random_case(random.Random(7), "abAB ", 60, 30)
    listed += [(100, None), (101, ""), (102, "a"), (103, "ab")]
    texts += [(200, None), (201, "")]
    n, t = spark.createDataFrame(listed, "k long, name string"), spark.createDataFrame(texts, "d long, s string")
    low = (lambda x: x.lower()) if fold else (lambda x: x)
    expected = {(k, d) for k, a in listed if a for d, s in texts if s and low(a) in low(s)}
    for most in (1, 1000):
        got = [tuple(x) for x in names.exact(n, t, "k", "name", "d", "s", fold, most=most).collect()]
        assert len(got) == len(set(got)) and set(got) == expected


def test_work_follows_hits(spark):
    """Ten times as many names that the texts do not hold: no more places are compared."""
    r = random.Random(8)
    word = lambda letters: "".join(r.choice(letters) for _ in range(7))
    texts = spark.createDataFrame([(k, " ".join(word("abcdefghij") for _ in range(200))) for k in range(20)], "text_id long, s string")
    rarity = name_grams._rarity(texts)
    counts = []
    for n in (50, 500):
        own = spark.createDataFrame([(k, f"{word('klmnopqrst')} {word('klmnopqrst')}") for k in range(n)], "name_id long, name string")
        listed = name_grams._listed(own, 0.9, rarity)
        counts.append(name_grams._places(texts, listed).join(listed, "gram").count())
    assert counts == [0, 0]


@pytest.mark.parametrize(("seed", "threshold", "alphabet"), [(9, 0.9, "ab"), (10, 0.9, "abcdeé"), (11, 0.8, "abcdefgh"), (12, 0.9, [chr(0x4E00 + 7 * k) for k in range(400)])])
def test_pieces_in_parts_of_texts(spark, monkeypatch, seed, threshold, alphabet):
    """Names of common syllables in long texts, a few places at a time; no joins are needed for them."""
    monkeypatch.setattr(name_pieces, "AT_ONCE", 64)
    monkeypatch.setattr(name_pieces, "HITS_AT_ONCE", 8)
    monkeypatch.setattr(name_pieces, "KNOWN", 5)
    listed, texts = random_case(random.Random(seed), alphabet, 40, 12)
    listed = [(k, n) for k, n in listed if len(n.lower()) in name_pieces.lengths(threshold)] + [(100, "ab " * 30 + "cd ef")]
    texts = [(d, f"{t} {u}") for d, t in texts for _, u in texts[:3]] + [(200, "x " * 70 + "ab " * 29 + "bb cd ef"), (201, "a" * 300)]
    found: dict = {}
    sought = name_pieces.Sought([n.lower() for _, n in listed], threshold)
    whole = [" ".join(t.lower().split()) for _, t in texts]
    for i, s in enumerate(whole):
        for part in name_pieces.slices(i, s, sought.longest + 1):
            sought.best([part], found)
    every = [((i, k), names.most_similar(n.lower(), s.split(), threshold)) for i, s in enumerate(whole) for k, (_, n) in enumerate(listed)]
    assert {x: (r[0], r[4]) for x, r in found.items()} == {x: h[:2] for x, h in every if h}
    assert len(found) > 5


def test_short_lists_need_no_joins(spark, monkeypatch):
    """Common syllables: the joins would list each of their places, and the direct way none that is not similar."""
    monkeypatch.setattr(name_grams, "_places", None)
    r = random.Random(13)
    word = lambda: "".join(r.choice(["the", "in", "an", "er", "on", "re"]) for _ in range(r.randint(1, 3)))
    listed = [(k, " ".join(word() for _ in range(3))) for k in range(30)]
    texts = [(d, " ".join(word() for _ in range(800))) for d in range(12)]
    n, t = spark.createDataFrame(listed, "k long, name string"), spark.createDataFrame(texts, "d long, s string")
    got = [tuple(x) for x in names.fuzzy(n, t, "k", "name", "d", "s", 0.9).collect()]
    assert sorted(got, key=repr) == similar_by_all(listed, texts, 0.9) and got


def test_long_lists_go_by_joins(spark, monkeypatch):
    monkeypatch.setattr(name_pieces, "MOST", 3)
    listed, texts = random_case(random.Random(14), "abcd", 20, 10)
    n, t = spark.createDataFrame(listed, "k long, name string"), spark.createDataFrame(texts, "d long, s string")
    got = [tuple(x) for x in names.fuzzy(n, t, "k", "name", "d", "s", 0.9).collect()]
    assert sorted(got, key=repr) == similar_by_all(listed, texts, 0.9)
