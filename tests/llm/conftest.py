import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, hash int, node long, id int"


def make_docs():
    """Copies, near copies, shared passages, ties, nulls, empty and long texts; extra columns with clashing names."""
    r = random.Random(5)
    word = lambda: "".join(r.choice(["an", "the", "or", "in", "é", "ß", "qu"]) for _ in range(r.randint(1, 4)))
    text = lambda n: " ".join(word() for _ in range(n))
    passage = text(40)
    base = text(150)
    texts = [None, "", "  \n\t", "one", "One two", "one TWO", "a b c d e", "A b c d E", base, base, base + " tail", "x " + base, base.replace(" the", " THE")]
    for _ in range(12):
        w = base.split()
        for _ in range(r.randint(1, 6)):
            w[r.randrange(len(w))] = word()
        texts.append(" ".join(w))
    texts += [text(30) + " " + passage + " " + text(r.randint(0, 30)) for _ in range(8)]
    texts += [text(3000), "é" * 500, "a" * 4000, "ab" * 100 + " " + "ab" * 100, "😀 " * 60, passage, passage[:49], passage[:50]]
    texts += ["mail a.b@c.org_x@d.fr +1 (743) 555-3824, 4111 1111 1111 1111 at 10.0.0.255 or 256.1.1.1", "Dr. John Smith, tel (555) 123-4567", "1" * 3000 + " +" * 50]
    rows = [(k, t, None if k % 7 == 0 else ("en", "fr")[k % 2], None if k % 5 == 0 else f"s{k % 3}", None, "x", k, -k, 0) for k, t in enumerate(texts)]
    rows += [rows[8], rows[30], (None, base, None, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None)]
    return rows


@pytest.fixture(scope="session")
def doc_rows():
    return make_docs()


@pytest.fixture(scope="session")
def docs(spark, doc_rows):
    return spark.createDataFrame(doc_rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
