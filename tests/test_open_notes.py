"""Open notes in a stream against the same pages at once."""

import random
import time

import pytest

from folioframe.session import ship
from folioframe.streaming import open_notes

SCHEMA = "doc_id long, page int, pos int, num int, text string, continued boolean"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


@pytest.fixture
def rocks(spark):
    old = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    yield ship(spark)
    spark.conf.set(PROVIDER, old)


def notes(r):
    rows = []
    for doc in range(6):
        for page in range(1, 25):
            if r.random() < 0.25:
                continue  # a page without notes
            pos = 0
            if r.random() < 0.6:
                rows.append((doc, page, pos, 1, f"rest {page}", True))
                pos = 1
            for k in range(r.randrange(0 if pos else 1, 3)):
                rows.append((doc, page, pos + k, r.randrange(1, 9), f"note {page}.{k}", False))
    return rows


def run(spark, folder, batches, ttl=open_notes.DEFAULT_TTL_MS, pause=0):
    (folder / "in").mkdir()
    stream = spark.readStream.schema(SCHEMA).parquet(str(folder / "in"))
    out = open_notes.numbered_stream(stream, ttl).writeStream.format("parquet").outputMode("append").option("path", str(folder / "out")).option("checkpointLocation", str(folder / "state"))
    for rows in batches:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(folder / "in"))
        # A new run each time: the state comes from the checkpoint. (With time-outs a stream of "all that is available"
        # goes on with batches without data.)
        q = out.trigger(once=True).start()
        assert q.awaitTermination(120) and q.exception() is None
        time.sleep(pause)
    return sorted(map(tuple, spark.read.parquet(str(folder / "out")).select("doc_id", "page", "pos", "num", "text", "runs_on").collect()))


def test_page_by_page(rocks, tmp_path):
    rows = notes(random.Random(2))
    expected = sorted(map(tuple, open_notes.numbered(rocks.createDataFrame(rows, SCHEMA).repartition(3)).collect()))
    cuts = [(1, 4), (5, 5), (6, 15), (16, 24)]
    got = run(rocks, tmp_path, [[x for x in rows if a <= x[1] <= b] for a, b in cuts])
    assert got == expected
    assert any(x[5] and x[1] in (5, 6, 16) for x in got)  # some note runs on over a border between batches


def test_forgotten_after_a_while(rocks, tmp_path):
    first, second = [(1, 1, 0, 4, "four", False)], [(1, 2, 0, 1, "rest", True)]
    got = run(rocks, tmp_path, [first, second], ttl=1, pause=1)
    assert got == [(1, 1, 0, 4, "four", False), (1, 2, 0, 1, "rest", False)]
