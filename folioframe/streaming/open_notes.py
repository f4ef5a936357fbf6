"""Notes that run on over page borders, in a stream of pages.

Pages of a document come in order, in whatever batches. The only state of a document is its last page with notes and the
number open at the foot of it; it is forgotten after a time without new pages. The result is, page by page, what
``numbered`` gives for all pages at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from folioframe.operators import sequence as seq

NOTES = "doc_id long, page int, pos int, num int, text string, runs_on boolean"
STATE = "page int, num int"
DEFAULT_TTL_MS = 3_600_000


def numbered(notes: DataFrame) -> DataFrame:
    """(doc_id, page, pos, num, text, runs_on) of page notes (doc_id, page, pos, num, text, continued): the number of the
    note each belongs to, and whether it goes on with one from the page before. Nothing is open after a page without
    notes, nor before the first page."""
    order = ["page", "pos"]
    n = notes.withColumn("__before", F.lag("page").over(seq.ordered(["doc_id"], order)))
    n = n.withColumn("__broken", F.coalesce(F.col("page") - F.col("__before") > 1, F.lit(True)))
    n = seq.islands(n, ["doc_id"], order, F.col("__broken"), "__part")
    n = seq.forward_fill(n, ["doc_id", "__part"], order, F.when(~F.col("continued") | F.col("__broken"), F.col("num")), "__num")
    return n.select("doc_id", "page", "pos", F.col("__num").alias("num"), "text", (F.col("continued") & ~F.col("__broken")).alias("runs_on"))


class OpenNotes(StatefulProcessor):
    """Carries the open note of a document from page to page."""

    def __init__(self, ttl_ms: int = DEFAULT_TTL_MS):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.open = handle.getValueState("open", STATE, self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        found = pd.concat(list(rows)).sort_values(["page", "pos"], kind="stable")
        page, num = self.open.get() if self.open.exists() else (None, None)
        out = []
        for r in found.itertuples():
            near = page is not None and r.page - page <= 1
            runs_on = bool(r.continued) and near
            num = num if runs_on else int(r.num)
            page = int(r.page)
            out.append((key[0], page, int(r.pos), int(num), r.text, runs_on))
        self.open.update((page, int(num)))
        yield pd.DataFrame(out, columns=["doc_id", "page", "pos", "num", "text", "runs_on"])

    def close(self) -> None:
        pass


def numbered_stream(notes: DataFrame, ttl_ms: int = DEFAULT_TTL_MS) -> DataFrame:
    """``numbered`` for a stream of page notes; needs the RocksDB state store."""
    return notes.groupBy("doc_id").transformWithStateInPandas(statefulProcessor=OpenNotes(ttl_ms), outputStructType=NOTES, outputMode="Append", timeMode="ProcessingTime")
