"""Cost-balanced packing of tokenised documents into sequences of a fixed length.

A document costs ``linear * n + quadratic * n * n`` for n tokens (the attention of one document). Documents are
tokenised where they lie. A document longer than a sequence fills whole sequences; its remainder goes, longest first,
to the sequence of lowest cost that still has room, and is cut only where no sequence has room for it. Work is split
into shards of some thousand documents by a hash of id and content, repeats of a row in a task by their number too, and a shard opens just as many sequences as its
tokens need, so that a shard wastes less than one sequence.

Defined results: a null text is an empty document and has the end token only; rows of one id are documents of their
own; ties in length go by id, start and content, ties in cost to the earlier sequence; an empty table gives no rows.
Other columns are ignored.
"""

from __future__ import annotations

import base64
import heapq
import json
import math
import os
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"
DOCS_PER_SHARD = 2048


def default_ranks() -> str:
    """The rank file of the byte-level vocabulary; it gives the ids of the file byte_bpe_50k.json, several times faster.
    Added tokens, which only the JSON file lists, are read from there."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def added_tokens(ranks_path: str) -> dict[str, int]:
    """The added tokens of the tokenizer file beside the rank file, if there is one: text is split at them."""
    path = f"{os.path.splitext(ranks_path)[0]}.json"
    if not os.path.exists(path):
        return {}
    with open(path, encoding="utf-8") as f:
        added = json.load(f).get("added_tokens") or []
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
        raise ValueError(f"{path}: added tokens that take in or depend on the text around them are not supported")
    return {t["content"]: t["id"] for t in added}


def load_encoder(ranks_path: str):
    import public_tokenizers
    import tiktoken

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added_tokens(ranks_path))


def crc_of(ids: np.ndarray) -> int:
    return zlib.crc32(np.ascontiguousarray(ids, dtype="<u4").tobytes())


def _tokenise(ranks_path: str, length: int, end_id: int, shards: int, keep_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = load_encoder(ranks_path)
        context = TaskContext.get()
        task, met = context.partitionId() if context else 0, Counter()
        for batch in batches:
            for first in range(0, batch.num_rows, 512):
                part = batch.slice(first, 512)
                out: dict[str, list] = {k: [] for k in ("shard", "doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids")}
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    ids = np.append(np.asarray(encoder.encode(text or "", allowed_special="all"), dtype=np.uint32), np.uint32(end_id)).astype("<u4")
                    name = f"{doc_id}:{crc_of(ids)}"
                    mark = zlib.crc32(name.encode())
                    if met[mark]:  # a repeat of a row, or as good as one: the repeats are spread evenly
                        mark = zlib.crc32(f"{name}:{task}:{met[mark]}".encode())
                    met[zlib.crc32(name.encode())] += 1
                    shard = mark % shards
                    for start in range(0, len(ids), length):
                        piece = ids[start : start + length]
                        out["shard"].append(shard)
                        out["doc_id"].append(doc_id)
                        out["start"].append(start)
                        out["length"].append(len(piece))
                        out["ids_crc32"].append(crc_of(piece))
                        out["doc_tokens"].append(len(ids))
                        small = piece.max() < 65536
                        kept = keep_ids or len(piece) < length
                        out["ids"].append((b"2" + piece.astype("<u2").tobytes() if small else b"4" + piece.tobytes()) if kept else None)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out["shard"], pa.int32()), *[pa.array(out[k], pa.int64()) for k in list(out)[1:6]], pa.array(out["ids"], pa.binary())], names=list(out)
                )

    return run


def unpack_ids(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, dtype=f"<u{chr(blob[0])}", offset=1)


def pack_shard(lengths: list[int], length: int, linear: float, quadratic: float) -> list[tuple[int, int, int, int]]:
    """(item, first token, tokens, sequence) for items in descending order of tokens; every item is shorter than ``length``."""
    total = sum(lengths)
    bins = math.ceil(total / length)
    room = np.full(bins, length, dtype=np.int64)
    cost = np.zeros(bins)
    queue = [(-n, k, 0) for k, n in enumerate(lengths)]
    heapq.heapify(queue)
    placed = []
    while queue:
        n, k, first = heapq.heappop(queue)
        n = -n
        fits = room >= n
        if fits.any():
            at = int(np.argmin(np.where(fits, cost, np.inf)))
            take = n
        else:  # cut where most of it fits; the rest stays in line
            at = int(np.argmax(room))
            take = int(room[at])
            heapq.heappush(queue, (take - n, k, first + take))
        placed.append((k, first, take, at))
        room[at] -= take
        cost[at] += linear * take + quadratic * take * take
    return placed


def _pack(length: int, linear: float, quadratic: float, keep_ids: bool):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "start", "ids_crc32"], ascending=[False, True, True, True], kind="stable", na_position="last").reset_index(drop=True)
        base = int(key[0]) << 32
        full = rows["length"] == length
        whole = rows[full].copy()
        whole["sequence_id"] = base + np.arange(len(whole))
        whole["offset"] = 0
        rest = rows[~full].reset_index(drop=True)
        base += len(whole)
        used: dict[int, int] = {}
        out = []
        ids_of = [unpack_ids(x) for x in rest["ids"]]
        doc, start, n_doc = rest["doc_id"].tolist(), rest["start"].tolist(), rest["doc_tokens"].tolist()
        for k, first, n, at in pack_shard([len(x) for x in ids_of], length, linear, quadratic):
            ids = ids_of[k][first : first + n].astype("<u4")
            out.append((doc[k], start[k] + first, n, crc_of(ids), n_doc[k], base + at, used.get(at, 0), ids.tobytes() if keep_ids else None))
            used[at] = used.get(at, 0) + n
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
        whole["ids"] = [unpack_ids(x).astype("<u4").tobytes() if keep_ids else None for x in whole["ids"]]
        both = pd.concat([whole[names].astype(object), pd.DataFrame(out, columns=names).astype(object)], ignore_index=True)
        return both

    return run


def pack_documents(
    spark: SparkSession,
    documents: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = 2048,
    end_id: int = 1,
    linear: float = 1.0,
    quadratic: float = 1.0 / 2048,
    ranks_path: str | None = None,
    keep_ids: bool = False,
) -> DataFrame:
    """One row per piece: which ids of which document lie where in which sequence; ``ids`` (uint32) if ``keep_ids``."""
    texts = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    shards = max(1, math.ceil(texts.count() / DOCS_PER_SHARD))
    pieces = texts.mapInArrow(
        _tokenise(ranks_path or default_ranks(), length, end_id, shards, keep_ids),
        "shard int, doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary",
    )
    return pieces.groupBy("shard").applyInPandas(_pack(length, linear, quadratic, keep_ids), PIECES)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(spark, spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("ids")
