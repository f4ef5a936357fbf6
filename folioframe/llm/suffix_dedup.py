"""Removal of passages that a document with a smaller id already holds, by a suffix index of the whole collection.

Every string of 50 bytes of every document counts. Each such window is anchored at the least of its 20-byte hashes,
so equal windows have equal anchors, and the windows of one anchor form one short string. A first pass over the
texts finds the anchors that more than one document holds; a second pass sends the strings of those anchors to the
bucket of the anchor, and each bucket builds its collection's Burrows-Wheeler transform and common prefixes column by
column (``collection_bwt``). Runs of common prefixes of at least 50 bytes are the equal windows; all but those of the
smallest document are removed. Where all documents hold one and the same string at an anchor, its 64-bit hash stands
for it, and strings without their like around the anchor need no comparison.

Copies do not gather in one task: within a task equal strings go on once, for the smallest document, and the other
documents' windows are known to be repeats at once. Anchors of very many documents are split by the 41 bytes that
ten neighbouring windows share. The set of repeated anchors is a bitmap that grows with the input up to a fixed size;
when it is full, more strings are sent, and the result is the same. What a task holds before it sends grows with the
number of buckets up to a fixed size, so that a bucket gets some kilobytes at a time; a task still sends a row to each.

Defined results: a null text is empty; a text below 50 bytes keeps all; rows of one id never remove one another's
bytes; a row without an id keeps all and removes nothing; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioframe.llm import collection_bwt
from folioframe.llm import textkernel as tk
from folioframe.scratch import Scratch, input_partitions

GRAM = 20
#: At least and at most; a bit more for each doubling of the input, so that the share of set bits stays.
BITMAP_BITS, MOST_BITS = 26, 29
#: A bucket holds the strings of so many documents at one anchor easily: about a megabyte.
HOT_DOCS = 16384
HOT_STEP = 10
SLICE = 1 << 24
_LENGTH = 0xD6E8FEB86659FD93


def anchors(raw: np.ndarray, offsets: np.ndarray, width: int):
    """(anchor hash, anchor position, first window, last window, text number, hash of its bytes) of each run of windows with one anchor."""
    n = len(raw)
    none = np.zeros(0, np.int64)
    if n < width:
        return none.astype(np.uint64), none, none, none, none, none.astype(np.uint64)
    up, down = tk.powers(n + 1)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(tk.BYTE_VALUES[raw] * up[:n], out=total[1:])
    grams = tk.mix((total[GRAM:] - total[:-GRAM]) * down[: n - GRAM + 1])
    low = tk.U64((1 << 25) - 1)
    key = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    span, have = width - GRAM + 1, 1
    while have * 2 <= span:
        key = np.minimum(key[: len(key) - have], key[have:])
        have *= 2
    if have < span:
        key = np.minimum(key[: len(key) - (span - have)], key[span - have :])
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    starts = np.flatnonzero(offsets[1:][text[: len(key)]] - np.arange(len(key)) >= width)
    if not len(starts):
        return none.astype(np.uint64), none, none, none, none, none.astype(np.uint64)
    at = (key[starts] & low).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (text[starts[1:]] != text[starts[:-1]]))))
    last = np.append(first[1:], len(starts)) - 1
    a, z = starts[first], starts[last] + width
    whole = tk.mix((total[z] - total[a]) * down[a] + (z - a).astype(np.uint64) * tk.U64(_LENGTH))
    # Least hashes are small numbers: mixed once more they spread over buckets and bitmap evenly.
    return tk.mix(grams[at[first]] ^ tk.U64(_LENGTH)), at[first], a, starts[last], text[a], whole


def _slices(raw: np.ndarray, offsets: np.ndarray, width: int):
    """Very long texts in overlapping slices, since windows stand for themselves: (shift, bytes, offsets)."""
    if len(raw) <= SLICE or len(offsets) > 2:
        yield 0, raw, offsets
        return
    for a in range(0, len(raw) - width + 1, SLICE):
        part = raw[a : a + SLICE + width - 1]
        yield a, part, np.array([0, len(part)])


def _merge(h: np.ndarray, whole: np.ndarray, docs: np.ndarray):
    """One entry per anchor: documents, and the hash of its string, 0 if its strings differ."""
    order = np.argsort(h, kind="stable")
    h, whole, docs = h[order], whole[order], docs[order]
    first = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
    same = np.minimum.reduceat(whole, first) == np.maximum.reduceat(whole, first)
    return h[first], np.where(same, whole[first], tk.U64(0)), np.minimum(np.add.reduceat(docs, first), 65535)


def _count(width: int, buckets: int, flush: int | None = None):
    shift = tk.U64(64 - buckets.bit_length() + 1)
    flush = flush or min(1 << 20, max(1 << 19, buckets << 7))

    def give(held: list[tuple[np.ndarray, ...]]):
        h, whole, docs = _merge(*(np.concatenate(x) for x in zip(*held, strict=True)))
        bucket = (h >> shift).astype(np.int32)
        cut = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
        bounds = list(zip(cut.tolist(), np.append(cut[1:], len(h)).tolist(), strict=True))
        packed = lambda a: pa.array([a[x:y].tobytes() for x, y in bounds], pa.binary())
        # The bitmap needs no more than 48 bits below the bucket's own.
        short = (h << tk.U64(buckets.bit_length() - 1)) >> tk.U64(16)
        six = np.ascontiguousarray(short).view(np.uint8).reshape(-1, 8)[:, :6]
        return pa.RecordBatch.from_arrays([pa.array(bucket[cut]), packed(six), packed(whole), packed(docs.astype(np.uint16))], names=["bucket", "anchors", "strings", "docs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for _, raw, offsets in tk.chunks(batch.column(0)):
                for _, part, cuts in _slices(raw, offsets, width):
                    h, _, _, _, text, whole = anchors(part, cuts, width)
                    if not len(h):
                        continue
                    order = np.lexsort((text, h))
                    h, text, whole = h[order], text[order], whole[order]
                    new = np.concatenate(([True], (h[1:] != h[:-1]) | (text[1:] != text[:-1])))
                    held.append((h, whole, new.astype(np.int64)))
                    size += len(h)
                    if size > flush:
                        yield give(held)
                        held, size = [], 0
        if held:
            yield give(held)
        del held
        tk.release_memory()

    return run


#: Each bitmap, and how many bits fewer than the first index it: rarer anchors need less.
MARKS = {"repeated": 0, "mixed": 1, "hot": 4}


def _bitmap_bits(partitions: int) -> int:
    return min(MOST_BITS, max(BITMAP_BITS, (partitions - 1).bit_length() + 19))


def _repeated(buckets: int, hot_docs: int, bitmap_bits: int):
    regions = {name: (1 << bitmap_bits - fewer) // buckets for name, fewer in MARKS.items()}

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        six = np.concatenate([np.frombuffer(x, np.uint8) for x in rows["anchors"]]).reshape(-1, 6)
        h = np.zeros((len(six), 8), np.uint8)
        h[:, :6] = six
        h = h.view(np.uint64)[:, 0]
        whole = np.concatenate([np.frombuffer(x, np.uint64) for x in rows["strings"]])
        docs = np.concatenate([np.frombuffer(x, np.uint16) for x in rows["docs"]]).astype(np.int64)
        h, whole, docs = _merge(h, whole, docs)
        out = {"bucket": [int(rows["bucket"].iloc[0])]}
        for name, which in zip(MARKS, (docs >= 2, (docs >= 2) & (whole == 0), (docs >= hot_docs) & (whole == 0)), strict=True):
            bits = np.zeros(regions[name], bool)
            bits[(h[which] >> tk.U64(48 - regions[name].bit_length() + 1)).astype(np.int64)] = True
            out[name] = [np.packbits(bits).tobytes() if which.any() else None]
        return pd.DataFrame(out)

    return run


def _bit(bitmap: np.ndarray, h: np.ndarray) -> np.ndarray:
    slot = (h >> tk.U64(64 - (8 * len(bitmap)).bit_length() + 1)).astype(np.int64)
    return (bitmap[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8)) & 1 == 1


SPANS = "doc_id long, row_key long, starts binary, ends binary"
SENT = "bucket int, lengths binary, spans binary, anchor binary, bytes binary, s_doc binary, s_row binary, s_start binary, doc_id long, row_key long, starts binary, ends binary"
NO_ANCHOR, ALONE = 255, 254


def _grouped(doc: np.ndarray, key: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[list, list, list, list]:
    """Spans by (document, row): ids, keys and the packed bounds of each, neighbours joined."""
    if not len(doc):
        return [], [], [], []
    order = np.lexsort((starts, key, doc))
    doc, key, starts, ends = doc[order], key[order], starts[order], ends[order]
    new = np.concatenate(([True], (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])))
    apart = new.copy()
    apart[1:] |= starts[1:] > ends[:-1]
    run = np.flatnonzero(apart)
    ends = np.maximum.reduceat(ends, run)
    doc, key, starts, new = doc[run], key[run], starts[run], new[run]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(doc))
    return doc[first].tolist(), key[first].tolist(), [starts[x:y].tobytes() for x, y in zip(first, last)], [ends[x:y].tobytes() for x, y in zip(first, last)]


class _Held:
    """Strings of a task not sent yet, each different one once, and where they stand. Anchors with one string alone
    send its hash for it, marked by a byte that UTF-8 never has."""

    def __init__(self):
        self.ids: dict[bytes, int] = {}
        self.bucket: list[int] = []
        self.anchor: list[int] = []
        self.owners: list[tuple[np.ndarray, ...]] = []
        self.alone: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def add(self, strings: list[bytes], buckets: list[int], anchor: list[int], doc: np.ndarray, key: np.ndarray, start: np.ndarray) -> None:
        ids, n = self.ids, len(self.ids)
        sid = [ids.setdefault(s, len(ids)) for s in strings]
        for k, b, p in zip(sid, buckets, anchor, strict=True):
            if k == n:
                self.bucket.append(b)
                self.anchor.append(p)
                self.size += 200
                n += 1
        self.owners.append((np.array(sid, np.int64), doc, key, start, np.array([len(s) for s in strings], np.int64)))
        self.size += 40 * len(sid)

    def add_alone(self, *columns: np.ndarray) -> None:
        """whole, bucket, doc, key, start, span"""
        self.alone.append(columns)
        self.size += 48 * len(columns[0])

    def give(self, buckets: int) -> pa.RecordBatch:
        strings, bucket, anchor, owners = list(self.ids), np.array(self.bucket, np.int64), np.array(self.anchor, np.uint8), self.owners
        if self.alone:
            whole, where, *rest = (np.concatenate(x) for x in zip(*self.alone, strict=True))
            different, at, number = np.unique(whole, return_index=True, return_inverse=True)
            owners = [*owners, (number + len(strings), *rest)]
            strings += [b"\xff" + x for x in np.ascontiguousarray(different).view("V8").tolist()]
            bucket = np.concatenate((bucket, where[at]))
            anchor = np.concatenate((anchor, np.full(len(different), ALONE, np.uint8)))
        lengths = np.array([len(s) for s in strings], np.int64)
        sid, doc, key, start, span = (np.concatenate(x) for x in zip(*owners, strict=True))
        least = np.full(len(strings), np.iinfo(np.int64).max)
        np.minimum.at(least, sid, doc)
        known = doc > least[sid]
        ids, keys, starts, ends = _grouped(doc[known], key[known], start[known], (start + span)[known])
        sid, doc, key, start, span = (x[~known] for x in (sid, doc, key, start, span))
        order = np.argsort(bucket[sid], kind="stable")
        sid, doc, key, start, span = (x[order] for x in (sid, doc, key, start, span))
        b = bucket[sid]
        first = np.flatnonzero(np.concatenate(([True], b[1:] != b[:-1])))
        cuts = list(zip(first.tolist(), np.append(first[1:], len(b)).tolist(), strict=True))
        n, k = len(cuts), len(ids)
        packed = lambda a: pa.array([a[x:y].tobytes() for x, y in cuts] + [None] * k, pa.binary())
        listed = sid.tolist()
        return pa.RecordBatch.from_arrays(
            [
                # What is known already passes through the buckets, spread by document.
                pa.array(b[first].tolist() + [int(x) % buckets for x in ids], pa.int32()),
                packed(lengths[sid].astype(np.uint8)), packed(span.astype(np.uint8)), packed(anchor[sid]),
                pa.array([b"".join([strings[z] for z in listed[x:y]]) for x, y in cuts] + [None] * k, pa.binary()),
                packed(doc), packed(key.astype(np.uint32)), packed(start.astype(np.uint32)),
                pa.array([0] * n + ids, pa.int64()), pa.array([0] * n + keys, pa.int64()), pa.array([None] * n + starts, pa.binary()), pa.array([None] * n + ends, pa.binary()),
            ],
            names=["bucket", "lengths", "spans", "anchor", "bytes", "s_doc", "s_row", "s_start", "doc_id", "row_key", "starts", "ends"],
        )


def _hot_parts(part: np.ndarray, at: np.ndarray, first: np.ndarray, last: np.ndarray, width: int):
    """Windows by distance from the anchor, some at a time, under the bytes that these share: (number of the run of
    windows, first window, last window, hash of the shared bytes)."""
    low = (first - at) // HOT_STEP
    number = (last - at) // HOT_STEP - low + 1
    run = np.repeat(np.arange(len(at)), number)
    begin = at[run] + HOT_STEP * (np.arange(len(run)) + np.repeat(low - (np.cumsum(number) - number), number))
    shared = tk.span_hashes(part, begin + HOT_STEP - 1, begin + width, fold=False)
    return run, np.maximum(first[run], begin), np.minimum(last[run], begin + HOT_STEP - 1), shared


def _send(width: int, buckets: int, bitmaps, flush: int | None = None):
    flush = flush or min(48 << 20, max(12 << 20, buckets << 12))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repeated, mixed, hot = (np.frombuffer(x, np.uint8) for x in bitmaps.value)
        held = _Held()
        wide = 64 - buckets.bit_length() + 1
        for batch in batches:
            present = batch.column(0).is_valid().to_numpy(zero_copy_only=False)
            ids = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False)
            keys = batch.column(1).to_numpy(zero_copy_only=False)
            for row, raw, offsets in tk.chunks(batch.column(2)):
                for moved, part, cuts in _slices(raw, offsets, width):
                    h, at, first, last, text, whole = anchors(part, cuts, width)
                    keep = np.flatnonzero(_bit(repeated, h) & present[row + text])
                    many = _bit(mixed, h[keep])
                    much = many & _bit(hot, h[keep])
                    k = keep[~many]
                    if len(k):
                        a, t = first[k], text[k]
                        held.add_alone(whole[k], (h[k] >> tk.U64(wide)).astype(np.int64), ids[row + t], keys[row + t], a - cuts[t] + moved, last[k] + width - a)
                    k = keep[many & ~much]
                    body = part.tobytes()
                    if len(k):
                        a, z, p, t = first[k], last[k] + width, at[k], text[k]
                        strings = [body[x:y] for x, y in zip(a.tolist(), z.tolist(), strict=True)]
                        held.add(strings, (h[k] >> tk.U64(wide)).tolist(), (p - a).tolist(), ids[row + t], keys[row + t], a - cuts[t] + moved)
                    k = keep[much]
                    if len(k):
                        which, a, z, shared = _hot_parts(part, at[k], first[k], last[k], width)
                        t = text[k][which]
                        strings = [body[x:y] for x, y in zip(a.tolist(), (z + width).tolist(), strict=True)]
                        held.add(strings, (shared >> tk.U64(wide)).astype(np.int64).tolist(), [NO_ANCHOR] * len(strings), ids[row + t], keys[row + t], a - cuts[t] + moved)
                    if held.size > flush:
                        yield held.give(buckets)
                        held = _Held()
        if held.owners or held.alone:
            yield held.give(buckets)
        del held, repeated, mixed, hot
        tk.release_memory()

    return run


def repeats(strings: list[bytes], docs: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(string, window) of the windows of different strings that also start in a string of a smaller document."""
    columns = collection_bwt.build(strings)
    lengths = np.array([len(s) for s in strings], np.int64)
    group = np.cumsum(columns["lcp"] < width)
    rows = np.flatnonzero(columns["length"] >= width)
    if not len(rows):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    group, who, length = group[rows], columns["who"][rows].astype(np.int64), columns["length"][rows].astype(np.int64)
    doc = docs[who]
    first = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    least = np.repeat(np.minimum.reduceat(doc, first), np.diff(np.append(first, len(rows))))
    again = doc > least
    return who[again], lengths[who[again]] - length[again]


def comparable(strings: list[bytes], anchor: np.ndarray) -> np.ndarray:
    """Which strings can share a window with another: each window holds the anchor's bytes and either the 15 before
    or the 16 after, so another string must hold the same of these."""
    lengths = np.array([len(s) for s in strings], np.int64)
    ends = np.cumsum(lengths)
    raw = np.frombuffer(b"".join(strings), np.uint8)
    start, at = ends - lengths, ends - lengths + anchor
    out = anchor == NO_ANCHOR
    anchored = anchor < ALONE
    for a, b in ((at - 15, at + GRAM), (at, at + GRAM + 16)):
        ok = np.flatnonzero(anchored & (a >= start) & (b <= ends))
        if len(ok):
            _, which, count = np.unique(tk.span_hashes(raw, a[ok], b[ok], fold=False), return_inverse=True, return_counts=True)
            out[ok] |= count[which] > 1
    return out


def _match(width: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        passing = rows[rows["lengths"].isna()]
        rows = rows[rows["lengths"].notna()]
        ids: dict[bytes, int] = {}
        sid, anchor = [], []
        for lengths, at, body in zip(rows["lengths"], rows["anchor"], rows["bytes"], strict=True):
            end = np.cumsum(np.frombuffer(lengths, np.uint8).astype(np.int64)).tolist()
            begin = [0, *end[:-1]]
            for x, y, p in zip(begin, end, at, strict=True):
                s = body[x:y]
                k = ids.setdefault(s, len(ids))
                if k == len(anchor):
                    anchor.append(p)
                sid.append(k)
        out = [passing[["doc_id", "row_key", "starts", "ends"]]]
        if ids:
            sid = np.array(sid, np.int64)
            doc, key, start, span = (
                np.concatenate([np.frombuffer(x, kind) for x in rows[c]]).astype(np.int64) for c, kind in (("s_doc", np.int64), ("s_row", np.uint32), ("s_start", np.uint32), ("spans", np.uint8))
            )
            strings = list(ids)
            least = np.full(len(strings), np.iinfo(np.int64).max)
            np.minimum.at(least, sid, doc)
            known = doc > least[sid]
            found = [(doc[known], key[known], start[known], (start + span)[known])]
            chosen = np.flatnonzero(comparable(strings, np.array(anchor, np.int64)))
            if len(chosen) > 1:
                who, window = repeats([strings[k] for k in chosen.tolist()], least[chosen], width)
                # The places of each string's smallest document, joined with the string's repeated windows.
                own = np.flatnonzero(~known)
                own = own[np.argsort(sid[own], kind="stable")]
                a, b = np.searchsorted(sid[own], chosen[who]), np.searchsorted(sid[own], chosen[who], side="right")
                place = own[np.repeat(a, b - a) + (np.arange((b - a).sum()) - np.repeat(np.cumsum(b - a) - (b - a), b - a))]
                begin = start[place] + np.repeat(window, b - a)
                found.append((doc[place], key[place], begin, begin + width))
            grouped = _grouped(*(np.concatenate(x) for x in zip(*found, strict=True)))
            out.append(pd.DataFrame(dict(zip(["doc_id", "row_key", "starts", "ends"], grouped, strict=True))))
        # Empty frames would turn the ids of the others into floating-point numbers.
        return pd.concat([x for x in out if len(x)] or out[:1], ignore_index=True)

    return run


def _cut(with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
        for batch in batches:
            out: dict[str, list] = {k: [] for k in names}
            for k in range(batch.num_rows):
                body = batch.column(1)[k].as_buffer() if batch.column(1)[k].is_valid else b""
                body = memoryview(body)
                starts = batch.column(2)[k].as_py() or []
                ends = batch.column(3)[k].as_py() or []
                kept, at, spans, removed = [], 0, 0, 0
                if starts:
                    a, b = (np.frombuffer(b"".join(x), np.int64) for x in (starts, ends))
                    order = np.argsort(a, kind="stable")
                    a, b = a[order], np.maximum.accumulate(b[order])
                    first = np.flatnonzero(np.concatenate(([True], a[1:] > b[:-1])))
                    for x, y in zip(a[first].tolist(), b[np.append(first[1:], len(a)) - 1].tolist(), strict=True):
                        kept.append(body[at:x])
                        at, spans, removed = y, spans + 1, removed + y - x
                kept.append(body[at:])
                whole = b"".join(kept)
                for name, v in zip(names, (batch.column(0)[k].as_py(), len(body), removed, spans, hashlib.sha256(whole).hexdigest(), whole if with_text else None), strict=True):
                    out[name].append(v)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(out[n], t) for n, t in zip(names, kinds, strict=True)], names=names)

    return run


def remove_repeats(
    spark: SparkSession, documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 50, with_text: bool = False, hot_docs: int = HOT_DOCS
) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, the kept bytes."""
    scratch = Scratch(spark, "suffix-dedup")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.crc32(text.cast("binary")).alias("row_key"), text.alias("text"))
    partitions = input_partitions(documents)
    buckets, bitmap_bits = 1 << min(BITMAP_BITS - 6, max(6, (16 * partitions - 1).bit_length())), _bitmap_bits(partitions)
    counted = rows.select("text").mapInArrow(_count(width, buckets), "bucket int, anchors binary, strings binary, docs binary")
    regions = counted.groupBy("bucket").applyInPandas(_repeated(buckets, hot_docs, bitmap_bits), "bucket int, repeated binary, mixed binary, hot binary").collect()
    bits = {name: bytearray((1 << bitmap_bits - fewer) // 8) for name, fewer in MARKS.items()}
    for r in regions:
        for name, whole in bits.items():
            if r[name]:
                whole[r["bucket"] * len(r[name]) : (r["bucket"] + 1) * len(r[name])] = r[name]
    del regions
    bitmaps = spark.sparkContext.broadcast(tuple(bits.values()))
    del bits
    scratch.release()
    sent = rows.mapInArrow(_send(width, buckets, bitmaps), SENT)
    spans = scratch.save(sent.groupBy("bucket").applyInPandas(_match(width), SPANS))
    bitmaps.unpersist()
    scratch.release()
    found = spans.groupBy("doc_id", "row_key").agg(F.collect_list("starts").alias("starts"), F.collect_list("ends").alias("ends"))
    joined = rows.join(found, ["doc_id", "row_key"], "left").select("doc_id", F.col("text").cast("binary").alias("body"), "starts", "ends")
    return joined.mapInArrow(_cut(with_text), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(spark, spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("kept")
