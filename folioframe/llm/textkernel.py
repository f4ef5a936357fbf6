"""Vectorised scans of whole Arrow string columns: words, word hashes and shingle sets."""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_rng = np.random.Generator(np.random.PCG64(20240229))
BYTE_VALUES = _rng.integers(1, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1)
SHINGLE_FACTORS = _rng.integers(1, 2**63, 64, dtype=np.uint64) * U64(2) + U64(1)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_powers: dict[str, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> U64(33))
    h = h * U64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> U64(33))
    h = h * U64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U64(33))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse, modulo 2**64."""
    if len(_powers.get("up", ())) < n:
        size = max(n, 1 << 18)
        inverse = pow(_BASE, -1, 1 << 64)
        for name, b in (("up", _BASE), ("down", inverse)):
            a = np.full(size, b, dtype=np.uint64)
            a[0] = 1
            _powers[name] = np.multiply.accumulate(a)
    return _powers["up"], _powers["down"]


def chunks(column: pa.Array, limit: int = 1 << 19):
    """Yields (first row, bytes, offsets) of slices of about ``limit`` bytes; a null is an empty text.

    A single longer text is one slice, so that memory follows the longest text and never the batch.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    if not n:
        return
    wide = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], dtype=wide, count=column.offset + n + 1)[column.offset :].astype(np.int64)
    if column.null_count and np.diff(offsets)[column.is_null().to_numpy(zero_copy_only=False)].any():
        yield from chunks(column.fill_null(""), limit)
        return
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(n, max(last, first + 1))
        yield first, raw[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def words(raw: np.ndarray, offsets: np.ndarray, inside: np.ndarray = ~SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word (maximal run of bytes that are ``inside``, as a rule no white space) and the first word
    of each text."""
    solid = inside[raw]
    if not len(raw):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    before = np.empty(len(raw), dtype=bool)
    before[0] = False
    before[1:] = solid[:-1]
    edges = offsets[:-1][offsets[:-1] < len(raw)]
    before[edges] = False
    starts = np.flatnonzero(solid & ~before)
    after = np.empty(len(raw), dtype=bool)
    after[-1] = False
    after[:-1] = solid[1:]
    inner = offsets[1:-1]
    after[inner[inner > 0] - 1] = False
    ends = np.flatnonzero(solid & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = True) -> np.ndarray:
    """64-bit hash of each byte span; A-Z count as a-z if ``fold``."""
    up, down = powers(len(raw) + 1)
    table = BYTE_VALUES[LOWER] if fold else BYTE_VALUES
    total = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum(table[raw] * up[: len(raw)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, size: int = 5):
    """The sorted set of shingle hashes of each text: ``size`` words each, the whole text if it has fewer."""
    starts, ends, first = words(raw, offsets)
    h = span_hashes(raw, starts, ends)
    n = len(h)
    all_hashes = np.zeros(0, np.uint64)
    if n >= size:
        acc = np.zeros(n - size + 1, dtype=np.uint64)
        for j in range(size):
            acc += h[j : n - size + 1 + j] * SHINGLE_FACTORS[j]
        all_hashes = mix(acc)
    for k in range(len(offsets) - 1):
        a, b = first[k], first[k + 1]
        if b - a >= size:
            s = np.sort(all_hashes[a : b - size + 1])
            keep = np.empty(len(s), dtype=bool)
            keep[0] = True
            np.not_equal(s[1:], s[:-1], out=keep[1:])
            yield s[keep]
        elif b > a:
            acc = U64(0)
            with np.errstate(over="ignore"):
                for j in range(b - a):
                    acc = acc + h[a + j] * SHINGLE_FACTORS[j]
                yield mix(np.array([acc + U64(int(b - a) * 0x5851F42D4C957F2D & (2**64 - 1))], dtype=np.uint64))
        else:
            yield np.zeros(0, np.uint64)


def release_memory() -> None:
    """Gives back to the system what a finished task of this Python worker has freed; the worker lives on."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # other C libraries have no such call
        pass


class SpanHasher:
    """Hashes of many sets of spans of the same bytes, which are summed once."""

    def __init__(self, raw: np.ndarray, fold: bool = True):
        up, self.down = powers(len(raw) + 1)
        self.total = np.zeros(len(raw) + 1, dtype=np.uint64)
        np.cumsum((BYTE_VALUES[LOWER] if fold else BYTE_VALUES)[raw] * up[: len(raw)], out=self.total[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray, kind: int = 0) -> np.ndarray:
        lengths = (ends - starts).astype(np.uint64)
        return mix((self.total[ends] - self.total[starts]) * self.down[starts] + lengths + U64(kind * 0x9E3779B97F4A7C15 & (2**64 - 1)))
