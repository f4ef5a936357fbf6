"""Burrows-Wheeler transform and common prefixes of a collection of strings, built column by column.

Round j adds to the sorted list of suffixes the suffix of length j of every string that is long enough. Its place
follows from the transform alone: suffix c + X stands, after all suffixes with smaller first symbols, in the order in
which the suffixes X with symbol c before them stand. The common prefix with a neighbour is one more than the least
value between the two suffixes X. Each round reads the columns once from front to back and writes them once; a
collection above ``memory_limit`` bytes keeps them in external files.
"""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

import numpy as np


class _Columns:
    """The transform, common prefixes, string numbers and suffix lengths; in memory or in two sets of files."""

    kinds = {"bwt": np.uint8, "lcp": np.uint8, "who": np.int32, "length": np.uint8}

    def __init__(self, external: bool):
        self.folder = Path(tempfile.mkdtemp(prefix="bwt-")) if external else None
        self.turn, self.held = 0, {}

    def put(self, new: dict[str, np.ndarray]) -> None:
        self.turn += 1
        for name, a in new.items():
            if self.folder:
                a.tofile(self.folder / f"{name}{self.turn % 2}")
            else:
                self.held[name] = a

    def get(self, name: str) -> np.ndarray:
        return np.memmap(self.folder / f"{name}{self.turn % 2}", self.kinds[name], "r") if self.folder else self.held[name]

    def close(self) -> None:
        if self.folder:
            shutil.rmtree(self.folder, ignore_errors=True)


def build(strings: list[bytes], memory_limit: int = 256 << 20) -> dict[str, np.ndarray]:
    """Columns over all suffixes in order: ``bwt`` (0: none before, else byte + 1), ``lcp`` with the suffix before (at
    most 255), ``who`` (string) and ``length``. Strings are UTF-8 parts of at most 254 bytes."""
    m = len(strings)
    lengths = np.array([len(s) for s in strings], dtype=np.int64)
    order = np.argsort(-lengths, kind="stable")  # strings still growing are a prefix
    lengths = lengths[order]
    longest = int(lengths[0]) if m else 0
    matrix = np.zeros((longest + 1, m), dtype=np.uint8)  # row j: the symbol before the suffix of length j
    for column, k in enumerate(order):
        s = np.frombuffer(strings[k], dtype=np.uint8)[::-1]
        matrix[: len(s), column] = s + 1
    who = order.astype(np.int32)
    columns = _Columns(int(lengths.sum()) * 16 > memory_limit)
    try:
        columns.put({"bwt": matrix[0].copy(), "lcp": np.zeros(m, np.uint8), "who": who, "length": np.zeros(m, np.uint8)})
        place = np.arange(m)  # of each growing string's latest suffix
        for j in range(1, longest + 1):
            active = int(np.searchsorted(-lengths, -j, side="right"))
            place = place[:active]
            bwt, lcp = columns.get("bwt"), columns.get("lcp")
            n = len(bwt)
            by_symbol = np.argsort(bwt, kind="stable")
            rank = np.empty(n, np.int64)
            rank[by_symbol] = np.arange(n)
            ends = int(np.count_nonzero(bwt == 0))
            at = rank[place]
            new = at - ends + m
            low = np.append(np.asarray(lcp), np.uint8(0))
            symbol = bwt[place]
            before = by_symbol[np.maximum(at - 1, 0)]
            after = by_symbol[np.minimum(at + 1, n - 1)]
            down = _shared(low, before, place, (at > 0) & (bwt[before] == symbol))
            up = _shared(low, place, after, (at < n - 1) & (bwt[after] == symbol))
            size = n + active
            fresh = np.zeros(size, bool)
            fresh[new] = True
            kept = ~fresh
            made = {}
            for name, values in (("bwt", matrix[j, :active]), ("who", who[:active]), ("length", np.full(active, j, np.uint8))):
                column = np.empty(size, _Columns.kinds[name])
                column[kept] = columns.get(name)
                column[new] = values
                made[name] = column
            column = np.empty(size + 1, np.uint8)
            column[:size][kept] = lcp
            column[new + 1] = up
            column[new] = down
            made["lcp"] = column[:size]
            columns.put(made)
            place = new
        return {name: np.array(columns.get(name)) for name in _Columns.kinds}
    finally:
        columns.close()


def _shared(low: np.ndarray, left: np.ndarray, right: np.ndarray, same: np.ndarray) -> np.ndarray:
    """1 + the least of low[left + 1 .. right] where ``same``, else 0."""
    out = np.zeros(len(left), np.uint8)
    if same.any():
        a, b = left[same] + 1, right[same] + 1
        sort = np.argsort(b, kind="stable")
        bounds = np.empty(2 * len(a), np.int64)
        bounds[::2], bounds[1::2] = a[sort], b[sort]
        least = np.minimum.reduceat(low, bounds)[::2].astype(np.int64)
        values = np.empty(len(a), np.int64)
        values[sort] = np.minimum(least + 1, 255)
        out[same] = values
    return out
