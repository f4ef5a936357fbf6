"""Matching blocks of two sequences by longest common runs, without work that grows with the product of their lengths.

The blocks are those of ``difflib.SequenceMatcher(None, a, b, autojunk=False)``: the longest common run of the whole, of
equal ones the first in ``a`` and then in ``b``, and the same again to its left and to its right. They are found from long
runs to short ones. Every stretch of 1, 2, 4, ... elements has a number that equal stretches share (by doubling, so that
numbers are exact). At one length, all places where both sides have the same number lie on diagonals and join up to
every common run of at least this length; the blocks are taken from these, and what lies between goes on to half the
length. By then it is small, so the common places stay few. A length with too many of them, as in texts that repeat
themselves, is raised between the powers of two until they are few, since longer runs are rarer.
"""

from __future__ import annotations

from collections.abc import Hashable, Sequence
from difflib import SequenceMatcher

import numpy as np

PLACES = 1 << 20
SMALL = 1 << 11


def _numbered(a: Sequence[Hashable], b: Sequence[Hashable]) -> np.ndarray:
    """Both sides, one after the other, as numbers; equal elements have the same one."""
    if isinstance(a, str) and isinstance(b, str):
        points = np.frombuffer((a + b).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        return np.unique(points, return_inverse=True)[1].astype(np.int64)
    known: dict[Hashable, int] = {}
    return np.array([known.setdefault(x, len(known)) for x in (*a, *b)], dtype=np.int64)


class _Stretches:
    """Numbers of stretches of any length of both sides."""

    def __init__(self, numbers: np.ndarray, n_a: int):
        self.n_a = n_a
        self.doubled = [numbers]
        while self._in_common(self.doubled[-1], 1 << len(self.doubled) - 1) and 1 << len(self.doubled) <= min(n_a, len(numbers) - n_a):
            half = 1 << len(self.doubled) - 1
            last = self.doubled[-1]
            self.doubled.append(np.unique(last[:-half] * (int(last.max()) + 1) + last[half:], return_inverse=True)[1].astype(np.int64))

    def _in_common(self, numbers: np.ndarray, size: int) -> bool:
        n = int(numbers.max()) + 1
        left = np.zeros(n, dtype=bool)
        left[numbers[: max(0, self.n_a - size + 1)]] = True
        return bool(left[numbers[self.n_a :]].any())

    def of(self, size: int, a: tuple[int, int], b: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the stretches of ``size`` that lie within [a) and within [b)."""
        power = size.bit_length() - 1
        base, more = self.doubled[power], size - (1 << power)
        cut = lambda low, high, by: base[low + by : high - size + 1 + by]
        (a0, a1), (b0, b1) = a, (b[0] + self.n_a, b[1] + self.n_a)
        if not more:
            return cut(a0, a1, 0), cut(b0, b1, 0)
        width = int(base.max()) + 1
        return cut(a0, a1, 0) * width + cut(a0, a1, more), cut(b0, b1, 0) * width + cut(b0, b1, more)


def _count(left: np.ndarray, right: np.ndarray) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """How many pairs of equal numbers there are; the order of ``right``, and where each of ``left`` lies in it."""
    order = np.argsort(right, kind="stable")
    ranked = right[order]
    low = np.searchsorted(ranked, left, side="left")
    n = np.searchsorted(ranked, left, side="right") - low
    return int(n.sum()), order, low, n


def _runs(found: tuple, size: int) -> np.ndarray:
    """(start in a, start in b, length) of every maximal common run of at least ``size``."""
    total, order, low, n = found
    i = np.repeat(np.arange(len(n)), n)
    j = order[np.repeat(low, n) + np.arange(total) - np.repeat(np.cumsum(n) - n, n)]
    by = np.lexsort((i, i - j))
    i, j = i[by], j[by]
    first = np.ones(total, dtype=bool)
    first[1:] = (i[1:] - j[1:] != i[:-1] - j[:-1]) | (i[1:] != i[:-1] + 1)
    at = np.flatnonzero(first)
    return np.stack([i[at], j[at], np.diff(np.append(at, total)) + size - 1], axis=1)


def _taken(box: tuple[int, int, int, int], runs: np.ndarray, size: int, blocks: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Takes all blocks of at least ``size`` within ``box`` from the common runs; the boxes that are left."""
    left, waiting = [], [(box, runs)]
    while waiting:
        (a0, a1, b0, b1), own = waiting.pop()
        if a0 >= a1 or b0 >= b1:
            continue
        if not len(own):
            left.append((a0, a1, b0, b1))
            continue
        longest = own[own[:, 2] == own[:, 2].max()]
        i, j, k = (int(x) for x in longest[np.lexsort((longest[:, 1], longest[:, 0]))[0]])
        blocks.append((i, j, k))
        before = own[(own[:, 0] < i) & (own[:, 1] < j)]
        before[:, 2] = np.minimum(before[:, 2], np.minimum(i - before[:, 0], j - before[:, 1]))
        after = own.copy()
        skip = np.maximum(0, np.maximum(i + k - after[:, 0], j + k - after[:, 1]))
        after += np.stack([skip, skip, -skip], axis=1)
        waiting.append(((a0, i, b0, j), before[before[:, 2] >= size]))
        waiting.append(((i + k, a1, j + k, b1), after[after[:, 2] >= size]))
    return left


def matching_blocks(a: Sequence[Hashable], b: Sequence[Hashable], places: int = PLACES, small: int = SMALL) -> list[tuple[int, int, int]]:
    """(start in a, start in b, length) of the matching blocks in order; adjacent ones are joined."""
    blocks: list[tuple[int, int, int]] = []
    if len(a) and len(b):
        if len(a) * len(b) <= small:
            return [(m.a, m.b, m.size) for m in SequenceMatcher(None, a, b, autojunk=False).get_matching_blocks() if m.size]
        numbers = _numbered(a, b)
        stretches = _Stretches(numbers, len(a))
        # Boxes with the length below which they are still to be searched.
        waiting = [((0, len(a), 0, len(b)), 2 << len(stretches.doubled) - 1)]
        while waiting:
            box, below = waiting.pop()
            a0, a1, b0, b1 = box
            if (a1 - a0) * (b1 - b0) <= small:
                own = SequenceMatcher(None, numbers[a0:a1].tolist(), numbers[len(a) + b0 : len(a) + b1].tolist(), autojunk=False).get_matching_blocks()
                blocks += [(a0 + m.a, b0 + m.b, m.size) for m in own if m.size]
                continue
            below = min(below, a1 - a0 + 1, b1 - b0 + 1)
            size = 1 << max(0, below.bit_length() - 1 - (below & below - 1 == 0))
            while True:
                found = _count(*stretches.of(size, (a0, a1), (b0, b1)))
                if found[0] <= places or size >= below - 1:
                    break
                size = (size + below) // 2
            if found[0]:
                runs = _runs(found, size) + [a0, b0, 0]
                left = _taken(box, runs, size, blocks)
            else:
                left = [box]
            if size > 1:
                waiting += [(x, size) for x in left]
    out: list[tuple[int, int, int]] = []
    for i, j, k in sorted(blocks):
        if out and out[-1][0] + out[-1][2] == i and out[-1][1] + out[-1][2] == j:
            out[-1] = (*out[-1][:2], out[-1][2] + k)
        else:
            out.append((i, j, k))
    return out
