"""Similar names by pieces of theirs that a similar run of words must hold whole.

A run of at least the wanted ratio is made from a name by at most k insertions and deletions, each of which breaks one at
most of k + 1 stretches of the name (and of the spaces around it) that do not overlap. So one of them stands in the text
unbroken, and where it stands tells where the run begins, give or take k. Each task has all names, takes as their pieces
those that are rarest in the first texts it sees (any choice finds the same), and passes over its texts once: a bitmap of
pieces, then the longest common subsequence of name and place in machine words, then the ratio itself. Nothing but the
runs that are similar leaves a task.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa

MOST, LONGEST = 20_000, 200
AT_ONCE = 1 << 20
HITS_AT_ONCE = 1 << 18
COUNTER_BITS = 16
SIZES = (4, 3, 2)
KNOWN = 200_000
_MIX = np.uint32(0x9E3779B1)
_SPACE = 1


@functools.cache
def edits(la: int, threshold: float) -> tuple[int, int, int]:
    """(most insertions and deletions, most deletions, longest run) of runs similar enough to a name of this length."""
    lb = np.arange(max(1, math.ceil(la * threshold / (2 - threshold) - 1e-9)), math.floor(la * (2 - threshold) / threshold + 1e-9) + 1)
    common = np.ceil(threshold * (la + lb) / 2 - 1e-9).astype(np.int64)
    return int((la + lb - 2 * common).max()), int((la - common).max()), int(lb[-1])


def lengths(threshold: float) -> list[int]:
    """Lengths of names that have pieces enough of two characters."""
    return [la for la in range(1, LONGEST + 1) if 2 * (edits(la, threshold)[0] + 1) <= la + 2]


def grams(classes: np.ndarray, q: int) -> np.ndarray:
    out = classes[: max(0, len(classes) - q + 1)].astype(np.uint32)
    for k in range(1, q):
        out |= classes[k : k + len(out)].astype(np.uint32) << np.uint32(8 * k)
    return out


def slots(codes: np.ndarray, bits: int) -> np.ndarray:
    return (codes * _MIX) >> np.uint32(32 - bits)


def apart(cost: dict[int, list[float]], number: int, length: int) -> list[tuple[int, int]]:
    """(offset, size) of so many stretches that do not overlap, of the least cost in all."""
    best: list[tuple[float, tuple | None]] = [(0.0, None)] * (length + 1)
    for _ in range(number):
        new: list[tuple[float, tuple | None]] = [(math.inf, None)]
        for i in range(1, length + 1):
            least = new[i - 1]
            for q in SIZES:
                if i >= q and (c := best[i - q][0] + cost[q][i - q]) < least[0]:
                    least = (c, (i - q, q, best[i - q][1]))
            new.append(least)
        best = new
    out, chain = [], best[length][1]
    while chain:
        out.append(chain[:2])
        chain = chain[2]
    return out


class Sought:
    """The names of a task: classes of their characters, bit masks for common subsequences, pieces."""

    def __init__(self, names: list[str], threshold: float):
        self.names, self.threshold = names, threshold
        points = sorted({ord(c) for n in names for c in n} - {32})
        self.table = np.zeros(0x110000, np.uint8)
        self.table[points] = 2 + np.arange(len(points)) % 254
        self.table[32] = _SPACE
        self.classes = [self.table[np.frombuffer(f" {n} ".encode("utf-32-le", "surrogatepass"), np.uint32)] for n in names]
        bounds = np.array([edits(len(n), threshold) for n in names], np.int64).reshape(-1, 3)
        self.length = np.array([len(n) for n in names], np.int64)
        self.most, gone, longest = bounds.T
        self.longest = int(longest.max())
        self.reach = self.length + 2 * self.most
        self.pad = int((self.reach + self.most).max()) + 4
        self.words = [len(n.split()) for n in names]
        prefix = np.minimum(self.length, 63)
        self.need = prefix - gone
        self.width = int(self.table.max()) + 1
        self.masks = np.zeros((len(names), self.width), np.uint64)
        for row, n, c in zip(self.masks, prefix.tolist(), self.classes, strict=True):
            np.bitwise_or.at(row, c[1 : n + 1], np.uint64(1) << np.arange(n, dtype=np.uint64))
        self.low = (np.uint64(1) << prefix.astype(np.uint64)) - np.uint64(1)
        self.prefix = prefix
        self.pieces: dict[int, tuple] = {}
        self.known: list[dict[str, float]] = [{} for _ in names]
        self.scorers: dict[int, SequenceMatcher] = {}
        self.held = 0

    def choose(self, seen: np.ndarray) -> None:
        often = {q: np.bincount(slots(grams(seen, q), COUNTER_BITS), minlength=1 << COUNTER_BITS) for q in SIZES}
        rows: dict[int, list[tuple[int, int, int]]] = {q: [] for q in SIZES}
        for k, c in enumerate(self.classes):
            codes = {q: grams(c, q) for q in SIZES}
            # A piece costs its places and a little of its own, the more the shorter it is.
            cost = {q: (often[q][slots(codes[q], COUNTER_BITS)] + 0.1 / q).tolist() for q in SIZES}
            for at, q in apart(cost, int(self.most[k]) + 1, len(c)):
                rows[q].append((int(codes[q][at]), k, at))
        for q, found in rows.items():
            if found:
                code, name, at = np.array(sorted(found), np.int64).T
                different, first = np.unique(code, return_index=True)
                bits = min(22, max(16, (32 * len(different)).bit_length()))
                marked = np.zeros(1 << bits, bool)
                marked[slots(different.astype(np.uint32), bits)] = True
                self.pieces[q] = bits, marked, different.astype(np.uint32), np.append(first, len(code)), name, at

    def places(self, classes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(name, about where its run would begin) of each piece found, some at a time."""
        for q, (bits, marked, different, first, name, offset) in self.pieces.items():
            codes = grams(classes, q)
            at = np.flatnonzero(marked[slots(codes, bits)])
            which = np.searchsorted(different, codes[at])
            good = different[np.minimum(which, len(different) - 1)] == codes[at]
            at, which = at[good], which[good]
            upto = np.cumsum(first[which + 1] - first[which])
            cuts = [0, *np.searchsorted(upto, np.arange(HITS_AT_ONCE, int(upto[-1]) if len(upto) else 0, HITS_AT_ONCE)).tolist(), len(at)]
            for x, y in zip(cuts[:-1], cuts[1:], strict=True):
                low, number = first[which[x:y]], first[which[x:y] + 1] - first[which[x:y]]
                rows = np.repeat(low - (np.cumsum(number) - number), number) + np.arange(number.sum())
                yield name[rows], np.repeat(at[x:y], number) - offset[rows] + 1

    def common(self, classes: np.ndarray, name: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """Which places share with their name a subsequence as long as a similar run must."""
        order = np.argsort(self.reach[name].astype(np.int16), kind="stable")
        who, at, reach = name[order], begin[order] - self.most[name[order]], self.reach[name[order]]
        row, masks = who * self.width, self.masks.ravel()
        v = np.full(len(who), ~np.uint64(0))
        alive = np.searchsorted(reach, np.arange(int(reach[-1]) if len(reach) else 0), side="right").tolist()
        for j, x in enumerate(alive):
            m = masks[row[x:] + classes[at[x:] + j]]
            u = v[x:]
            both = u & m
            v[x:] = (u + both) | (u ^ both)
        ok = self.prefix[who] - np.bitwise_count(v & self.low[who]) >= self.need[who]
        out = np.zeros(len(who), bool)
        out[order] = ok
        return out

    def ratio(self, name: int, run: str) -> float:
        known = self.known[name]
        if run not in known:
            if self.held > KNOWN:
                self.known, self.scorers, self.held = [{} for _ in self.names], {}, 0
                known = self.known[name]
            if name not in self.scorers:
                self.scorers[name] = SequenceMatcher(None, "", self.names[name], autojunk=False)
            scorer = self.scorers[name]
            scorer.set_seq1(run)
            known[run] = scorer.ratio() if scorer.quick_ratio() >= self.threshold else 0.0
            self.held += 1
        return known[run]

    def best(self, texts: list[tuple[int, int, str]], found: dict[tuple[int, int], tuple]) -> None:
        """Puts the best run of each (text, name) into ``found``. texts: (number, offset in its text, characters)."""
        body = " " * self.pad + " ".join(s for _, _, s in texts) + " " * self.pad
        classes = self.table[np.frombuffer(body.encode("utf-32-le", "surrogatepass"), np.uint32)]
        if not self.pieces:
            self.choose(classes[self.pad - 1 : len(classes) - self.pad + 1])
        space = classes == _SPACE
        begins = np.flatnonzero(space[:-1] & ~space[1:]) + 1
        ends = np.flatnonzero(~space[:-1] & space[1:]) + 1
        before = np.zeros(len(classes) + 1, np.int32)
        before[begins + 1] = 1
        np.cumsum(before, out=before)
        base = self.pad + np.cumsum([0] + [len(s) + 1 for _, _, s in texts])
        left = []
        for name, at in self.places(classes):
            ok = (at >= self.pad - self.most[name]) & (at < len(classes) - self.pad + self.most[name])
            name, at = name[ok], at[ok]
            ok = before[at + self.most[name] + 1] > before[at - self.most[name]]
            name, at = name[ok], at[ok]
            ok = self.common(classes, name, at)
            left.append(name[ok] * len(classes) + at[ok])
        if not left:
            return
        name, at = np.divmod(np.unique(np.concatenate(left)), len(classes))
        low, high = before[at - self.most[name]], before[at + self.most[name] + 1]
        # Each run is looked at once, however many pieces lead to it.
        name = np.repeat(name, high - low)
        word = np.repeat(low - (np.cumsum(high - low) - (high - low)), high - low) + np.arange(len(name))
        name, word = np.divmod(np.unique(name * (len(begins) + 1) + word), len(begins) + 1)
        text = np.searchsorted(base, begins[word], side="right") - 1
        listed, stops = begins.tolist(), ends.tolist()
        for k, w, t in zip(name.tolist(), word.tolist(), text.tolist(), strict=True):
            a, la, number, end = listed[w], len(self.names[k]), self.words[k], int(base[t + 1]) - 1
            for size in (number - 1, number, number + 1):
                if size < 1 or w + size > len(stops) or (z := stops[w + size - 1]) > end or 2.0 * min(la, z - a) / (la + z - a) < self.threshold:
                    continue
                run = body[a:z]
                if (r := self.ratio(k, run)) >= self.threshold:
                    rank = (r, size == number, -size, -(a - int(base[t]) + texts[t][1]), run)
                    if (texts[t][0], k) not in found or rank > found[texts[t][0], k]:
                        found[texts[t][0], k] = rank


def slices(number: int, text: str, more: int) -> Iterator[tuple[int, int, str]]:
    """A text in parts that begin and end at spaces; each holds the runs that begin in its first ``AT_ONCE`` characters."""
    first = 0
    while first < len(text):
        cut = text.find(" ", first + AT_ONCE)
        end = text.find(" ", cut + more) if cut >= 0 else -1
        yield number, first, text[first : end if end >= 0 else len(text)]
        if cut < 0:
            return
        first = cut + 1


def scored(shared, threshold: float):
    """For batches of (text_key, text_id, s); shared: broadcast (ids of names, names)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, names = shared.value
        sought = Sought(names, threshold)
        for batch in batches:
            found: dict[tuple[int, int], tuple] = {}
            held, size = [], 0
            for i, s in enumerate(batch.column(2)):
                for part in slices(i, s.as_py(), sought.longest + 1):
                    held.append(part)
                    size += len(part[2])
                    if size >= AT_ONCE:
                        sought.best(held, found)
                        held, size = [], 0
            if held:
                sought.best(held, found)
            if found:
                rows = pa.array([i for i, _ in found], pa.int64())
                ratio, same, less, back, text = zip(*found.values(), strict=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([ids[k] for _, k in found], pa.int64()), batch.column(0).take(rows), batch.column(1).take(rows), pa.array(ratio, pa.float64()), pa.array(same, pa.bool_()),
                        pa.array(less, pa.int32()), pa.array(back, pa.int64()), pa.array(text, pa.string()), pa.array([round(r, 6) for r in ratio], pa.float64()),
                    ],
                    names=["name_id", "text_key", "text_id", "ratio", "same", "size", "at", "run", "shown"],
                )

    return run
