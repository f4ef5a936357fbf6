"""Printed names and their mentions: exact, folded and fuzzy tiers.

A short list of names (an index of a book) goes to all tasks as one automaton, behind a check of its size; longer ones,
and names that need only be similar, meet the texts in joins on grams (``name_grams``).
"""

from __future__ import annotations

from collections.abc import Iterator
from difflib import SequenceMatcher

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioframe.operators import name_grams

AUTOMATON_NAMES = 100_000
FUZZY_THRESHOLD = 0.9
WORDS_AT_ONCE = 1 << 16


def _short_list(names: DataFrame, key: str, name: str, most: int) -> list[tuple] | None:
    """The names, or None if there are more than ``most``."""
    rows = names.select(key, name).where(F.col(name).isNotNull() & (F.col(name) != "")).limit(most + 1).collect()
    return None if len(rows) > most else [(r[0], r[1]) for r in rows]


def exact(names: DataFrame, texts: DataFrame, key: str, name: str, text_key: str, text: str, fold: bool = True, most: int = AUTOMATON_NAMES) -> DataFrame:
    """(key, text_key) of each text that holds a name, in any case if ``fold``: one automaton over up to ``most`` names,
    joins for more."""
    listed = _short_list(names, key, name, most)
    if listed is None:
        return name_grams.containing(names, texts, key, name, text_key, text, fold)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: dict[str, list] = {}
        for k, n in listed:
            found.setdefault(n.lower() if fold else n, []).append(k)
        automaton = ahocorasick.Automaton()
        for n, keys in found.items():
            automaton.add_word(n, keys)
        if found:
            automaton.make_automaton()
        for b in batches:
            out = []
            for t, s in zip(b[text_key], b[text], strict=True):
                if s and found:
                    hits = {k for _, keys in automaton.iter(s.lower() if fold else s) for k in keys}
                    out += [(k, t) for k in hits]
            yield pd.DataFrame(out, columns=[key, text_key])

    kinds = {c: d.schema[c].dataType.simpleString() for c, d in ((key, names), (text_key, texts))}
    return texts.select(text_key, text).mapInPandas(run, f"{key} {kinds[key]}, {text_key} {kinds[text_key]}")


def likely_windows(names: list[str], words: list[str], threshold: float = FUZZY_THRESHOLD) -> list[list[tuple[float, int, int]]]:
    """For each name (bound, words, first word) of the runs of about its number of words that may be similar enough, by
    descending bound. The bound counts characters in common, for many runs at once, and is never below the ratio."""
    letters = {c: k for k, c in enumerate(sorted({c for n in names for c in n} | {" "}))}

    def counts(text: str) -> list[int]:
        return [text.count(c) for c in letters]

    wanted = [(len(n.split()), len(n), np.array(counts(n), np.int32)) for n in names]
    sizes = sorted({s for n, _, _ in wanted for s in (n - 1, n, n + 1) if s >= 1})
    out: list[list[tuple[float, int, int]]] = [[] for _ in names]
    for first in range(0, len(words), WORDS_AT_ONCE):
        part = words[first : first + WORDS_AT_ONCE + max(sizes, default=1) - 1]
        known = {w: [*counts(w), len(w)] for w in set(part)}
        rows = np.array([known[w] for w in part], np.int32)
        sums = np.concatenate((np.zeros((1, len(letters) + 1), np.int32), np.cumsum(rows, axis=0, dtype=np.int32)))
        for size in sizes:
            n = min(WORDS_AT_ONCE, len(part) - size + 1)
            if n < 1:
                continue
            window = sums[size : size + n] - sums[:n]
            window[:, letters[" "]] += size - 1
            length = window[:, -1] + size - 1
            for k, (number, chars, count) in enumerate(wanted):
                if abs(size - number) <= 1:
                    # First the bound of the lengths alone, which most runs fail.
                    fits = np.flatnonzero(2.0 * np.minimum(length, chars) / (length + chars) >= threshold)
                    bound = 2.0 * np.minimum(window[fits, :-1], count).sum(1) / (length[fits] + chars)
                    ok = bound >= threshold
                    out[k] += zip(bound[ok].tolist(), [size] * int(ok.sum()), (first + fits[ok]).tolist(), strict=True)
    return [sorted(x, reverse=True) for x in out]


def most_similar(name: str, words: list[str], threshold: float = FUZZY_THRESHOLD, windows: list[tuple[float, int, int]] | None = None) -> tuple[float, str, int] | None:
    """(ratio, run, first word) of the run of words most similar to the name, best bounds first until none can be
    better. Of equal ones the run of as many words as the name has counts, then the shorter, then the earlier."""
    number = len(name.split())
    scorer = SequenceMatcher(None, "", name, autojunk=False)
    ratios: dict[str, float] = {}
    best = None
    for bound, size, at in likely_windows([name], words, threshold)[0] if windows is None else windows:
        if best and bound < best[0]:
            break
        run = " ".join(words[at : at + size])
        if run not in ratios:
            scorer.set_seq1(run)
            ratios[run] = scorer.ratio()
        rank = (ratios[run], size == number, -size, -at, run)
        if rank[0] >= threshold and (best is None or rank > best):
            best = rank
    return best and (best[0], best[4], -best[3])


def fuzzy(names: DataFrame, texts: DataFrame, key: str, name: str, text_key: str, text: str, threshold: float = FUZZY_THRESHOLD) -> DataFrame:
    """(key, text_key, ratio, window) where a run of words is similar enough to a name."""
    return name_grams.similar(names, texts, key, name, text_key, text, threshold)
