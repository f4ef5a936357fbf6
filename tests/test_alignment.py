"""Matching blocks against difflib's, and on long texts."""

import random
import time
from difflib import SequenceMatcher

import pytest

from folioframe.operators import alignment


def expected(a, b):
    return [(m.a, m.b, m.size) for m in SequenceMatcher(None, a, b, autojunk=False).get_matching_blocks() if m.size]


def edited(r, a, alphabet, n):
    b = list(a)
    for _ in range(n):
        at, what = r.randrange(len(b) + 1), r.randrange(4)
        if what == 0:
            b[at:at] = r.choices(alphabet, k=r.randrange(1, 8))
        elif what == 1:
            del b[at : at + r.randrange(1, 8)]
        elif what == 2:
            to = r.randrange(len(b) + 1)
            piece = b[at : at + 20]
            del b[at : at + 20]
            b[to:to] = piece
        elif b:
            b[min(at, len(b) - 1)] = r.choice(alphabet)
    return b


@pytest.mark.parametrize("seed", range(10))
def test_random_pairs(seed):
    """A thousand pairs a seed: edited copies, unrelated texts, few letters, repeats; all lengths searched by runs."""
    r = random.Random(seed)
    for _ in range(1000):
        alphabet = "ab"[: r.randrange(1, 3)] if r.random() < 0.3 else "abcdefgh "[: r.randrange(2, 10)]
        a = r.choices(alphabet, k=r.randrange(0, 60)) if r.random() < 0.7 else list("".join(r.choices(alphabet, k=3)) * r.randrange(0, 15))
        b = edited(r, a, alphabet, r.randrange(0, 8)) if r.random() < 0.7 else r.choices(alphabet, k=r.randrange(0, 60))
        text = r.random() < 0.5
        a, b = ("".join(a), "".join(b)) if text else (a, b)
        # Little room for places, so that lengths between the powers of two come up.
        assert alignment.matching_blocks(a, b, places=r.choice([1, 20, 1 << 20]), small=r.choice([0, 100])) == expected(a, b)


@pytest.mark.parametrize("seed", range(4))
def test_longer_pairs(seed):
    r = random.Random(100 + seed)
    words = ["".join(r.choices("aeinorst", k=r.randrange(1, 7))) for _ in range(60)]
    a = " ".join(r.choices(words, k=500))
    b = "".join(edited(r, a, "abc ", 60))
    assert alignment.matching_blocks(a, b) == expected(a, b)
    assert alignment.matching_blocks(a.split(), b.split()) == expected(a.split(), b.split())
    other = " ".join(r.choices(words, k=400))
    assert alignment.matching_blocks(a, other) == expected(a, other)


def test_empty_and_equal():
    assert alignment.matching_blocks("", "abc") == alignment.matching_blocks("abc", "") == alignment.matching_blocks([], []) == []
    assert alignment.matching_blocks("x" * 300, "y" * 300) == []
    assert alignment.matching_blocks("same text " * 100, "same text " * 100) == [(0, 0, 1000)]


def test_a_megabyte_against_a_megabyte():
    """Edited copies, and texts that repeat one letter, whose common places are the product of the lengths."""
    r = random.Random(7)
    words = ["".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=r.randrange(2, 9))) for _ in range(20_000)]
    a = " ".join(r.choices(words, k=150_000))
    pieces = [a[k : k + 500] for k in range(0, len(a), 500)]
    b = "".join(p[: r.randrange(400, 500)] + r.choice(["", "x", " new words "]) for p in pieces)
    began = time.time()
    blocks = alignment.matching_blocks(a, b)
    assert sum(k for _, _, k in blocks) >= 0.98 * sum(len(p) for p in pieces) * 0.9 * 0.98
    assert all(a[i : i + k] == b[j : j + k] for i, j, k in blocks)
    assert alignment.matching_blocks("a" * 1_000_000, "b" + "a" * 900_000) == [(0, 1, 900_000)]
    assert time.time() - began < 60
