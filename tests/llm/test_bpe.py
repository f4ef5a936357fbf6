"""The transducer against the public library's encoder, and the stream back."""

import codecs
import hashlib
import random
import tracemalloc

import numpy as np
import pytest
import regex
import tiktoken

from folioframe.llm import bpe

public_tokenizers = pytest.importorskip("public_tokenizers")
RANKS = ["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"]
ODD = [
    "", " ", "  ", "\n", "a", "'", "''s", "'s", " 's", "it's 'so'll 're've'", "I'll've  they'RE", "x'\ty's\n's", "'l", "'r", "end'v", "a  b", "a \n b", "a  b  ", "tabs\t\tand  spaces   ",
    "12 345 1a2b", "!!?? ... --- '''", "é́ ü ß ñ Ω", "日本語 テスト 한국어", "🙂🙃 👩‍👩‍👧 🇫🇷", "²³¼Ⅷ٣", "\x00\x01\x7f\x85 ", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "=" * 300, " " * 500 + "x", "\n" * 77, "the" * 50,
    "<|endoftext|> is text", "https://a.b/c?d=e&f=g#h", "    def f(x):\n\t\treturn x  # 1\n",
]


def library(name):
    return tiktoken.Encoding("test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(public_tokenizers.path(name)), special_tokens={})


def encoded(machine, texts):
    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    ids, bounds = machine.encode(np.frombuffer(b"".join(raw), np.uint8), offsets)
    return [ids[bounds[k] : bounds[k + 1]].tolist() for k in range(len(texts))]


def random_texts(r, n):
    kinds = ["abcdeinorst", "abc ", " \n\t'", "aeéèñß ", "0123456789 .,", "".join(map(chr, range(33, 127))) + "  ", "日本語한국어 ", "".join(chr(r.randrange(0x20, 0x3000)) for _ in range(300))]
    out = []
    for _ in range(n):
        alphabet = r.choice(kinds)
        out.append("".join(r.choice(alphabet) for _ in range(r.randrange(1, r.choice([8, 40, 200])))))
    return out


@pytest.mark.parametrize("name", RANKS)
def test_equals_library(name):
    r, lib = random.Random(1), library(name)
    machine = bpe.Transducer(bpe.read_ranks(public_tokenizers.path(name)))
    vocabulary = [t for t in (machine.token[k].decode("utf-8", "ignore") for k in r.sample(sorted(machine.token), 4000)) if t]
    joined = ["".join(r.choice(vocabulary) for _ in range(r.randrange(1, 6))) for _ in range(4000)]
    texts = ODD + random_texts(r, 4000) + vocabulary + joined
    for text, ids in zip(texts, encoded(machine, texts), strict=True):
        assert ids == lib.encode_ordinary(text), repr(text)


def test_every_character():
    """All code points, each between others of its neighbourhood, fall into the library's classes."""
    lib, machine = library(RANKS[0]), bpe.transducer(public_tokenizers.path(RANKS[0]))
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"{c} {c}a1" for c in every[k : k + 2000]) for k in range(0, 40_000, 2000)]
    texts += ["".join(every[k : k + 5000]) for k in range(0, len(every), 5000)]
    for text, ids in zip(texts, encoded(machine, texts), strict=True):
        assert ids == lib.encode_ordinary(text)


def test_pattern():
    r, classes = random.Random(2), bpe.character_classes()
    texts = ODD + ["".join(r.choice("a'sretvlmd \n\t1!é ") for _ in range(r.randrange(0, 30))) for _ in range(20_000)]
    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in raw])])
    got = bpe.match_starts(np.frombuffer(b"".join(raw), np.uint8), offsets, classes)
    expected = []
    for first, t in zip(offsets, texts, strict=False):
        for m in regex.finditer(public_tokenizers.PATTERN, t):
            expected.append(first + len(t[: m.start()].encode()))
    assert got.tolist() == expected


def test_pairs_that_stay():
    """Whether two tokens stay beside each other is what merging their bytes says."""
    r = random.Random(3)
    machine = bpe.transducer(public_tokenizers.path(RANKS[0]))
    whole = [t for t in r.sample(sorted(machine.token), 6000) if machine.halves(t) is not None]
    pairs = [(r.choice(whole), r.choice(whole)) for _ in range(4000)]
    for t in whole:  # borders near which a merge is likely
        piece = machine.token[t]
        pairs += [(machine.ranks[piece[:k]], machine.ranks[piece[k:]]) for k in range(1, len(piece)) if piece[:k] in machine.ranks and piece[k:] in machine.ranks]
    for a, b in pairs:
        if machine.halves(a) is None or machine.halves(b) is None:
            continue
        parts, _ = machine.merge(machine.token[a] + machine.token[b])
        assert machine.fits(a, b) == (parts == [machine.token[a], machine.token[b]])


def test_odd_vocabulary():
    """A token that merging never gives is found as a whole match only; equal ranks go by place."""
    ranks = {bytes([k]): k for k in range(256)} | {b"ab": 256, b"bc": 257, b"abc": 300, b"xyz": 299, b"aa": 258, b"aaa": 301, b"aaaa": 259}
    lib = tiktoken.Encoding("odd", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    r = random.Random(4)
    texts = ["xyz", "xyzx", "xxyz", "abc", "aabc"] + ["".join(r.choice("abcxyz") for _ in range(r.randrange(1, 14))) for _ in range(3000)]
    assert encoded(bpe.Transducer(ranks), texts) == [lib.encode_ordinary(t) for t in texts]


def test_small_tables_and_blocks():
    """Tables that fill up over and over, and texts cut into small blocks, give the same ids."""
    r, lib = random.Random(5), library(RANKS[0])
    machine = bpe.Transducer(bpe.read_ranks(public_tokenizers.path(RANKS[0])), states=300)
    texts = random_texts(r, 1500)
    assert encoded(machine, texts) == [lib.encode_ordinary(t) for t in texts]
    assert machine.resets > 3
    for text in ["".join(random_texts(r, 60)), "x" * 5000 + " é" * 500, " " * 3000, "it's  'll " * 200, "é" * 2000]:
        for block in (7, 64, 1000):
            got = np.concatenate(list(machine.blocks(np.frombuffer(text.encode(), np.uint8), block)))
            assert got.tolist() == lib.encode_ordinary(text)


def test_long_text_memory():
    """Memory follows the block: a text of 12 MB takes little more than one of 3 MB."""
    machine = bpe.transducer(public_tokenizers.path(RANKS[0]))
    peaks = []
    for n in (300_000, 1_200_000):
        raw = np.frombuffer(b"Some words " * n, np.uint8)
        tracemalloc.start()
        assert sum(len(ids) for ids in machine.blocks(raw, 1 << 18)) == 2 * n + 1
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert peaks[1] < peaks[0] + 4e6


def test_stream_decoder():
    """At every cut of the ids only whole characters come out, and malformed bytes pass through."""
    r = random.Random(6)
    ranks = bpe.read_ranks(public_tokenizers.path(RANKS[0]))
    tokens, lib = bpe.Bytes(ranks), library(RANKS[0])
    for case in range(300):
        ids = np.array(lib.encode_ordinary("🙂日é ñ𝄞a" * r.randrange(1, 5)) if case % 2 else [r.randrange(256) for _ in range(r.randrange(1, 40))], dtype=np.uint32)
        decoder, whole, text, at = bpe.StreamDecoder(tokens), codecs.getincrementaldecoder("utf-8")("replace"), "", 0
        data = b""
        while at < len(ids):
            n = r.randrange(1, 4)
            got = decoder.feed(ids[at : at + n])
            assert got.decode("utf-8", "replace") == whole.decode(tokens.join(ids[at : at + n]))
            data += got
            at += n
        data += decoder.finish()
        assert data == lib.decode_bytes(ids.tolist())
    assert "".join(map(chr, [0xD7FF, 0xE000, 0x10FFFF])).encode() == bpe.StreamDecoder(tokens).feed(np.array(lib.encode_ordinary("퟿\U0010ffff"), dtype=np.uint32))


def expected_rows(rows):
    lib = library(RANKS[0])
    out = []
    for r in rows:
        ids = lib.encode_ordinary(r[1] or "")
        out.append((r[0], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((r[1] or "").encode()).hexdigest()))
    return out


def test_documents(spark, docs, doc_rows, no_docs):
    from pyspark.sql import functions as F

    for block in (64, bpe.BLOCK):
        named = bpe.encode_documents(docs, block=block).select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), "ids")
        got = bpe.decode_documents(named, piece=5).select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256")).collect()
        key = lambda t: (t[0] is None, t)
        assert sorted(map(tuple, got), key=key) == sorted(expected_rows(doc_rows), key=key)
    assert bpe.decode_documents(bpe.encode_documents(no_docs)).count() == 0
