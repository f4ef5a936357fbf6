"""Byte-level BPE as a finite-state transducer, and its way back as a stream.

Encoding. The merges of a rank file act on the matches of a split pattern. For each prefix of a match, the last token
of its encoding is the one token at its end that is compatible with the last token of what stands before: merging both
byte strings gives these two tokens again. So the encodings of all prefixes form a tree, and a state of the transducer
holds what of it still matters: the places from which a token may yet grow (as nodes of the trie of tokens), each with
the tokens since the last point all of them share. When a byte leaves only one way on, the tokens up to the next shared
point are emitted; no place stays open longer than the longest token, which bounds the lookahead. States and
transitions are made when a text first needs them and kept in dense tables; a table that is full starts anew with the
states in use. Tables step through all matches of a block of text at once, a byte of each per step.

Decoding. Bytes of the ids are put together in pieces; a state machine over UTF-8 tells how many bytes at the end of a
piece begin a character that is not yet whole, and these wait for the next piece.

Memory follows blocks of text (and the longest single match), not the length of a text. Defined results: a null text is
an empty one and has no ids; rows of one id are encoded each; an empty table gives no rows; special tokens in a text
are ordinary text; bytes that are no UTF-8 decode to the bytes themselves, and as text to U+FFFD.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioframe.llm.textkernel import chunks, release_memory

BLOCK = 1 << 19
STATES = 1 << 16
MEMO = 1 << 18
NARROW = 48
OTHER, LETTER, NUMBER, BLANK = range(4)
NEVER = 1 << 60
START, FREE, NONE = -1, -2, -3  # before a place: the start of the match, a token that fits all that may grow, tokens not yet emitted
_kept: dict[str, Transducer] = {}


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


# ---------------------------------------------------------------- matches of the split pattern


def character_classes() -> np.ndarray:
    """The class of each code point: letter, number, white space or other."""
    table = np.full(0x110000, OTHER, dtype=np.uint8)
    for low, high in ((0, 0xD800), (0xE000, 0x110000)):
        every = "".join(map(chr, range(low, high)))
        for name, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (BLANK, r"\p{White_Space}+")):
            for m in regex.finditer(pattern, every):
                table[low + m.start() : low + m.end()] = name
    return table


def match_starts(raw: np.ndarray, offsets: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Byte offsets at which matches of the pattern begin; matches leave nothing out and end where the next begins.

    A match is a run of one class of characters. One space before a run belongs to it, other white space is a match but
    for its last character, and an apostrophe that no space precedes takes the ending s, t, re, ve, m, ll or d after it.
    """
    if not len(raw):
        return np.zeros(0, np.int64)
    lead = np.flatnonzero((raw & 0xC0) != 0x80)
    point = np.frombuffer(raw.tobytes().decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    n = len(point)
    kind = classes[point]
    begins = np.empty(n + 3, dtype=bool)
    begins[n:] = True
    begins[0] = True
    np.not_equal(kind[1:], kind[:-1], out=begins[1:n])
    first_of_text = np.searchsorted(lead, offsets[:-1][offsets[:-1] < len(raw)])
    begins[first_of_text] = True
    inner = np.ones(n + 1, dtype=bool)  # false where a text begins
    inner[first_of_text] = False
    inner[n] = False
    run = begins[: n + 1].copy()
    # The last white space before a run of another kind.
    last = np.flatnonzero(kind == BLANK)
    last = last[run[last + 1] & inner[last + 1]]
    begins[last] = True
    begins[last[point[last] == 0x20] + 1] = False
    # An apostrophe that is a run of its own and the start of a match, before letters of the same text.
    mark = np.flatnonzero(point == 0x27)
    mark = mark[begins[mark] & run[mark] & run[mark + 1] & inner[mark + 1]]
    if len(mark):
        after = np.concatenate([point, np.zeros(2, np.uint32)])
        one, two = after[mark + 1], after[mark + 2]
        short = np.isin(one, [ord(c) for c in "stmd"])
        same_run = ~run[np.minimum(mark + 2, n)]
        long = same_run & (((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l")))
        for at, size in ((mark[short], 1), (mark[long & ~short], 2)):
            begins[at + 1] = False
            begins[at + 1 + size] = True
    return lead[begins[:n]]


# ---------------------------------------------------------------- the transducer


class Transducer:
    """Encodes the matches of the pattern by the ranks of a vocabulary."""

    def __init__(self, ranks: dict[bytes, int], states: int = STATES):
        self.ranks, self.limit = ranks, states
        self.token = {v: k for k, v in ranks.items()}
        self.classes = character_classes()
        self.child: dict[int, int] = {}
        self.ends: list[int] = [-1]  # the token that ends at a node of the trie
        self.below: list[list[int]] = [[]]
        self.spelling: list[bytes] = [b""]
        self.least: list[int] = [0]  # the lowest rank at or below a node
        for piece, rank in ranks.items():
            node = 0
            for k, b in enumerate(piece, 1):
                key = node << 8 | b
                if key not in self.child:
                    self.child[key] = len(self.ends)
                    self.below[node].append(len(self.ends))
                    self.ends.append(-1)
                    self.below.append([])
                    self.spelling.append(piece[:k])
                    self.least.append(rank)
                node = self.child[key]
                self.least[node] = min(self.least[node], rank)
            self.ends[node] = rank
        self._halves: dict[int, tuple[int, int] | None] = {}
        self._fits: dict[int, bool] = {}
        self._grows: dict[int, bool] = {}
        self.resets = -1
        self.column, self.width = np.full(256, -1, dtype=np.int64), 64  # tables have a column for each byte met
        self._forget()

    # -- merges

    def merge(self, piece: bytes) -> tuple[list[bytes], tuple[bytes, bytes] | None]:
        """The tokens of ``piece`` by merging the pair of the lowest rank, leftmost first, and the last pair merged."""
        parts, last = [piece[k : k + 1] for k in range(len(piece))], None
        while len(parts) > 1:
            rank, at = min((self.ranks.get(parts[k] + parts[k + 1], NEVER), k) for k in range(len(parts) - 1))
            if rank == NEVER:
                break
            last = parts[at], parts[at + 1]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts, last

    def halves(self, token: int) -> tuple[int, int] | None:
        """The pair that a token was last merged from; itself twice for a byte, None if merging never gives it."""
        if token not in self._halves:
            piece = self.token[token]
            parts, last = self.merge(piece)
            self._halves[token] = (token, token) if len(piece) == 1 else (self.ranks[last[0]], self.ranks[last[1]]) if len(parts) == 1 else None
        return self._halves[token]

    def fits(self, left: int, right: int) -> bool:
        """Whether ``left`` and ``right`` stay as they are beside each other.

        Undoes the merges next to the border from the latest to the earliest. A merge across the border would have
        happened if its rank is below those of the merges that took in the pieces beside it; of equal ranks the leftmost
        goes first.
        """
        key = left << 32 | right
        if key not in self._fits:
            if len(self._fits) > MEMO:
                self._fits.clear()
            self._fits[key] = self._stays(left, right)
        return self._fits[key]

    def _stays(self, left: int, right: int) -> bool:
        born = lambda t: -1 if len(self.token[t]) == 1 else t
        left_until = right_until = NEVER
        while True:
            across = self.ranks.get(self.token[left] + self.token[right], NEVER)
            if across < left_until and across <= right_until and across < NEVER:
                return False
            if born(left) < 0 and born(right) < 0:
                return True
            if born(left) > born(right):
                left_until, left = left, self.halves(left)[1]
            else:
                right_until, right = right, self.halves(right)[0]

    def grows(self, left: int, node: int) -> bool:
        """Whether any token below ``node`` of the trie may stand after ``left``."""
        key = left << 32 | node
        if key not in self._grows:
            if len(self._grows) > MEMO:
                self._grows.clear()
            found, below, any_fits = False, [node], left < 0 or self.free(left, node)
            none_fits = not any_fits and self.barred(left, node)
            while below and not found and not none_fits:
                for to in self.below[below.pop()]:
                    token = self.ends[to]
                    if token >= 0 and self.halves(token) is not None and (any_fits or self.fits(left, token)):
                        found = True
                        break
                    below.append(to)
            self._grows[key] = found
        return self._grows[key]

    def free(self, left: int, node: int) -> bool:
        """Whether ``left`` is known to stay as it is before every token below ``node``: no token that reaches across the
        border from one of its last pieces has a rank below that of the merge that takes the piece in."""
        if node == 0:
            return False
        until, piece = NEVER, left
        while True:
            at, inside = 0, len(self.token[piece])
            for k, b in enumerate(self.token[piece] + self.spelling[node]):
                at = self.child.get(at << 8 | b)
                if at is None or k >= inside and 0 <= self.ends[at] < until:
                    break
            if at is not None and self.least[at] < until:
                return False
            if len(self.token[piece]) == 1:
                return True
            until, piece = piece, self.halves(piece)[1]

    def barred(self, left: int, node: int) -> bool:
        """Whether no token below ``node`` is known to stay after ``left``: the first byte joins one of its last pieces by
        a lower rank than any merge to the right of that byte can have."""
        if node == 0:
            return False
        right = self.spelling[node]
        soonest = min([NEVER, *[self.least[to] for to in self.below[node]], *[self.ranks.get(right[:k], NEVER) for k in range(2, len(right) + 1)]])
        until, piece = NEVER, left
        while True:
            if self.ranks.get(self.token[piece] + right[:1], NEVER) < min(until, soonest):
                return True
            if len(self.token[piece]) == 1:
                return False
            until, piece = piece, self.halves(piece)[1]

    # -- states

    def _forget(self) -> None:
        """Empty tables."""
        self.emission: dict[tuple, int] = {(): 0}
        self.emitted: list[int] = []
        self.emit_at, self.emit_n = [0], [0]
        self.meaning: list[tuple] = []
        self._renewed(np.zeros(0, np.int64))

    def _renewed(self, states: np.ndarray) -> np.ndarray:
        """Tables that hold the first state and ``states`` only; their new numbers. What was emitted keeps its number."""
        live, place = np.unique(states, return_inverse=True)
        kept = [self.meaning[s] for s in live]
        self.resets += 1
        self.meaning = []
        self.number: dict[tuple, int] = {}
        self.next = np.full((256, self.width), -1, dtype=np.int32)
        self.out = np.zeros((256, self.width), dtype=np.int32)
        self.final = np.zeros(256, dtype=np.int32)
        self._state(((0, START, ()),))
        new = np.array([self._state(m) for m in kept], dtype=np.int64)
        self.room = max(self.limit, 2 * len(self.meaning))
        return new[place]

    def _emission(self, tokens: tuple) -> int:
        k = self.emission.setdefault(tokens, len(self.emit_at))
        if k == len(self.emit_at):
            self.emit_at.append(len(self.emitted))
            self.emit_n.append(len(tokens))
            self.emitted += tokens
        return k

    def _state(self, meaning: tuple) -> int:
        """The number of a state: its open places as (node, what stands before, tokens since the shared point)."""
        if (s := self.number.get(meaning)) is not None:
            return s
        s = self.number[meaning] = len(self.meaning)
        self.meaning.append(meaning)
        if s == len(self.next):
            grow = lambda a, fill: np.concatenate([a, np.full_like(a, fill)])
            self.next, self.out, self.final = grow(self.next, -1), grow(self.out, 0), grow(self.final, 0)
        node, before, _ = meaning[0]
        whole = self.ends[node] if before == START else -1
        # A match that is a token as a whole is that token, though merging may not give it.
        self.final[s] = self._emission((whole,) if whole >= 0 else meaning[-1][2])
        return s

    def _columns(self, raw: np.ndarray) -> None:
        """Gives each byte of ``raw`` a column."""
        met = np.flatnonzero(np.bincount(raw, minlength=256))
        new = met[self.column[met] < 0]
        self.column[new] = np.arange(len(new)) + int((self.column >= 0).sum())
        while self.column.max() >= self.width:
            wider = lambda a, fill: np.concatenate([a, np.full_like(a, fill)], axis=1)
            self.next, self.out, self.width = wider(self.next, -1), wider(self.out, 0), 2 * self.width

    def step(self, state: int, byte: int) -> int:
        """Makes the transition from ``state`` by ``byte``; gives the next state."""
        grown, here = [], None
        for node, before, since in self.meaning[state]:  # the oldest place has the longest token
            to = self.child.get(node << 8 | byte)
            if to is None:
                continue
            token = self.ends[to]
            last = since[-1] if since else before
            if here is None and token >= 0 and self.halves(token) is not None and (last < 0 or self.fits(last, token)):
                here = (*since, token)
            if before == START:  # the whole match so far may be a token that merging does not give
                open_ = bool(self.below[to]) or token >= 0 and self.halves(token) is None
            else:
                open_ = self.grows(last, to)
            if open_:
                grown.append((to, before, since))
        grown.append((0, NONE, here))
        shared = 0
        shortest = min(len(since) for _, _, since in grown)
        while shared < shortest and all(since[shared] == here[shared] for _, _, since in grown):
            shared += 1
        done = here[:shared]
        places = []
        for node, before, since in grown:
            rest = since[shared:]
            if not rest and before != START:
                last = done[-1] if done else before
                before = FREE if last == FREE or self.free(last, node) else last
            places.append((node, before, rest))
        reached = self._state(tuple(places))
        self.next[state, self.column[byte]] = reached
        self.out[state, self.column[byte]] = self._emission(done)
        return reached

    # -- runs over text

    def run(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, byte offset at which each was emitted) of the matches [start, end), in order of the text."""
        if len(self.emit_at) > 8 * self.limit:
            self._forget()
        self._columns(raw)
        at = np.zeros((len(raw), 2), dtype=np.int32)  # what is emitted with a byte, and at the end of a match
        order = np.argsort(starts - ends, kind="stable")  # the longest first
        begin, size = starts[order], (ends - starts)[order]
        state = np.zeros(len(order), dtype=np.int64)
        column, active = 0, len(order)
        while active > NARROW:
            if len(self.meaning) > self.room:
                state[:active] = self._renewed(state[:active])
            place = begin[:active] + column
            byte, now = raw[place], state[:active]
            cell = self.column[byte]
            to = self.next[now, cell]
            if (new := np.flatnonzero(to < 0)).size:
                for key in np.unique(now[new] << 8 | byte[new]):
                    self.step(int(key) >> 8, int(key) & 255)
                to = self.next[now, cell]
            out = self.out[now, cell]
            state[:active] = to
            told = np.flatnonzero(out)
            at[place[told], 0] = out[told]
            column += 1
            left = int(np.searchsorted(-size[:active], -column, side="left"))
            ended = slice(left, active)
            at[begin[ended] + size[ended] - 1, 1] = self.final[state[ended]]
            active = left
        for k in range(active):  # the few longest, one by one
            s, a = int(state[k]), int(begin[k])
            for p, b in enumerate(raw[a + column : a + int(size[k])].tolist(), a + column):
                if (to := int(self.next[s, self.column[b]])) < 0:
                    if len(self.meaning) > self.room:
                        fresh = self._renewed(np.append(state[k:active], s))
                        state[k:active], s = fresh[:-1], int(fresh[-1])
                    to = self.step(s, b)
                if out := self.out[s, self.column[b]]:
                    at[p, 0] = out
                s = to
            at[a + int(size[k]) - 1, 1] = self.final[s]
        return self._tokens(at)

    def _tokens(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        flat = at.ravel()
        told = np.flatnonzero(flat)
        n = np.array(self.emit_n, dtype=np.int64)[flat[told]]
        first = np.array(self.emit_at, dtype=np.int64)[flat[told]]
        inside = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        ids = np.array(self.emitted, dtype="<u4")[np.repeat(first, n) + inside]
        return ids, np.repeat(told >> 1, n)

    def encode(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, place of each text's first id) of UTF-8 texts that lie one after another."""
        starts = match_starts(raw, offsets, self.classes)
        ids, place = self.run(raw, starts, np.append(starts[1:], len(raw)))
        return ids, np.searchsorted(place, offsets)

    def blocks(self, raw: np.ndarray, block: int) -> Iterator[np.ndarray]:
        """The ids of one long text, block by block. A match whose end the block shows is final; the next block begins
        after the last of them, and is longer where a match is longer than a block."""
        first, size = 0, block
        while first < len(raw):
            stop = min(len(raw), first + size)
            while stop < len(raw) and raw[stop] & 0xC0 == 0x80:
                stop += 1
            part = raw[first:stop]
            starts = match_starts(part, np.array([0, len(part)]), self.classes)
            if stop < len(raw):
                lead = np.flatnonzero((part & 0xC0) != 0x80)
                starts = starts[starts <= lead[-3]] if len(lead) >= 3 else starts[:1]  # three characters decide any match
                if len(starts) < 2:
                    size *= 2
                    continue
                part, starts = part[: starts[-1]], starts[:-1]
            yield self.run(part, starts, np.append(starts[1:], len(part)))[0]
            first, size = first + len(part), block


def transducer(path: str) -> Transducer:
    """The transducer of a rank file; one for each worker, so that tasks go on with the tables of those before."""
    if path not in _kept:
        _kept[path] = Transducer(read_ranks(path))
    return _kept[path]


# ---------------------------------------------------------------- decoding


def _utf8_states() -> np.ndarray:
    """next[state, byte] of well-formed UTF-8. States: 0 between characters, 1 to 3 that many bytes to come, 4 to 7 after
    E0, ED, F0 and F4, whose next byte has a narrower range, 8 malformed."""
    table = np.full((9, 256), 8, dtype=np.uint8)
    table[0, :0x80] = 0
    table[0, 0xC2:0xE0] = 1
    table[0, 0xE0:0xF0] = 2
    table[0, 0xF0:0xF5] = 3
    table[0, [0xE0, 0xED, 0xF0, 0xF4]] = 4, 5, 6, 7
    for state, low, high, to in ((1, 0x80, 0xC0, 0), (2, 0x80, 0xC0, 1), (3, 0x80, 0xC0, 2), (4, 0xA0, 0xC0, 1), (5, 0x80, 0xA0, 1), (6, 0x90, 0xC0, 2), (7, 0x80, 0x90, 2)):
        table[state, low:high] = to
    return table


class StreamDecoder:
    """Turns ids into whole characters, piece by piece; at most three bytes wait between pieces."""

    states = _utf8_states().tolist()

    def __init__(self, tokens: Bytes):
        self.tokens, self.held = tokens, b""

    def feed(self, ids: np.ndarray) -> bytes:
        """The bytes of all characters that are whole by now; bytes that can be no part of a character go through."""
        data = self.held + self.tokens.join(ids)
        # Only the last character can be open: it begins at the last byte that is no continuation.
        at = len(data)
        while at > max(0, len(data) - 4):
            at -= 1
            if data[at] & 0xC0 != 0x80:
                break
        state = 0
        for b in data[at:]:
            state = self.states[state][b] if state < 8 else 8
        cut = at if 0 < state < 8 else len(data)
        self.held = data[cut:]
        return data[:cut]

    def finish(self) -> bytes:
        """What is left of a character that was never whole."""
        left, self.held = self.held, b""
        return left


class Bytes:
    """The bytes of each id of a vocabulary, joined by lookups for many ids at once."""

    def __init__(self, ranks: dict[bytes, int]):
        size = max(ranks.values()) + 1
        pieces = [b""] * size
        for piece, k in ranks.items():
            pieces[k] = piece
        self.size = np.array([len(p) for p in pieces], dtype=np.int64)
        self.first = np.cumsum(self.size) - self.size
        self.all = np.frombuffer(b"".join(pieces), dtype=np.uint8)

    def join(self, ids: np.ndarray) -> bytes:
        n = self.size[ids]
        inside = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        return self.all[np.repeat(self.first[ids], n) + inside].tobytes()


# ---------------------------------------------------------------- over tables


def _encoding(path: str, block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(path)
        for batch in batches:
            for first, raw, offsets in chunks(batch.column(1), block):
                if len(offsets) == 2 and len(raw) > block:
                    ids = np.concatenate(list(machine.blocks(raw, block)))
                    bounds = np.array([0, len(ids)])
                else:
                    ids, bounds = machine.encode(raw, offsets)
                n = len(bounds) - 1
                cells = [ids[bounds[k] : bounds[k + 1]].tobytes() for k in range(n)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, n), pa.array(np.diff(bounds), pa.int64()), pa.array(cells, pa.binary())], names=["doc_id", "n_tokens", "ids"])
        release_memory()

    return run


def encode_documents(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", ranks_path: str | None = None, block: int = BLOCK) -> DataFrame:
    """(doc_id, n_tokens, ids) of all documents; ids are little-endian unsigned 32-bit integers."""
    texts = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(_encoding(ranks_path or default_ranks(), block), "doc_id long, n_tokens long, ids binary")


def _decoding(path: str, ids_at: int, names: list[str], piece: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Bytes(read_ranks(path))
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                cells = []
                for blob in part.column(ids_at):
                    ids = np.frombuffer(blob.as_buffer(), dtype="<u4") if blob.is_valid else np.zeros(0, np.uint32)
                    decoder = StreamDecoder(tokens)
                    pieces = [decoder.feed(ids[k : k + piece]) for k in range(0, len(ids), piece)]
                    cells.append(b"".join([*pieces, decoder.finish()]))
                columns = [c for k, c in enumerate(part.columns) if k != ids_at]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(cells, pa.binary())], names=names)
        release_memory()

    return run


def decode_documents(encoded: DataFrame, *, ids_col: str = "ids", ranks_path: str | None = None, piece: int = 1 << 16) -> DataFrame:
    """``encoded`` with ``decoded`` (the bytes of the ids) in place of the ids."""
    kept = [f for f in encoded.schema.fields if f.name != ids_col]
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in kept], "decoded binary"])
    place = [f.name for f in encoded.schema.fields].index(ids_col)
    return encoded.mapInArrow(_decoding(ranks_path or default_ranks(), place, [*[f.name for f in kept], "decoded"], piece), schema)


def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = encode_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    named = encoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), "ids")
    return decode_documents(named).select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))
