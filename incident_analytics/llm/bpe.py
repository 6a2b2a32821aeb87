"""Byte-level BPE: pre-tokenisation by a scan of transition functions, cached merging, decoding."""

from __future__ import annotations

import base64
import hashlib
import heapq
import unicodedata
from collections.abc import Iterator
from functools import cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from incident_analytics.llm.arrays import by_text, mix, numbered, spread
from incident_analytics.llm.shared import ship

#: What a code point is to the pre-tokeniser, with what follows it where that matters: the last
#: blank of a run goes its own way, and an apostrophe may begin a contraction of one or two letters.
LETTER, NUMBER, OTHER, SHORT, LONG, SPACE, BLANK, INNER_BLANK = range(8)
#: States: after a closed token, in a run, after a last space, inside a contraction.
CLOSED, IN_LETTERS, IN_NUMBERS, IN_OTHERS, IN_BLANKS, AFTER_SPACE, ONE_LEFT, TWO_LEFT = range(8)


def _step(state: int, kind: int) -> tuple[int, bool]:
    """The next state, and whether a token begins with this code point."""
    runs = {LETTER: IN_LETTERS, NUMBER: IN_NUMBERS, OTHER: IN_OTHERS}
    if kind == SPACE:
        return AFTER_SPACE, True
    if kind == BLANK:
        return CLOSED, True
    if kind == INNER_BLANK:
        return IN_BLANKS, state != IN_BLANKS
    if kind in (SHORT, LONG):
        if state in (AFTER_SPACE, IN_OTHERS):
            return IN_OTHERS, False
        return (ONE_LEFT if kind == SHORT else TWO_LEFT), True
    if state in (ONE_LEFT, TWO_LEFT):
        return (CLOSED if state == ONE_LEFT else ONE_LEFT), False
    return runs[kind], state not in (AFTER_SPACE, runs[kind])


@cache
def _machine() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Function number per symbol, composition of functions, their value from CLOSED, and begins[state, kind].

    Symbols 8 to 15 stand for the first code point of a text: they forget the state before.
    """
    found: dict[tuple[int, ...], int] = {}

    def number(f: tuple[int, ...]) -> int:
        return found.setdefault(f, len(found))

    plain = [tuple(_step(s, k)[0] for s in range(8)) for k in range(8)]
    symbols = [number(f) for f in [*plain, *((f[CLOSED],) * 8 for f in plain)]]
    known = 0
    while known < len(found):
        known = len(found)
        for f in list(found):
            for g in list(found):
                number(tuple(g[s] for s in f))
    functions = list(found)
    compose = np.array([[found[tuple(g[s] for s in f)] for g in functions] for f in functions], np.uint16)
    begins = np.array([[_step(s, k)[1] for k in range(8)] for s in range(8)])
    return np.array(symbols, np.uint16), compose, np.array([f[CLOSED] for f in functions], np.uint8), begins


def _scan(f: np.ndarray, compose: np.ndarray) -> np.ndarray:
    """Compositions of all prefixes: pairs first, then the same on half the length."""
    if len(f) < 2:
        return f
    even = len(f) // 2 * 2
    pairs = _scan(compose[f[0:even:2], f[1:even:2]], compose)
    out = f.copy()
    out[1:even:2] = pairs
    out[2::2] = compose[pairs[: len(out[2::2])], f[2::2]]
    return out


@cache
def _kinds() -> np.ndarray:
    """Kind of each code point, from its Unicode category; White_Space is blank."""
    kinds = np.full(0x110000, OTHER, np.uint8)
    for i in range(0x110000):
        category = unicodedata.category(chr(i))[0]
        if category in "LN":
            kinds[i] = LETTER if category == "L" else NUMBER
    # Unicode's White_Space.
    for a, b in ((0x09, 0x0D), (0x20, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A),
                 (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000)):
        kinds[a : b + 1] = BLANK
    return kinds


def piece_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Byte positions at which the pieces of texts begin."""
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    at = np.flatnonzero((data & 0xC0) != 0x80)
    n = len(at)
    if not n:
        return at
    kinds = _kinds()[points]
    first = np.zeros(n, bool)
    begins = np.searchsorted(at, offsets[:-1][np.diff(offsets) > 0])
    first[begins] = True
    # A blank before a blank or the end of its text is inner.
    blank = kinds == BLANK
    follows = np.append(blank[1:] | first[1:], True)
    kinds[blank & (points == 0x20)] = SPACE
    kinds[blank & follows] = INNER_BLANK
    # Contractions lie within one text.
    quote = np.flatnonzero(points == 0x27)
    if len(quote):
        padded, edge = np.append(points, [0, 0]), np.append(first, [True, True])
        one, two = padded[quote + 1], padded[np.minimum(quote + 2, n + 1)]
        inside = ~edge[quote + 1]
        short = inside & np.isin(one, [ord(c) for c in "stmd"])
        double = (one == ord("r")) & (two == ord("e")) | (one == ord("v")) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        long = inside & double & ~edge[np.minimum(quote + 2, n + 1)]
        kinds[quote[short]], kinds[quote[long]] = SHORT, LONG
    symbols, compose, value, starts = _machine()
    after = value[_scan(symbols[kinds + 8 * first], compose)]
    before = np.append(np.uint8(CLOSED), after[:-1])
    before[first] = CLOSED
    return at[starts[before, kinds]]


_NONE = np.int64(1 << 30)


class Codec:
    """Encodes and decodes texts by the ranks of a vocabulary file, given as its bytes."""

    #: Pieces whose tokens are kept, and the longest piece (below 256 bytes) merged among others.
    CACHE, LONGEST = 400_000, 48

    def __init__(self, ranks: bytes):
        self.tokens = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        by_id = sorted((v, k) for k, v in self.tokens.items())
        if [v for v, _ in by_id] != list(range(len(by_id))):
            raise ValueError("ranks must run from 0 without gaps")
        self.single = np.array([self.tokens[bytes([i])] for i in range(256)], np.int64)
        self.bytes_of = _Ragged([k for _, k in by_id])
        self.decimal_of = _Ragged([b" %d" % v for v, _ in by_id])
        self.pairs = {}
        for token, rank in self.tokens.items():
            for cut in range(1, len(token)):
                a, b = self.tokens.get(token[:cut]), self.tokens.get(token[cut:])
                if a is not None and b is not None:
                    self.pairs[a << 20 | b] = rank
        self._index()
        #: Where the tokens of a piece stand in `_kept`, and in the last eight bits how many: a number takes less
        #: memory than an array for each piece.
        self.cache: dict[bytes, int] = {}
        self._kept, self._n_kept = np.zeros(1 << 16, np.int32), 0

    def _index(self) -> None:
        """Open addressing: a pair stands in the first free place after that of its hash."""
        self._mask = (1 << max(int(len(self.pairs) * 4).bit_length(), 4)) - 1
        self._keys = np.full(self._mask + 1, -1, np.int64)
        self._ranks = np.full(self._mask + 1, _NONE, np.int64)
        keys, ranks = np.fromiter(self.pairs, np.int64, len(self.pairs)), np.fromiter(self.pairs.values(), np.int64, len(self.pairs))
        place = (mix(keys.astype(np.uint64)) & np.uint64(self._mask)).astype(np.int64)
        while len(keys):
            free = self._keys[place] == -1
            _, chosen = np.unique(np.where(free, place, -1 - np.arange(len(place))), return_index=True)
            chosen = chosen[free[chosen]]
            self._keys[place[chosen]], self._ranks[place[chosen]] = keys[chosen], ranks[chosen]
            left = np.ones(len(keys), bool)
            left[chosen] = False
            keys, ranks, place = keys[left], ranks[left], (place[left] + 1) & self._mask

    def _pair_ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        keys = a << 20 | b
        place = (mix(keys.astype(np.uint64)) & np.uint64(self._mask)).astype(np.int64)
        out = self._ranks[place]
        there = self._keys[place]
        open_ = np.flatnonzero((there != keys) & (there != -1))
        out[there != keys] = _NONE
        while len(open_):
            place[open_] = (place[open_] + 1) & self._mask
            there = self._keys[place[open_]]
            hit = there == keys[open_]
            out[open_[hit]] = self._ranks[place[open_[hit]]]
            open_ = open_[~hit & (there != -1)]
        return out

    def _merge_together(self, data: np.ndarray, start: np.ndarray, length: np.ndarray) -> list[np.ndarray]:
        """Tokens of pieces: in each round each piece makes its merge of lowest rank, the leftmost first."""
        done: list[np.ndarray] = [np.zeros(0, np.int64)] * len(start)
        token = self.single[data[spread(start, length)]]
        piece = np.arange(len(start))
        while len(piece):
            first = np.concatenate(([0], np.cumsum(length)[:-1]))
            rank = np.full(len(token), _NONE)
            if len(token) > 1:
                rank[:-1] = self._pair_ranks(token[:-1], token[1:])
            rank[first + length - 1] = _NONE
            while True:
                best = np.minimum.reduceat(rank << 32 | np.arange(len(rank)), first)
                busy = best >> 32 < _NONE
                if 2 * busy.sum() < len(piece):
                    break
                at = best[busy] & 0xFFFFFFFF
                token[at] = rank[at]
                gone = np.zeros(len(token), bool)
                gone[at + 1] = True
                shift = np.cumsum(gone)
                token, rank = token[~gone], rank[~gone]
                length[busy] -= 1
                first = np.concatenate(([0], np.cumsum(length)[:-1]))
                last = first + length - 1
                at = at - shift[at]
                ends = last[busy]
                rank[at] = _NONE
                inner = at[at < ends]
                rank[inner] = self._pair_ranks(token[inner], token[inner + 1])
                inner = at[at > first[busy]] - 1
                rank[inner] = self._pair_ranks(token[inner], token[inner + 1])
            for i in np.flatnonzero(~busy).tolist():
                done[piece[i]] = token[first[i] : first[i] + length[i]].astype(np.int32)
            token = token[np.repeat(busy, length)]
            piece, length = piece[busy], length[busy]
        return done

    def _merge_alone(self, piece: bytes) -> np.ndarray:
        """Tokens of one long piece, by a heap of the merges."""
        token = self.single[np.frombuffer(piece, np.uint8)].tolist()
        n = len(token)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(r, i, token[i], token[i + 1]) for i in range(n - 1) if (r := self.pairs.get(token[i] << 20 | token[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if token[i] != a or j >= n or token[j] != b:
                continue
            token[i], token[j], after[i] = rank, -1, after[j]
            if after[j] < n:
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < n and (r := self.pairs.get(token[x] << 20 | token[y])) is not None:
                    heapq.heappush(heap, (r, x, token[x], token[y]))
        return np.array([t for t in token if t >= 0], np.int32)

    def _keep(self, pieces: list[bytes], tokens: list[np.ndarray]) -> None:
        size = np.array([len(x) for x in tokens], np.int64)
        end = self._n_kept + int(size.sum())
        if end > len(self._kept):
            self._kept = np.concatenate((self._kept[: self._n_kept], np.zeros(2 * end - self._n_kept, np.int32)))
        self._kept[self._n_kept : end] = np.concatenate(tokens)
        first = self._n_kept + np.cumsum(size) - size
        self.cache.update(zip(pieces, (first << 8 | size).tolist(), strict=True))
        self._n_kept = end

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and the first of each text (and the end)."""
        start = piece_starts(data, offsets)
        length = np.diff(np.append(start, len(data)))
        one, which = numbered(data, start, start + length)
        raw = data.tobytes()
        if len(self.cache) > self.CACHE:
            self.cache.clear()
            self._n_kept = 0
        pieces = [raw[a:b] for a, b in zip(start[one].tolist(), (start[one] + length[one]).tolist(), strict=True)]
        places = np.array([self.cache.get(p, -1) for p in pieces], np.int64)
        known, missing = np.flatnonzero(places >= 0), np.flatnonzero(places < 0)
        long = length[one[missing]] > self.LONGEST
        alone, short = missing[long], missing[~long]
        made = [self._merge_alone(pieces[i]) for i in alone.tolist()]
        if len(short):
            together = self._merge_together(data, start[one[short]], length[one[short]])
            self._keep([pieces[i] for i in short.tolist()], together)
            made += together
        # Tokens of the different pieces: first those that were kept, then the new ones.
        size = np.empty(len(pieces), np.int64)
        size[known] = places[known] & 0xFF
        order = np.concatenate((known, alone, short))
        size[order[len(known) :]] = [len(x) for x in made]
        flat = np.concatenate([self._kept[spread(places[known] >> 8, size[known])], *made])
        begin = np.empty(len(pieces), np.int64)
        begin[order] = np.cumsum(size[order]) - size[order]
        counts = size[which]
        out = flat[spread(begin[which], counts)]
        first = np.concatenate(([0], np.cumsum(counts)))[np.searchsorted(start, offsets)]
        return out, first

    def token_ends(self, ids: np.ndarray) -> np.ndarray:
        """Byte position after each token, when the tokens stand one after the other."""
        return np.cumsum(self.bytes_of.length[ids])

    def decode(self, ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all texts and the offsets of each."""
        return self.bytes_of.texts(ids, first)

    def decimals(self, ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids in decimal, with a space before each."""
        return self.decimal_of.texts(ids, first)


class _Ragged:
    """Byte strings by number, in one array."""

    def __init__(self, items: list[bytes]):
        self.length = np.array([len(x) for x in items], np.int64)
        self.first = np.concatenate(([0], np.cumsum(self.length)[:-1])) if items else self.length
        self.data = np.frombuffer(b"".join(items), np.uint8)

    def texts(self, ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        length = self.length[ids]
        ends = np.concatenate(([0], np.cumsum(length)))
        return self.data[spread(self.first[ids], length)], ends[first]


@cache
def codec(ranks: bytes) -> Codec:
    """The worker's codec of a vocabulary; built once."""
    return Codec(ranks)


def read_ranks(path: str) -> bytes:
    """A rank file (under a megabyte), read by the driver and sent along with the function."""
    with open(path, "rb") as file:
        return file.read()


def _lists(values: np.ndarray, first: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(values, pa.int32()))


def encode(docs: DataFrame, ranks: bytes) -> DataFrame:
    """doc_id, ids and ends of each row: its tokens, and the byte of its text after each token.

    A null or empty text has no tokens. Special tokens are ordinary text.
    """
    ship(docs.sparkSession)

    def rows(data: np.ndarray, offsets: np.ndarray) -> dict[str, object]:
        ids, first = codec(ranks).encode(data, offsets)
        ends = codec(ranks).token_ends(ids) - np.repeat(offsets[:-1], np.diff(first))
        return {"ids": _lists(ids, first), "ends": _lists(ends, first)}

    ints = pa.list_(pa.int32())
    schema = pa.schema([("doc_id", pa.int64()), ("ids", ints), ("ends", ints)])
    read = docs.selectExpr("cast(doc_id as long) doc_id", "text")
    return read.mapInArrow(by_text(rows, schema), "doc_id long, ids array<int>, ends array<int>")


def decode(tokens: DataFrame, ranks: bytes) -> DataFrame:
    """doc_id and text (as bytes) of rows with doc_id and ids; null ids give empty bytes."""
    ship(tokens.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                lists = pc.fill_null(part.column("ids"), pa.scalar([], pa.list_(pa.int32())))
                ids = lists.flatten().to_numpy(zero_copy_only=False)
                counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
                data, offsets = codec(ranks).decode(ids, np.concatenate(([0], np.cumsum(counts))))
                raw = data.tobytes()
                texts = [raw[a:b] for a, b in pairwise(offsets.tolist())]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(texts, pa.binary())], ["doc_id", "text"])

    return tokens.selectExpr("cast(doc_id as long) doc_id", "cast(ids as array<int>) ids").mapInArrow(run, "doc_id long, text binary")


def round_trip(docs: DataFrame, ranks: bytes) -> DataFrame:
    """doc_id, n_tokens, and the digests of the ids and of what they decode to.

    A null or empty text has no tokens, and the digests of nothing. Rows are encoded alone, so repeated rows and ids
    give equal results; other columns are not read.
    """
    ship(docs.sparkSession)

    def rows(data: np.ndarray, offsets: np.ndarray) -> dict[str, object]:
        ids, first = codec(ranks).encode(data, offsets)
        out = {"n_tokens": np.diff(first)}
        for name, (made, at) in (
            ("ids_sha256", codec(ranks).decimals(ids, first)),
            ("decoded_sha256", codec(ranks).decode(ids, first)),
        ):
            raw, skip = memoryview(made.tobytes()), int(name == "ids_sha256")
            out[name] = [hashlib.sha256(raw[min(a + skip, b) : b]).hexdigest() for a, b in pairwise(at.tolist())]
        return out

    texts = ["ids_sha256", "decoded_sha256"]
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), *((c, pa.string()) for c in texts)])
    read = docs.selectExpr("cast(doc_id as long) doc_id", "text")
    return read.mapInArrow(by_text(rows, schema), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
