"""Small numpy helpers for operators that read whole texts as Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are worked on together, so that eight bytes for each stay in a core's cache; a longer text
#: is worked on alone.
SLICE_BYTES = 1 << 18

#: `[\x20\x09-\x0D]`, the bytes between words.
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
#: Lower-cases A-Z and leaves every other byte alone.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_SEED = np.uint64(0x9E3779B97F4A7C15)
#: An odd base and its inverse modulo 2**64: a rolling hash needs no division by large powers.
_BASE = np.uint64(0xD6E8FEB86659FD93)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of uint64 whose output bits depend on all input bits."""
    x = x + _SEED
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_OF_BYTE = mix(np.arange(256, dtype=np.uint64))
#: Bytes of a span that are read eight at a time; longer spans are digested one by one.
_SHORT_SPAN = 128
#: Keeps the first bytes of eight, by their number.
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


class Rolling:
    """Hashes of any run of a sequence of uint64 from prefix sums: equal runs hash alike anywhere.

    For short runs of values that are hashes themselves. Modulo a power of two, long runs of two values that
    alternate in a certain way meet whatever the base, so bytes are hashed by `spans`.
    """

    _up = _powers(_BASE, 2 * SLICE_BYTES)
    _down = _powers(_INVERSE, 2 * SLICE_BYTES)

    def __init__(self, values: np.ndarray):
        n = len(values)
        # Powers for a longer sequence go with it.
        long = n > len(Rolling._up)
        up = _powers(_BASE, n) if long else Rolling._up
        self.down = _powers(_INVERSE, n) if long else Rolling._down
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values * up[:n], out=self.sums[1:])

    def run(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of values[start:end], start <= end, start below the length unless empty."""
        at = np.minimum(start, max(len(self.sums) - 2, 0))
        return mix((self.sums[end] - self.sums[start]) * self.down[at] + (end - start).astype(np.uint64))

    def windows(self, k: int) -> np.ndarray:
        """Hash of the window of k values at each start."""
        n = len(self.sums) - 1 - k + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mix((self.sums[k:] - self.sums[:n]) * self.down[:n] + np.uint64(k))


def byte_hashes(data: np.ndarray) -> Rolling:
    """Hashes of short runs of bytes."""
    return Rolling(_OF_BYTE[data])


def _eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as a number; behind the end stand zeros."""
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    return np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))


def spans(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of the bytes data[start:end] of each span, which may overlap.

    Eight bytes after eight go through `mix`, so there is no sum in which different bytes could cancel out.
    """
    size = (end - start).astype(np.int64)
    out = mix(size.astype(np.uint64))
    eight = _eights(data)
    left = np.flatnonzero((size > 0) & (size <= _SHORT_SPAN))
    step = 0
    while len(left):
        some = eight[start[left] + step] & _MASKS[np.minimum(size[left] - step, 8)]
        out[left] = mix(out[left] ^ some)
        step += 8
        left = left[size[left] > step]
    long = np.flatnonzero(size > _SHORT_SPAN)
    if len(long):
        view = memoryview(np.ascontiguousarray(data))
        digests = [blake2b(view[a:b], digest_size=8).digest() for a, b in zip(start[long].tolist(), end[long].tolist(), strict=True)]
        out[long] = np.frombuffer(b"".join(digests), "<u8")
    return out


def same_spans(data: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the `size` bytes from a and from b on are the same, for each pair."""
    out = np.ones(len(a), bool)
    eight = _eights(data)
    left = np.flatnonzero((size > 0) & (size <= _SHORT_SPAN) & (a != b))
    step = 0
    while len(left):
        odd = (eight[a[left] + step] ^ eight[b[left] + step]) & _MASKS[np.minimum(size[left] - step, 8)]
        out[left[odd != 0]] = False
        step += 8
        left = left[(odd == 0) & (size[left] > step)]
    view = memoryview(np.ascontiguousarray(data))
    for i in np.flatnonzero((size > _SHORT_SPAN) & (a != b)).tolist():
        out[i] = view[a[i] : a[i] + size[i]] == view[b[i] : b[i] + size[i]]
    return out


def numbered(data: np.ndarray, start: np.ndarray, end: np.ndarray, keys: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """An index of the first span of each different content, and for each span which of these it equals.

    Hashes (of the spans, unless given) sort the spans; bytes decide. `keys` may tell equal bytes apart.
    """
    keys = spans(data, start, end) if keys is None else keys
    size = end - start
    _, one, which = np.unique(keys, return_index=True, return_inverse=True)
    wrong = (size != size[one[which]]) if len(one) else np.zeros(0, bool)
    wrong |= ~same_spans(data, start, start[one[which]] if len(one) else start, np.where(wrong, 0, size))
    # Different bytes of one hash are told apart by themselves. It takes about 2 ** 32 spans for one such pair.
    seen: dict[tuple[int, bytes], int] = {}
    extra: list[int] = []
    for i in np.flatnonzero(wrong).tolist():
        named = (int(keys[i]), data[start[i] : end[i]].tobytes())
        if named not in seen:
            seen[named] = len(one) + len(extra)
            extra.append(i)
        which[i] = seen[named]
    return np.concatenate((one, np.array(extra, np.int64))).astype(np.int64), which


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the offsets of its rows; null is empty."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about `limit` bytes together, one row at least."""
    n, first = len(offsets) - 1, 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


class Words:
    """The `[^\\x20\\x09-\\x0D]+` words of consecutive texts: byte ranges and text of each."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets
        n = len(data)
        solid = np.zeros(n + 2, bool)
        np.logical_not(BLANK[data], out=solid[1 : n + 1])
        begins = solid[1 : n + 1] & ~solid[:n]
        ends = solid[1 : n + 1] & ~solid[2 : n + 2]
        edge = offsets[1:-1]
        edge = edge[(edge > 0) & (edge < n)]
        begins[edge] |= solid[edge + 1]
        ends[edge - 1] |= solid[edge]
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(ends) + 1
        #: Index of the first word of each text, and the number of all words at the end.
        self.first = np.searchsorted(self.start, offsets)
        self.count = np.diff(self.first)
        self.text = np.repeat(np.arange(len(offsets) - 1), self.count)

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self) -> np.ndarray:
        return spans(self.data, self.start, self.end)


def spread(first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... for `length` each, one run after the other."""
    total = int(length.sum())
    if not total:
        return np.zeros(0, np.int64)
    skip = np.concatenate(([0], np.cumsum(length)[:-1]))
    return np.arange(total) + np.repeat(first - skip, length)


def sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of values[first[i]:first[i+1]] for each i, empty ranges included."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return np.diff(total[first])


def repeated(keys: np.ndarray) -> np.ndarray:
    """Whether each key occurs twice or more."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    same = ranked[1:] == ranked[:-1]
    out = np.zeros(len(keys), bool)
    out[order[1:]] = same
    out[order[:-1]] |= same
    return out


def later_copies(keys: np.ndarray) -> np.ndarray:
    """Whether an equal key stands earlier."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    out = np.zeros(len(keys), bool)
    out[order[1:]] = ranked[1:] == ranked[:-1]
    return out


def by_text(
    rows: Callable[[np.ndarray, np.ndarray], dict[str, object]], schema: pa.Schema, text: str = "text"
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A mapInArrow function that keeps the other columns and adds those that `rows` makes of the texts.

    `rows` gets the bytes and offsets of a slice of texts and returns a value per text and column.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(text))
            for a, b in slices(offsets):
                made = rows(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(made[f.name], f.type) if f.name in made else part.column(f.name)
                        for f in schema
                    ],
                    schema=schema,
                )

    return run
