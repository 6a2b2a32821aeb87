"""Removal of repeated byte strings, found in suffix arrays built by two-stage sorting."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from incident_analytics.llm.arrays import _OF_BYTE, spread, sums
from incident_analytics.llm.repeats import Units, without_repeats

LENGTH, GRAM = 50, 24


def _words_at(text: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The eight bytes at each position as one number; `text` has eight bytes more than positions."""
    return np.lib.stride_tricks.sliding_window_view(text, 8)[at].view(">u8").ravel().astype(np.uint64)


def _sorted_directly(text: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """Positions in the order of the `depth` bytes that follow, eight at a time; only ties are looked at again."""
    order = np.argsort(_words_at(text, at), kind="stable")
    at = at[order]
    group = np.zeros(len(at), np.int64)
    word = _words_at(text, at)
    group[1:] = np.cumsum(word[1:] != word[:-1])
    left = np.arange(len(at))
    for step in range(8, depth, 8):
        size = np.bincount(group[left], minlength=group[-1] + 1 if len(group) else 1)
        left = left[size[group[left]] > 1]
        if not len(left):
            break
        word = _words_at(text, at[left] + step)
        order = np.lexsort((word, group[left]))
        at[left] = at[left][order]
        word, owner = word[order], group[left]
        fresh = np.ones(len(left), bool)
        fresh[1:] = (word[1:] != word[:-1]) | (owner[1:] != owner[:-1])
        group[left] = left[np.maximum.accumulate(np.where(fresh, np.arange(len(left)), 0))]
    return at


def suffix_order(text: np.ndarray, wanted: np.ndarray, depth: int) -> np.ndarray:
    """The suffixes at `wanted` positions, in order of their first `depth` bytes at least.

    Only suffixes smaller than their successor are sorted. Each other one is larger than its successor and
    is put in place by it: bucket after bucket of first bytes, what stands before the suffixes of a bucket
    is appended to its own bucket, in the same order, ahead of the sorted ones there.
    """
    if not len(wanted):
        return wanted
    # A last byte that UTF-8 never has: larger than all, it gives each suffix before it a definite order.
    text = np.append(text, np.uint8(255))
    n = len(text)
    padded = np.concatenate((text, np.zeros(depth + 16, np.uint8)))
    # Whether the next different byte is larger; nothing follows the last one.
    rises = np.ones(n, bool)
    differs = np.flatnonzero(text[1:] != text[:-1])
    if len(differs):
        ahead = np.searchsorted(differs, np.arange(n))
        known = ahead < len(differs)
        j = differs[ahead[known]]
        rises[known] = text[j + 1] > text[j]
    inside = np.zeros(n, bool)
    inside[wanted] = True
    # A falling suffix needs its successor, so each falling run is taken up to the rising suffix that ends it.
    rising = np.flatnonzero(rises)
    ends = np.flatnonzero(inside & ~rises & ~np.append(inside[1:], False))
    stop = rising[np.searchsorted(rising, ends)]
    inside[spread(ends + 1, stop - ends)] = True
    direct = _sorted_directly(padded, np.flatnonzero(inside & rises), depth + 6)
    falling = inside & ~rises
    edges = np.searchsorted(text[direct], np.arange(257))
    ahead_of: list[list[np.ndarray]] = [[] for _ in range(256)]
    out = []
    for c in range(256):
        part = np.concatenate(ahead_of[c]) if ahead_of[c] else direct[:0]
        taken = [part]
        while len(part):
            part = part[part > 0] - 1
            part = part[falling[part] & (text[part] == c)]
            taken.append(part)
        bucket = np.concatenate([*taken, direct[edges[c] : edges[c + 1]]])
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[falling[before]]
        byte = text[before]
        before, byte = before[byte > c], byte[byte > c]
        before = before[np.argsort(byte, kind="stable")]
        size = np.bincount(byte, minlength=256)
        ends = np.cumsum(size)
        for k in np.flatnonzero(size).tolist():
            ahead_of[k].append(before[ends[k] - size[k] : ends[k]])
    order = np.concatenate(out)
    keep = np.zeros(n, bool)
    keep[wanted] = True
    return order[keep[order]]


def common_prefix(text: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """Length, up to `most`, of the common prefix of each suffix and the one before it in order."""
    padded = np.concatenate((text, np.zeros(most + 16, np.uint8)))
    eight = np.lib.stride_tricks.sliding_window_view(padded, 8)
    out = np.zeros(len(order), np.int64)
    left = np.arange(1, len(order))
    for step in range(0, most, 8):
        a, b = _words_at(padded, order[left] + step), _words_at(padded, order[left - 1] + step)
        odd = np.flatnonzero(a != b)
        equal = np.full(len(left), 8)
        x, y = order[left[odd]] + step, order[left[odd] - 1] + step
        equal[odd] = (eight[x] != eight[y]).argmax(1)
        out[left] = step + equal
        left = left[equal == 8]
        if not len(left):
            break
    return np.minimum(out, most)


def _first_of(length: int):
    def run(data: np.ndarray, size: np.ndarray, count: np.ndarray, doc: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Smallest document of each window of segments that stand one after the other."""
        begin = np.concatenate(([0], np.cumsum(size)[:-1]))
        at = spread(begin, count)
        order = suffix_order(data, at, length)
        fresh = common_prefix(data, order, length) < length
        fresh[:1] = True
        owner = np.zeros(len(data), np.int64)
        owner[at] = np.repeat(doc, count)
        groups = np.flatnonzero(fresh)
        least = np.minimum.reduceat(owner[order], groups) if len(groups) else owner[:0]
        first = np.zeros(len(data), np.int64)
        first[order] = np.repeat(least, np.diff(np.append(groups, len(order))))
        return first[at], np.zeros(len(at), np.int64)

    return run


def _bytes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    at = np.arange(len(data))
    return _OF_BYTE[data], offsets, at, at + 1


def byte_units(length: int = LENGTH) -> Units:
    return Units(length, min(GRAM, length), False, _bytes, lambda raw, x, y: raw[x:y], _first_of(length))


def without_repeated_bytes(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, text left (bytes), n_bytes, n_removed and n_spans of each row.

    A byte goes if a string of `length` bytes that covers it also starts in a document with a smaller
    doc_id. Null text is empty; a null doc_id counts as smaller than all others; rows of one doc_id don't
    take from one another. Texts shorter than `length` stay.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("kept", pa.binary()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64())])

    def finish(data: np.ndarray, read: tuple, covered: np.ndarray, offsets: np.ndarray) -> dict[str, pa.Array]:
        begins = covered.copy()
        begins[1:] &= ~covered[:-1]
        inner = offsets[:-1][(offsets[:-1] < len(data)) & (np.diff(offsets) > 0)]
        begins[inner] = covered[inner]
        left = np.concatenate(([0], np.cumsum(~covered)))[offsets]
        kept = data[~covered].tobytes()
        return {
            "kept": pa.array([kept[a:b] for a, b in zip(left[:-1].tolist(), left[1:].tolist(), strict=True)], pa.binary()),
            "n_bytes": pa.array(np.diff(offsets)),
            "n_removed": pa.array(sums(covered, offsets)),
            "n_spans": pa.array(sums(begins, offsets)),
        }

    known = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("doc_id"), "text")
    out = without_repeats(known, byte_units(length), finish, schema, "doc_id long, kept binary, n_bytes long, n_removed long, n_spans long")
    return out.withColumn("doc_id", F.when(F.col("doc_id") > -(1 << 63), F.col("doc_id")))
