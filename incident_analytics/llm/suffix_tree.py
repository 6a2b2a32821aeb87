"""Removal of repeated word sequences, found in suffix trees that are split by prefixes."""

from __future__ import annotations

from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from incident_analytics.llm.arrays import Words, numbered, spread, sums
from incident_analytics.llm.repeats import Units, without_repeats

LENGTH, GRAM = 20, 8
#: Suffixes whose subtrees grow at one time.
GROUP = 1 << 20


def deep_nodes(words: np.ndarray, at: np.ndarray, depth: int, limit: int = GROUP) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes below nodes of the suffix tree of `depth` words or more, and the node of each.

    words: a number per word; at: where the suffixes start, each with `depth` words after it. Suffixes are
    grouped by their prefix, one word longer each round. A suffix alone in its group is a leaf, so nothing
    deep lies above it, and goes. Where more than `limit` suffixes are left, their groups are
    dealt to packs of about that size, by prefixes as long as it takes, and each pack grows alone.
    """
    found: list[tuple[np.ndarray, np.ndarray]] = []
    packs = [(at, np.zeros(len(at), np.int64), 0)]
    n_nodes = 0
    while packs:
        at, node, reached = packs.pop()
        while reached < depth and len(at):
            order = np.lexsort((words[at + reached], node))
            at, node = at[order], node[order]
            word = words[at + reached]
            fresh = np.ones(len(at), bool)
            fresh[1:] = (node[1:] != node[:-1]) | (word[1:] != word[:-1])
            node = np.cumsum(fresh) - 1
            reached += 1
            size = np.bincount(node)
            inner = size[node] > 1
            at, node = at[inner], node[inner]
            if len(at) > limit and reached < depth and len(np.unique(node)) > 1:
                pack = np.cumsum(np.append(0, np.bincount(node)))[node] // limit
                packs += [(at[pack == p], node[pack == p], reached) for p in np.unique(pack)]
                at = at[:0]
        if len(at):
            _, node = np.unique(node, return_inverse=True)
            found.append((at, node + n_nodes))
            n_nodes += int(node.max()) + 1
    if not found:
        return at[:0], at[:0]
    return np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])


def _first_of(length: int):
    def run(data: np.ndarray, size: np.ndarray, count: np.ndarray, doc: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First document and place of each window of segments; a segment's words are parted by one space."""
        words = Words(data, np.concatenate(([0], np.cumsum(size))))
        begin = words.first[:-1]
        at = spread(begin, count)
        owner, own_place = np.repeat(doc, count), np.repeat(place, count) + at - np.repeat(begin, count)
        # Words are numbered by their bytes, so nodes hold equal words, not equal hashes.
        _, word = numbered(data, words.start, words.end)
        found, node = deep_nodes(word, at, length)
        index = np.full(len(words), -1)
        index[at] = np.arange(len(at))
        i = index[found]
        order = np.lexsort((own_place[i], owner[i], node))
        i, node = i[order], node[order]
        lead = np.ones(len(i), bool)
        lead[1:] = node[1:] != node[:-1]
        least = i[np.flatnonzero(lead)][np.cumsum(lead) - 1] if len(i) else i
        first_doc, first_place = owner.copy(), own_place.copy()
        first_doc[i], first_place[i] = owner[least], own_place[least]
        return first_doc, first_place

    return run


def _read(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    words = Words(data, offsets)
    return words.hashes(), words.first, words.start, words.end


def word_units(length: int = LENGTH) -> Units:
    # A space at the end keeps the last word of a segment apart from the next segment's first.
    return Units(length, min(GRAM, length), True, _read, lambda raw, x, y: b" ".join(raw[x:y].split()) + b" ", _first_of(length))


def without_repeated_words(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, words left (joined by one space), n_words and n_removed of each row.

    A word goes if a window of `length` words that covers it also starts earlier, in a document with a smaller
    doc_id or before it in the same document. Null text has no words; a null doc_id counts as smaller than all
    others; rows of one doc_id count as one document, in which equal places don't take from one another.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("kept", pa.binary()), ("n_words", pa.int64()), ("n_removed", pa.int64())])

    def finish(data: np.ndarray, read: tuple, covered: np.ndarray, offsets: np.ndarray) -> dict[str, pa.Array]:
        _, first, start, end = read
        # A kept word takes a space along; the last one of a text loses it.
        size = np.where(covered, 0, end - start + 1)
        ended = np.concatenate((data, np.zeros(1, np.uint8)))
        at = spread(start, size)
        taken = ended[at]
        if len(at):
            taken[np.cumsum(size[~covered]) - 1] = 32
        cuts = np.concatenate(([0], np.cumsum(size)))[first]
        kept = taken.tobytes()
        return {
            "kept": pa.array([kept[a : max(b - 1, a)] for a, b in pairwise(cuts.tolist())], pa.binary()),
            "n_words": pa.array(np.diff(first)),
            "n_removed": pa.array(sums(covered, first)),
        }

    known = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("doc_id"), "text")
    out = without_repeats(known, word_units(length), finish, schema, "doc_id long, kept binary, n_words long, n_removed long")
    return out.withColumn("doc_id", F.when(F.col("doc_id") > -(1 << 63), F.col("doc_id")))
