"""The Merkle manifest against plain Python."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from incident_analytics.llm import merkle, queries

COLUMNS = "doc_id long, source string, lang string, n_chars long, text string"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, source, lang, n_chars, text):
    parts = []
    for v in (doc_id, source, lang, n_chars, text):
        parts += ["-"] if v is None else [str(len(str(v).encode())), ":", str(v)]
    return H(*parts)


def climb(leaves):
    """The root and, of each leaf, its siblings as (side, digest) per level."""
    level, at, paths = list(leaves), list(range(len(leaves))), [[] for _ in leaves]
    while len(level) > 1:
        for i, p in enumerate(at):
            if (p ^ 1) < len(level):
                paths[i].append((p & 1, level[p ^ 1]))
            else:
                paths[i].append(None)
        level = [H(*level[i : i + 2]) for i in range(0, len(level), 2)]
        at = [p >> 1 for p in at]
    return level[0], paths


def brute(rows):
    """Rows of the query, in any order."""
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf(*r), r))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    subs = {}
    for g in order:
        groups[g].sort(key=lambda x: x[:3])
        subs[g] = climb([x[2] for x in groups[g]])
    root, tops = climb([subs[g][0] for g in order]) if order else (None, [])
    out = []
    for g, top in zip(order, tops):
        for x, below in zip(groups[g], subs[g][1]):
            r, steps = x[3], below + top
            proof = H(*(s[1] for s in steps if s))
            claim = x[2]
            if r[0] is not None and r[3] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0:
                claim = leaf(*r[:3], r[3] + 1, r[4])
            for s in steps:
                claim = H(claim) if s is None else H(s[1], claim) if s[0] else H(claim, s[1])
            out.append((r[0], x[2], subs[g][0], root, proof, claim, claim == root))
    return out


def rows_of(n, seed, langs=("en", "de", None, "é", "z")):
    rng = random.Random(seed)
    words = ["", "é", "a\nb", "x" * 50, "𝒳"]
    return [
        (i * 3, rng.choice(["web", None, "π"]), rng.choice(langs), rng.choice([None, 0, 7, 2**63 - 1]), rng.choice([*words, None]))
        for i in range(n)
    ]


def got(spark, rows, height=merkle.HEIGHT):
    docs = spark.createDataFrame(rows, COLUMNS).repartition(7)
    return sorted(map(tuple, queries.merkle_rows(docs, height).collect()), key=str)


@pytest.mark.parametrize("levels", range(10))
def test_places_are_a_permutation(levels):
    places = np.concatenate([merkle.address(levels, d, np.arange(1 << d)) for d in range(levels + 1)])
    assert sorted(places.tolist()) == list(range((2 << levels) - 1))
    # A subtree that hangs at half the height is one run of places.
    if levels >= 1:
        half = (levels + 1) // 2
        for i in range(1 << half):
            below = [merkle.address(levels, half + d, np.arange(i << d, (i + 1) << d)) for d in range(levels - half + 1)]
            flat = np.sort(np.concatenate(below))
            assert flat[-1] - flat[0] == len(flat) - 1


@pytest.mark.parametrize("count", [1, 2, 3, 5, 8, 13, 16])
def test_block_paths_fold_to_its_root(count):
    leaves = [hashlib.sha256(bytes([i])).digest() for i in range(count)]
    levels = (count - 1).bit_length()
    nodes = bytes(merkle.build(leaves, levels))
    root, paths = climb([x.hex() for x in leaves])
    assert nodes[:32].hex() == root
    for i, x in enumerate(leaves):
        entries = merkle.path(nodes, levels, count, i)
        assert merkle.siblings(entries) == "".join(s[1] for s in paths[i] if s)
        assert merkle.fold(x, entries).hex() == root
        assert merkle.fold(bytes(32), entries).hex() != root


@pytest.mark.parametrize("height", [1, 2, 8])
def test_query_equals_brute_force(spark, height):
    rows = rows_of(157, height)
    assert got(spark, rows, height) == sorted(brute(rows), key=str)


def test_repeated_null_and_single_rows(spark):
    rows = rows_of(20, 5) + [(3, "a", "en", 1, "t")] * 300 + [(3, "a", "en", 2, "t"), (None, None, None, None, None), (None, None, None, 1, "")]
    assert got(spark, rows) == sorted(brute(rows), key=str)
    one = [(9, None, "en", 4, "long " * 300_000)]
    assert got(spark, one) == sorted(brute(one), key=str)
    assert got(spark, []) == []


def test_clashing_columns(spark):
    rows = rows_of(9, 2)
    docs = spark.createDataFrame(rows, COLUMNS)
    for name in ("tree", "digest", "claim", "position", "members", "part", "place", "tie", "key", "block"):
        docs = docs.selectExpr("*", f"'{name}' as `{name}`")
    assert sorted(map(tuple, queries.merkle_rows(docs).collect()), key=str) == sorted(brute(rows), key=str)
