"""Repeated bytes and words against brute force, with small chunks so that documents really meet by exchange."""

import random
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from incident_analytics.llm import repeats, suffix_tree, suffixes

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def test_suffix_order_and_prefixes():
    rng = np.random.default_rng(1)
    for trial in range(80):
        n = int(rng.integers(1, 300))
        text = rng.integers(97, 97 + rng.integers(1, 4), n).astype(np.uint8)
        if trial % 3 == 0:
            text[rng.integers(0, n)] = 0
        at, depth = np.flatnonzero(rng.random(n) < rng.random()), int(rng.integers(1, 60))
        order = suffixes.suffix_order(text, at, depth)
        padded = text.tobytes() + b"\xff" + bytes(80)
        found = [padded[i : i + depth] for i in order]
        assert sorted(order) == sorted(at) and found == sorted(found)
        zeros = text.tobytes() + bytes(80)
        for i, length in enumerate(suffixes.common_prefix(text, order, depth)[1:], 1):
            a, b = zeros[order[i] :][:depth], zeros[order[i - 1] :][:depth]
            assert length == next((j for j in range(depth) if a[j] != b[j]), depth)


def test_deep_nodes():
    rng = np.random.default_rng(2)
    for limit in (5, 1 << 20):
        words = rng.integers(0, 3, 400)
        at = np.arange(400 - 6)
        found, node = suffix_tree.deep_nodes(words, at, 6, limit)
        groups = {}
        for i in at.tolist():
            groups.setdefault(tuple(words[i : i + 6]), []).append(i)
        got = {}
        for i, k in zip(found.tolist(), node.tolist(), strict=True):
            got.setdefault(k, []).append(i)
        assert sorted(map(sorted, got.values())) == sorted(g for g in groups.values() if len(g) > 1)


def documents(seed):
    """Copies, shared passages, periodic and short texts, nulls, ties of ids and repeated rows."""
    rng = random.Random(seed)
    pieces = [" ".join(rng.choice("abcdefgh") * rng.randint(1, 4) for _ in range(30)) for _ in range(6)]
    rows = [(i, "\n".join(rng.choice([*pieces, "ä" * 60, f"own {rng.random()}"]) for _ in range(rng.randint(0, 4)))) for i in range(60)]
    rows += [(100, "x" * 300), (101, "x" * 180 + "y"), (102, "ab" * 200), (103, "ab" * 90), (104, None), (105, "")]
    rows += [(106, "w " * 100), (107, "w\tw\n" * 30), (108, "one two"), (109, pieces[0]), (110, pieces[0]), (-5, pieces[1])]
    rng.shuffle(rows)
    return rows


@pytest.fixture
def small_chunks(monkeypatch):
    monkeypatch.setattr(repeats, "CHUNK_BYTES", 2000)


@pytest.mark.parametrize("seed", [1, 2])
def test_bytes_equal_brute_force(spark, small_chunks, seed):
    rows = documents(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 kept", "2 chunk", "3 bucket")
    got = {r.doc_id: r for r in suffixes.without_repeated_bytes(docs).collect()}
    assert len(got) == len(rows)
    first = {}
    for doc, text in sorted(rows):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - 49):
            if first.setdefault(raw[i : i + 50], doc) < doc:
                gone[i : i + 50] = b"\1" * 50
        r = got[doc]
        assert (r.n_bytes, r.n_removed) == (len(raw), sum(gone))
        assert bytes(r.kept) == bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        assert r.n_spans == sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))


@pytest.mark.parametrize("seed", [3, 4])
def test_words_equal_brute_force(spark, small_chunks, monkeypatch, seed):
    monkeypatch.setattr(suffix_tree, "GROUP", 50)
    rows = documents(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 kept", "2 chunk")
    got = {r.doc_id: r for r in suffix_tree.without_repeated_words(docs).collect()}
    seen = set()
    for doc, text in sorted(rows):
        words = WORD.findall((text or "").encode())
        gone = [False] * len(words)
        for i in range(len(words) - 19):
            window = tuple(words[i : i + 20])
            if window in seen:
                gone[i : i + 20] = [True] * 20
            seen.add(window)
        r = got[doc]
        assert (r.n_words, r.n_removed) == (len(words), sum(gone))
        assert bytes(r.kept) == b" ".join(w for w, g in zip(words, gone, strict=True) if not g)


def test_odd_tables(spark, small_chunks):
    passage = " ".join(f"p{i}" for i in range(40))
    rows = [(None, passage), (1, passage), (1, passage), (2, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for remove in (suffixes.without_repeated_bytes, suffix_tree.without_repeated_words):
        got = remove(docs).collect()
        assert sorted(((r.doc_id, r.n_removed > 0) for r in got), key=str) == [(1, True), (1, True), (2, False), (None, False)]
        assert remove(docs.limit(0)).count() == 0


def test_shared_phrase_is_dealt_out(monkeypatch):
    monkeypatch.setattr(repeats, "HEAVY", 100, raising=False)
    rng = random.Random(6)
    letters = lambda n: "".join(rng.choice("abcdefghijklmnop") for _ in range(n))
    texts = [letters(60) + "a phrase of forty bytes that all do share" + letters(60) for _ in range(800)]
    units, n_buckets, width = suffixes.byte_units(), 16, 8
    chunks = [pa.table({"doc_id": range(c, 800, 8), "text": texts[c::8], "chunk": [c] * 100}) for c in range(8)]

    def dealt(tables, column):
        rows = pa.concat_tables(tables)
        return {v: rows.filter(pc.equal(rows.column(column), v)) for v in set(rows.column(column).to_pylist())}

    sent = dealt([repeats._send_keys(units, n_buckets, width)(t) for t in chunks], "bucket")
    again = dealt([repeats._find_again(width)(t) for t in sent.values()], "chunk")
    segments = dealt([repeats._send_segments(units, n_buckets)(t, again[c]) for c, t in enumerate(chunks)], "bucket")
    windows = [sum(int(repeats._unpacked(x)[0].sum()) for x in t.column("more").to_pylist()) for t in segments.values()]
    assert sum(windows) > 5000 and max(windows) < sum(windows) / 4


@pytest.mark.parametrize("check", [test_bytes_equal_brute_force, test_words_equal_brute_force])
def test_heavy_keys_equal_brute_force(spark, small_chunks, monkeypatch, check):
    monkeypatch.setattr(repeats, "HEAVY", 2, raising=False)
    check(spark, None, *([monkeypatch] if check is test_words_equal_brute_force else []), 5)
