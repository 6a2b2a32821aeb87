"""Strings that hashes modulo a power of two take for equal, whatever their base."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from incident_analytics.llm import arrays, bpe, lm, minhash, quality, suffix_tree

ONE = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
TWO = "".join("ba"[bin(i).count("1") % 2] for i in range(1024))


def flat(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate(([0], np.cumsum([len(x) for x in raw]))).astype(np.int64)


def test_spans_are_told_apart():
    rng = np.random.default_rng(1)
    data = rng.integers(97, 99, 4000).astype(np.uint8)
    start = rng.integers(0, 3800, 3000)
    end = start + rng.integers(0, 200, 3000)
    one, which = arrays.numbered(data, start, end)
    text = data.tobytes()
    named = [text[a:b] for a, b in zip(start, end)]
    assert len(set(named)) == len(one)
    assert [named[one[w]] for w in which] == named
    hashes = arrays.spans(data, start, end)
    assert len({(n, h) for n, h in zip(named, hashes.tolist())}) == len(set(named)) == len(set(hashes.tolist()))


def test_equal_hashes_of_other_bytes():
    data = np.frombuffer(b"aabbab", np.uint8)
    start, end = np.array([0, 1, 2, 3, 4, 0]), np.array([1, 2, 3, 4, 5, 2])
    one, which = arrays.numbered(data, start, end, np.zeros(6, np.uint64))
    assert [data[start[i] : end[i]].tobytes() for i in one[which]] == [b"a", b"a", b"b", b"b", b"a", b"aa"]
    assert len(one) == 3


def test_bpe_keeps_the_text(spark):
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    text = f"{ONE} \n {TWO}"
    row = bpe.round_trip(spark.createDataFrame([(1, text)], "doc_id long, text string"), ranks).first()
    assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_quality_counts_no_copy():
    made = quality.measure(*flat([f"{ONE}\n{TWO}", f"{ONE}\n{ONE}"]))
    assert made["n_dup_lines"].tolist() == [0, 1]


def test_substring_dedup_keeps_both(spark):
    words = [f"w{i}" for i in range(30)]
    rows = [(1, " ".join([*words[:15], ONE, *words[15:]])), (2, " ".join([*words[:15], TWO, *words[15:]])), (3, " ".join([*words[:15], ONE, *words[15:]]))]
    got = {r.doc_id: r.n_removed for r in suffix_tree.without_repeated_words(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 0, 2: 0, 3: 31}


def test_language_model_counts_two_words(spark):
    rows = [(1, ONE), (2, ONE), (3, TWO)]
    got = {r.doc_id: r.base_score for r in lm.scores(spark.createDataFrame(rows, "doc_id long, text string"), F.lit(True)).collect()}
    assert got[1] == got[2] != got[3]


@pytest.mark.parametrize("k", [4, 5])
def test_minhash_makes_two_classes(spark, k):
    rows = [(1, ONE), (2, TWO), (3, ONE), (4, f"a b {ONE} c d"), (5, f"a b {TWO} c d")]
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), k).collect()}
    assert got == {1: 1, 2: 2, 3: 1, 4: 4, 5: 5}
