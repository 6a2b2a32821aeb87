"""Operators that read each text alone, against brute force."""

import gc
import hashlib
import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import base64

from incident_analytics.llm import bpe, mixing, quality

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def flat(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate(([0], np.cumsum([len(x) for x in raw]))).astype(np.int64)


def random_texts(n, alphabet, seed, longest=80):
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, longest))) for _ in range(n)]


def base_counts(text):
    words = [w.decode() for w in WORD.findall(text.encode())]
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line.encode()):
            dup += line in seen
            seen.add(line)
    times = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + j for i in range(len(words) - 2) if times[tuple(words[i : i + 3])] > 1 for j in range(3)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


def test_quality_counts():
    texts = random_texts(400, ["a", "b", "é ", " ", "\n", "\t", "a\n", "#", "𝒳", "\r\n", " ", "\x0b"], 3)
    texts = ["", " ", "\n", "a\na\na", "a\n\na", " a\n a\na", *texts, "x " * 5000]
    made = quality.measure(*flat(texts))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    for i, text in enumerate(texts):
        want = base_counts(text)
        assert tuple(int(made[c][i]) for c in names) == want, repr(text)
        assert made["base_failed"][i] == (want[0] < 50 or 100 * want[4] > 50 * want[0])


def test_quality_verdict():
    rng = random.Random(5)
    clean = " ".join(f"w{rng.random()}" for _ in range(300))
    line = " ".join(f"v{rng.random()}" for _ in range(30))
    rows = quality.measure(*flat([clean, clean + ("\n" + line) * 6, clean + " # % &" * 300, ""]))
    assert rows["kept"].tolist() == [True, False, False, False]


def test_bpe_equals_library():
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks = bpe.read_ranks(path)
    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
    alphabet = [*"aabstmdrevl' '  \n\t 　é1٣²!?.,#日本🙂́\x00", "'s", "'re", "'ll", " '", "''"]
    texts = ["", " ", " a", "'s", "x's're", " 's", "!'s", "\n\n a", "'re", *random_texts(3000, alphabet, 1, 60)]
    texts += ["a" * 5000, "!" * 3000, "ab" * 2000, " " * 3000, "1" * 999, "<|endoftext|>"]
    data, offsets = flat(texts)
    ids, first = bpe.codec(ranks).encode(data, offsets)
    for i, text in enumerate(texts):
        assert ids[first[i] : first[i + 1]].tolist() == library.encode_ordinary(text), repr(text)
    back, at = bpe.codec(ranks).decode(ids, first)
    assert back.tobytes() == data.tobytes() and at.tolist() == offsets.tolist()


def test_bpe_kept_pieces_are_small_and_right(monkeypatch):
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    own, rng = bpe.Codec(ranks), random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyz"
    texts = [" ".join("".join(rng.choices(letters, k=7)) for _ in range(500)) for _ in range(200)]
    tracemalloc.start()
    for text in texts:
        own.encode(*flat([text]))
    gc.collect()
    used, n = tracemalloc.get_traced_memory()[0], len(own.cache)
    tracemalloc.stop()
    assert n > 90_000 and used / n < 200
    # The same ids whether pieces are new, kept, or kept again after the cache was emptied.
    monkeypatch.setattr(bpe.Codec, "CACHE", 700)
    small = bpe.Codec(ranks)
    for text in [*texts[:3], *texts[:3], "", "z" * 400 + " " + texts[0], "z" * 400]:
        assert small.encode(*flat([text]))[0].tolist() == own.encode(*flat([text]))[0].tolist()


def test_bpe_frames(spark):
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    docs = spark.createDataFrame([(1, "It's 3 o'clock\n", 7), (2, None, 7), (None, "", 7), (1, "é", 7)], "doc_id int, text string, ids int")
    rows = bpe.encode(docs, ranks)
    assert rows.columns == ["doc_id", "ids", "ends"]
    assert Counter((r.doc_id, bytes(r.text).decode()) for r in bpe.decode(rows, ranks).collect()) == Counter(
        [(1, "It's 3 o'clock\n"), (2, ""), (None, ""), (1, "é")]
    )
    assert all(r.ends == sorted(r.ends) for r in rows.collect())
    trip = {(r.doc_id, r.n_tokens): r for r in bpe.round_trip(docs, ranks).collect()}
    assert trip[2, 0].ids_sha256 == hashlib.sha256(b"").hexdigest()
    assert trip[1, 1].decoded_sha256 == hashlib.sha256("é".encode()).hexdigest()
    assert bpe.round_trip(docs.limit(0), ranks).count() == 0


def water_filled(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, stopped = share * sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in stopped]
        rest = total - sum(stopped.values())
        target = {s: rest * weight[s] / sum(weight[t] for t in free) for s in free}
        over = [s for s in free if target[s] > most * sizes[s]]
        if not over:
            return stopped | target
        stopped |= {s: most * sizes[s] for s in over}


def test_mix(spark):
    rng = random.Random(2)
    rows = [(i, "w " * rng.randint(0, 30), rng.choice(["b", "a", "é", "Z", None, "b", "b", "b"])) for i in range(3000)]
    rows += [(5000, None, "none"), (5000, None, "none"), (None, "a b", "a")]
    docs = spark.createDataFrame(rows, "doc_id int, text string, source string").selectExpr("*", "1 size", "2 target")
    got = mixing.with_copies(docs, ["doc_id", "source"]).collect()
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len((text or "").split())
    want, taken = water_filled(dict(sizes)), Counter()
    for r in got:
        assert r.target == pytest.approx(want[r.source]) and r.source_size == sizes[r.source]
        assert r.copies <= 2
        taken[r.source] += r["size"] * r.copies
    assert len(got) == len(rows)
    for source in want:
        assert taken[source] == pytest.approx(want[source], rel=0.1)
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    assert sum(len((r.text or "").split()) for r in out.collect()) == sum(taken.values())
    assert mixing.with_copies(docs.limit(0), ["doc_id"]).count() == 0


def test_bpe_long_and_repeated_rows(spark):
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    long = "word " * 60_000
    docs = spark.createDataFrame([(1, long), (1, long), (2, "x")], "doc_id long, text string")
    rows = bpe.round_trip(docs, ranks).collect()
    assert len(rows) == 3
    assert {r.decoded_sha256 for r in rows if r.doc_id == 1} == {hashlib.sha256(long.encode()).hexdigest()}


def kept_by_hand(text):
    """The verdict from its definition: shares of word characters in symbols, copied lines and repeated n-grams."""
    words = [w.decode() for w in WORD.findall(text.encode())]
    n_words, word_chars, n_symbols, _, n_repeat = base_counts(text)
    if n_words < 50 or 100 * n_repeat > 50 * n_words or 100 * n_symbols > 20 * word_chars:
        return False
    share = 100.0 / max(word_chars, 1)
    seen, copied = set(), 0
    for line in text.split("\n"):
        found = WORD.findall(line.encode())
        if found:
            copied += sum(len(w.decode()) for w in found) if line in seen else 0
            seen.add(line)
    if copied * share > 30:
        return False
    for n, most in ((2, 20), (3, 18), (4, 16)):
        times = Counter(tuple(words[i : i + n]) for i in range(n_words - n + 1))
        if max((t * sum(map(len, g)) for g, t in times.items() if t > 1), default=0) * share > most:
            return False
    for n, most in ((5, 25), (6, 24), (7, 23), (8, 22), (9, 21), (10, 20)):
        times = Counter(tuple(words[i : i + n]) for i in range(n_words - n + 1))
        inside = {i + j for i in range(n_words - n + 1) if times[tuple(words[i : i + n])] > 1 for j in range(n)}
        if sum(len(words[i]) for i in inside) * share > most:
            return False
    return True


def repetitive(rng):
    """A text near one of the limits."""
    fresh = [f"w{rng.randrange(10**6)}" for _ in range(rng.randint(40, 200))]
    phrase = [f"p{rng.randrange(100)}" for _ in range(rng.choice([1, 2, 3, 4, 6, 9, 12]))]
    for _ in range(rng.randint(0, 12)):
        at = rng.randrange(len(fresh) + 1)
        fresh[at:at] = phrase
    if rng.random() < 0.3:
        fresh[::7] = [rng.choice(["#", "%%", "|", "a&b"]) for _ in fresh[::7]]
    text = " ".join(fresh)
    return text + ("\n" + " ".join(fresh[: rng.randint(1, 60)])) * rng.choice([0, 0, 1, 2, 5])


def test_quality_rows(spark):
    rng = random.Random(12)
    texts = [repetitive(rng) for _ in range(250)]
    rows = [*enumerate(texts), (900, None), (901, ""), (None, texts[0]), (3, texts[3]), (3, texts[3]), (902, "é𝒳 " * 30_000), (903, " ".join(f"v{i}" for i in range(60_000)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    clashing = docs.selectExpr("*", *(f"'x' as `{c}`" for c in ("n_words", "kept", "base_failed", "line", "a.b")))
    got = sorted((tuple(r) for r in quality.quality(clashing).collect()), key=repr)
    want = []
    for doc, text in rows:
        counts = base_counts(text or "")
        failed = counts[0] < 50 or 100 * counts[4] > 50 * counts[0]
        want.append((doc, *counts, failed, kept_by_hand(text or "")))
    assert got == sorted(want, key=repr)
    verdicts = Counter(r[-1] for r in got)
    assert verdicts[True] > 20 and verdicts[False] > 20
    assert quality.quality(docs.limit(0)).count() == 0
