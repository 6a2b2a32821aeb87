"""Near duplicates, fingerprints, language model, personal data, toxicity and the pipeline, against plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
import regex
from pyspark.sql import functions as F

import corpus_pipeline
from incident_analytics.llm import lm, minhash, pii, queries, shared, spotsigs, toxicity

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.001"


def words_of(text):
    return WORD.findall((text or "").encode().lower())


def components_by_hand(texts, k=4):
    sets = {}
    for doc, text in texts.items():
        w = words_of(text)
        sets[doc] = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set())
    common, root = Counter(), {d: d for d in sets}
    index = defaultdict(list)
    for doc in sorted(sets):
        for s in sets[doc]:
            for other in index[s]:
                common[other, doc] += 1
            index[s].append(doc)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (a, b), n in common.items():
        if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {d: (len(s), find(d)) for d, s in sets.items()}


def near_copies(seed, n=120):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    bases = [[rng.choice(vocabulary) for _ in range(rng.randint(3, 120))] for _ in range(8)]
    rows = []
    for i in range(n):
        base = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 2, 5])):
            base[rng.randrange(len(base))] = rng.choice(vocabulary)
        rows.append((i, rng.choice([" ", "\n", "\t "]).join(base).upper() if i % 3 else " ".join(base)))
    return [*rows, (n, ""), (n + 1, None), (n + 2, " \n"), (n + 3, "one"), (n + 4, "ONE")]


@pytest.mark.parametrize("seed", [2, 64])
def test_near_duplicates(spark, seed):
    rows = near_copies(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "0 node", "0 band", "'x' label")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(docs).collect()}
    assert got == components_by_hand(dict(rows))


def test_many_edited_copies(spark):
    """A large group of copies, many of them too far from each other: whole links, few comparisons."""
    rng = random.Random(8)
    base = [f"b{rng.randrange(3000)}" for _ in range(120)]
    rows = []
    for i in range(2000):
        words = list(base)
        for _ in range(rng.randint(0, 14)):
            words[rng.randrange(len(words))] = f"e{rng.randrange(10**9)}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    made = []
    whole = minhash.prefix_pairs
    minhash.prefix_pairs = lambda *a: made.append(whole(*a)) or made[-1]
    try:
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(docs).collect()}
    finally:
        minhash.prefix_pairs = whole
    sets = [{" ".join(t.split()[i : i + 4]) for i in range(117)} for _, t in rows]
    root = list(range(2000))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(2000):
        for b in range(a):
            n = len(sets[a] & sets[b])
            if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    assert got == {i: (len(sets[i]), find(i)) for i in range(2000)}
    assert len(set(map(find, range(2000)))) > 100
    assert made[0].count() < 10 * 2000


def test_prefix_pairs_lose_no_pair(spark):
    rng = random.Random(9)
    sets = []
    for i in range(300):
        old = rng.choice(sets)[2] if sets and rng.random() < 0.7 else []
        kept = [x for x in old if rng.random() < 0.93]
        fresh = [rng.randrange(rng.choice([30, 10**6])) for _ in range(rng.randint(1, 6))]
        sets.append((i, i // 3, sorted({*kept, *fresh})))
    got = {(r.a, r.b) for r in minhash.prefix_pairs(spark.createDataFrame(sets, "id long, label long, shingles array<long>")).collect()}
    alike = set()
    for i, x, a in sets:
        for j, y, b in sets[:i]:
            n = len(set(a) & set(b))
            if x != y and 100 * n >= 80 * (len(a) + len(b) - n):
                alike.add((j, i))
    assert alike <= got and len(alike) > 20


def test_texts_of_null_ids_are_read_once(spark, monkeypatch):
    words = " ".join(f"w{i}" for i in range(60))
    rows = [(None, f"{words} {i}") for i in range(600)]
    read = []
    plain = minhash._sets
    monkeypatch.setattr(minhash, "_sets", lambda texts, k: read.append(texts.count()) or plain(texts, k))
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert [tuple(r) for r in got.distinct().collect()] == [(None, 58, None)]
    assert read == [600]


def test_near_duplicates_odd_tables(spark):
    rows = [(None, "a b c d e"), (3, "a b c d e"), (3, "a b c d e"), (1, None), (1, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, minhash.near_duplicates(docs).collect()), key=str)
    assert got == [(1, 0, 1), (1, 0, 1), (3, 2, 3), (3, 2, 3), (None, 2, 3)]
    assert minhash.near_duplicates(docs.limit(0)).count() == 0


@pytest.mark.parametrize("most", [1000, 3])
def test_fingerprints(spark, monkeypatch, most):
    monkeypatch.setattr(spotsigs, "RANGE_ROWS", 7)
    monkeypatch.setattr(spotsigs, "MOST_RANGES", most)
    rng = random.Random(3)
    rows = [(i * 3 - 20, " ".join(rng.choice(["the", "of", "ä", "w1", "w2!", "W3", "und", "x"]) for _ in range(rng.randint(0, 60)))) for i in range(80)]
    rows += [(900, None), (901, "𝒳y" * 9), (902, "the " * 20_000), (903, "the " * 20_000), (904, "solo")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 _own", "1 guest")
    got = {r.doc_id: r for r in spotsigs.fingerprints(docs).collect()}
    order = sorted(((d, t or "") for d, t in rows), reverse=True)
    assert len(got) == len(rows)
    for i, (doc, text) in enumerate(order):
        after = order[(i + 1) % len(order)]
        cut = len(text) // 3
        edited = text[: len(text) - cut] + after[1][:cut]
        r = got[doc]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        for a, b, likeness in ((r.fingerprint, r.edited_fingerprint, r.near_edited), (r.fingerprint, got[after[0]].fingerprint, r.near_next)):
            x, y = (set(filter(None, s.split(","))) for s in (a, b))
            assert likeness == pytest.approx(len(x & y) / len(x | y) if x | y else 1.0)
    assert got[902].fingerprint == got[903].fingerprint and got[904].fingerprint
    odd = spark.createDataFrame([(None, "a"), (None, "b"), (5, "c"), (5, "c")], "doc_id long, text string")
    assert spotsigs.fingerprints(odd).count() == 4
    assert spotsigs.fingerprints(odd.filter("doc_id is null")).count() == 2
    assert spotsigs.fingerprints(odd.limit(0)).count() == 0


def chains_by_hand(text):
    """The two content words behind each run of common words; of a text without such a place, each two words."""
    words = regex.findall(r"[\p{L}\p{N}]+", (text or "").lower())
    common = set(spotsigs.ANCHORS)
    out = set()
    for i in range(1, len(words)):
        if words[i] not in common and words[i - 1] in common:
            out.add(" ".join([w for w in words[i:] if w not in common][:2]))
    return out or {" ".join(words[i : i + 2]) for i in range(len(words))}


def test_signatures_by_hand(spark):
    rng = random.Random(13)
    parts = ["the", "The", "of", "und", "más", "ä", "W1", "w2!", "x-y", "…", "\n", "42", "𝒳", "los"]
    texts = [rng.choice([" ", "  ", ", "]).join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(300)]
    texts += ["", None, "the", "the of", "word", "no mark here", "a" * 100_000, "the x " * 5000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: set(r.s) for r in spotsigs.with_signatures(docs.withColumn("text", F.coalesce("text", F.lit(""))), "text", "s").collect()}
    chains = sorted({c for t in texts for c in chains_by_hand(t)})
    hashed = {r.c: r.h for r in spark.createDataFrame([(c,) for c in chains], "c string").select("c", F.xxhash64("c").alias("h")).collect()}
    for i, text in enumerate(texts):
        assert got[i] == {hashed[c] for c in chains_by_hand(text)}, text


def test_near_fingerprints(spark):
    rng = random.Random(9)
    bases = [[rng.choice(["the", "of", *(f"w{i}" for i in range(60))]) for _ in range(rng.randint(2, 90))] for _ in range(6)]
    rows = []
    for i in range(90):
        words = list(rng.choice(bases))
        for _ in range(rng.choice([0, 1, 2, 6])):
            words[rng.randrange(len(words))] = f"w{rng.randint(0, 59)}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame([*rows, (200, None), (201, ""), (None, "the w1 w2")], "doc_id long, text string")
    sets = {r.doc_id: frozenset(r._own) for r in spotsigs.with_signatures(docs.filter("doc_id < 100"), "text", "_own").collect()}
    least = {}
    for doc in sorted(sets):
        least.setdefault(sets[doc], doc)
    classes = [(d, s) for s, d in least.items() if s]
    want = {(a, b): len(x & y) / len(x | y) for a, x in classes for b, y in classes if a < b and len(x & y) >= 0.8 * len(x | y)}
    got = {(r.a, r.b): r.likeness for r in spotsigs.near_matches(docs).collect()}
    assert want and got == pytest.approx(want)
    assert spotsigs.near_matches(docs.limit(0)).count() == 0


def test_log_frequency_filter():
    keys = np.arange(1, 20_001, dtype=np.uint64) * np.uint64(7919)
    levels = np.random.default_rng(1).integers(1, 12, len(keys))
    n_blocks = -(-int(levels.sum()) * lm.BITS_PER_ITEM // lm.BLOCK_BITS)
    at = lm.LogFrequencyFilter.block_of(keys, n_blocks)
    rows = [np.frombuffer(lm.LogFrequencyFilter.build_block(keys[at == b], levels[at == b]), np.uint8) for b in range(n_blocks)]
    grams = lm.LogFrequencyFilter(np.array(rows))
    read = grams.levels(keys)
    assert (read >= levels).all() and (read > levels).mean() < 0.03
    assert (grams.levels(keys + np.uint64(1)) > 0).mean() < 0.03


def test_language_model(spark, monkeypatch):
    monkeypatch.setattr(lm, "VOCABULARY", 12)
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(["a b", "A", "c", "d e f", f"r{rng.randint(0, 40)}"]) for _ in range(rng.randint(0, 50)))) for i in range(200)]
    rows += [(500, None), (501, "never seen"), (502, "a b " * 3000), (502, "a b " * 3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 key", "2 n", "3 gain")
    training = docs.filter("doc_id % 10 <> 1")
    tokens = [(d, [*words_of(t), None]) for d, t in rows]
    c = Counter(w for d, ws in tokens if d % 10 != 1 for w in ws)
    total, distinct = sum(c.values()), len(c)
    got = sorted(lm.scores(docs, training).collect(), key=lambda r: r.doc_id)
    better = 0
    for r, (_, ws) in zip(got, sorted(tokens, key=lambda x: x[0]), strict=True):
        base = sum(math.log10((c[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in ws)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(ws), sum(c[w] > 0 for w in ws), total)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert r.score < 0
        better += r.score - r.base_score
    assert better > 0
    assert lm.scores(docs.limit(0), training).count() == 0
    assert {r.score for r in lm.scores(docs, training.limit(0)).collect()} == {0.0}


def test_all_bigrams_count(spark):
    # More words than 16 bits hold, and pairs that stand once; every one of them changes what follows.
    words = [f"w{i}" for i in range(70_000)]
    docs = spark.createDataFrame([(0, " ".join(words)), (1, "w69998 w69999"), (2, "w69999 w5")], "doc_id long, text string")
    for got in (lm.scores(docs, F.col("doc_id") == 0), lm.scores(docs, docs.filter("doc_id = 0"))):
        gain = {r.doc_id: r.score - r.base_score for r in got.collect()}
        norm = 70_001 + 0.1 * 70_002
        seen, unseen = (math.log10((x + 0.75 * 1.1 / norm) / (1.1 / norm)) for x in (0.25, 0.0))
        assert gain[1] == pytest.approx(2 * seen)
        assert gain[2] == pytest.approx(2 * unseen)


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, found):
    if kind == "ip":
        return all(int(x) <= 255 for x in found.split("."))
    digits = re.sub("[^0-9]", "", found)
    if kind == "card":
        twice = [int(c) for c in digits[::-1]]
        return 14 <= len(digits) <= 19 and sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(twice)) % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def base_by_hand(text):
    spans = [(m.start(), i, m.end()) for i, (k, p) in enumerate(BASE.items()) for m in re.finditer(p, text) if valid(k, m.group())]
    return ",".join(f"{[*BASE][i]}:{a}:{b}" for a, i, b in sorted(spans))


def test_personal_data(spark):
    rng = random.Random(5)
    parts = ["a", "b1@", "@", ".", "-", " ", "+", "12", "4111 1111 1111 1111", "+1 (555) 123-4567", "1.2.3.4", "256.1.1.1", "x@y.z", "_", "é", "𝒳", "0" * 20, "\n", "0007.1.1.1"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(300)]
    texts += ["", "1" * 3000, "a@b." * 300, "1.1.1.1 " * 300, "a" * 10_000, "+" + "1-" * 2000, f'token = "{"0a1b2c3d" * 5}" end'] * 2
    rows = [*enumerate(texts), (9000, None), (None, "x@y.zz")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 base", "2 spans", "3 _row")
    model = pii.train(docs)
    got = pii.personal_data(docs, model).collect()
    known = dict(rows)
    assert len(got) == len(rows)
    for r in got:
        want = base_by_hand(known[r.doc_id] or "")
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest(), known[r.doc_id]
        assert set(filter(None, want.split(","))) <= set(r.spans.split(","))
    clean = pii.redacted(docs, model)
    assert clean.columns == docs.columns
    for r in clean.collect():
        if r.doc_id == 9000:
            assert r.text is None
        elif known[r.doc_id] in ("", "a" * 10_000):
            assert r.text == known[r.doc_id]
        else:
            assert base_by_hand(known[r.doc_id]) == "" or "[" in r.text
    assert pii.personal_data(docs.limit(0)).count() == 0


def test_candidates_that_touch_base_spans_go(spark):
    rng = random.Random(6)
    parts = ["x@y.zz", "+1 555 123 4567", "4111 1111 1111 1111", "0a1b2c3d4e5f", "(555) 123-4567", "1.2.3.4", "a9", " ", ", ", "-", "k1=", "\n"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(150)]
    texts.append("x@y.zz 0a1b2c3d4e5f6a7b " * 3000)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    near = pii._with_matches(pii.with_base(docs), "_near", pii.CANDIDATE, F.lit(True))
    every = {r.doc_id: ([(b.start, b.end) for b in r.base], [(m.start, m.end) for m in r._near]) for r in near.select("doc_id", "base", "_near").collect()}
    got = {r.doc_id: [(c.start, c.end) for c in r.candidates] for r in pii.with_candidates(pii.with_base(docs)).collect()}
    for doc, (base, matches) in every.items():
        if doc < 150:
            assert got[doc] == [m for m in matches if not any(b[0] < m[1] and m[0] < b[1] for b in base)]
    assert len(got[150]) == 3000 and len(every[150][0]) == 3000


def test_candidates_begin_with_any_number_of_letters(spark):
    runs = ["key-" * 50 + "7f" + "ab" * 10, "x" * 20_000 + "@host1", "a" * 20_000]
    found = spark.createDataFrame([(r,) for r in runs], "t string").select(F.regexp_extract("t", pii.CANDIDATE, 0).alias("c"))
    assert [r.c for r in found.collect()] == [*runs[:2], ""]


def test_reliabilities():
    rng = random.Random(6)
    rows = Counter()
    for _ in range(4000):
        truth = rng.random() < 0.3
        votes = tuple((truth if rng.random() < p else not truth) * 1 if rng.random() < 0.8 else 2 for p in (0.95, 0.9, 0.85, 0.6))
        rows[votes, 5 if truth else 7, 4] += 1
    model = pii.estimate([(*k, n) for k, n in rows.items()])
    right = [r[1][1] / (r[1][0] + r[1][1]) for r in model.reliabilities]
    assert right[0] > 0.9 and right[1] > 0.84 and right[3] < 0.7
    assert model.weights["rank"][5] > 0 > model.weights["rank"][7]


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]


def test_automaton_equals_edit_distance():
    rng = random.Random(7)
    terms = [b"idiot", b"moron", b"scum", b"abcab", b"abcabc", "rée".encode()]
    automaton = toxicity.Automaton(terms)
    alphabet = list(b"abcidotmrnsu") + list("é".encode())
    tokens = [bytes(rng.choice(alphabet) for _ in range(rng.randint(1, 7))) for _ in range(3000)]
    for t in terms:
        for _ in range(150):
            x = list(t)
            for _ in range(rng.randint(0, 2)):
                i = rng.randrange(len(x) + 1)
                x[i : i + rng.randint(0, 1)] = [rng.choice(alphabet)][: rng.randint(0, 1)]
            tokens.append(bytes(x) or b"a")
    end = np.cumsum([len(t) for t in tokens])
    hit, term, found = automaton.match(np.frombuffer(b"".join(tokens), np.uint8), end - [len(t) for t in tokens], end)
    got = {tokens[i]: e for i, e in zip(hit.tolist(), found.tolist(), strict=True)}
    for t in tokens:
        want = min((e for w in terms if (e := edits(t, w)) <= (len(w) >= toxicity.FUZZY_FROM)), default=None)
        assert got.get(t) == want, t


def test_toxicity(spark):
    rng = random.Random(8)
    plain = [f"word{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(500):
        words = [rng.choice(plain) for _ in range(rng.randint(5, 60))]
        toxic = i % 5 == 0
        if toxic:
            words.insert(rng.randrange(len(words)), rng.choice(["you idiot", "zorgle", "moron", "zorgle scum"]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    rows += [(900, None), (901, ""), (902, "you idi0t " + " ".join(plain[:9])), (903, "idiot " * 50_000), (None, "zorgle")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 key", "2 word", "3 _text")
    known = spark.createDataFrame([*labels, (None, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.train(docs, known.filter(~toxicity.held_out(F.col("doc_id"))))
    assert b"zorgle" in model.terms
    out = toxicity.with_score(docs, model)
    assert out.columns == [*docs.columns, "score"]
    got = {r.doc_id: r.score for r in out.collect()}
    held = [(got[i], t) for i, t in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([(s >= 0.5) == t for s, t in held]) > 0.95
    assert got[900] < 0.5 and got[901] < 0.5 and got[902] > 0.5 and got[903] > 0.5
    assert toxicity.with_score(docs.limit(0), model).count() == 0
    bare = toxicity.train(docs, known.limit(0))
    assert {r.doc_id: r.score for r in toxicity.with_score(docs, bare).collect()}[900] < 0.5


def labelled(spark, texts):
    """Documents and labels of (text, toxic) pairs."""
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "doc_id long, text string")
    return docs, spark.createDataFrame([(i, y) for i, (_, y) in enumerate(texts)], "doc_id long, toxic int")


def test_other_words_leave_misspellings(spark):
    rng = random.Random(8)
    text = lambda *more: " ".join([*(f"word{rng.randint(0, 999)}" for _ in range(20)), *more])
    model = toxicity.train(*labelled(spark, [(text("oron"), 0) for _ in range(50)] + [(text("you moron"), 1) for _ in range(20)]))
    scorer = toxicity.Scorer(*(getattr(model, n) for n in list(model.__dataclass_fields__)[:3]))
    raw = [b"oron", b"morron", b"m0ron", b"moron"]
    found = scorer.features(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    assert (found[:, 1] > 0).tolist() == [False, True, True, True]


def test_other_words_count_copies_and_the_longest(spark):
    # A term of 32 bytes; a spelling of 33 in copies of one clean text; one that stands in too few rows; a label that is neither.
    rng = random.Random(11)
    text = lambda *more: " ".join([*(f"word{rng.randint(0, 999)}" for _ in range(20)), *more])
    term, copied = "z" + "abcdefgh" * 3 + "klmnopq", text("z" + "abcdefgh" * 3 + "klmnopqr")
    texts = [(text(term), 1) for _ in range(20)] + [(copied, 0)] * 5 + [(text("morron"), 0)] * 2 + [(text("m0ron"), 2)] * 50 + [(text(), 0) for _ in range(1000)]
    model = toxicity.train(*labelled(spark, texts))
    assert term.encode() in model.terms and model.others == {f"{term}r".encode()}


def test_training_writes_no_texts(spark):
    rng = random.Random(12)
    texts = [(" ".join(rng.choices([f"word{i}" for i in range(50)], k=2000)), i % 2) for i in range(200)]
    folder = Path(spark.conf.get("spark.checkpoint.dir"))
    files = lambda: {p: p.stat().st_size for p in folder.rglob("*.parquet") if p.is_file()}
    before = files()
    toxicity.train(*labelled(spark, texts))
    written = sum(n for p, n in files().items() if p not in before)
    assert 0 < written < 0.1 * sum(len(t) for t, _ in texts)


def test_texts_that_share_a_word_count_apart():
    rng = random.Random(10)
    texts = [" ".join(["common", *(f"w{rng.randint(0, 50)}" for _ in range(30))]) for _ in range(500)]
    batch = pa.record_batch({"text": [*texts, *texts], "toxic": pa.array([0] * 1000, pa.int32())})
    keys = {k for made in toxicity._term_rows([batch]) for k in made.column("key").to_pylist()}
    assert len(keys) == len(set(texts))


def test_lexicon_has_all_words_that_tell(spark):
    # 300 terms, each in 12 of 3,600 toxic texts.
    rng = random.Random(9)
    text = lambda *more: " ".join([*("word" + "".join(rng.choices("abcdefghij", k=3)) for _ in range(12)), *more])
    terms = [f"slur{a}{b}{c}" for a in "klmno" for b in "klmnopqrst" for c in "uvwxyz"]
    model = toxicity.train(*labelled(spark, [(text(t), 1) for t in terms * 12] + [(text(), 0) for _ in range(9000)]), sample=500)
    assert {t.encode() for t in terms} <= set(model.terms)
    assert len(model.terms) < 320


def test_copies_of_a_row_are_one_to_fit(spark):
    rows = spark.createDataFrame([("you idiot", 1), ("some text", 0)] * 100, "text string, toxic int")
    got = toxicity._features(rows, toxicity.Scorer((b"idiot",), np.array([4.0]))).collect()
    assert sorted((r.toxic, r.n) for r in got) == [(0, 100), (1, 100)]
    x, y = np.array([r.x for r in got]), np.array([r.toxic for r in got], float)
    once = toxicity._logistic(np.repeat(x, 100, axis=0), np.repeat(y, 100), np.ones(200))
    assert toxicity._logistic(x, y, np.full(2, 100.0)) == pytest.approx(once)


def test_quoted_terms_count_less():
    scorer = toxicity.Scorer((b"idiot",), np.array([4.0]))
    texts = [b"you idiot go away", b'he said "idiot" there', "sie sagte „idiot“ dort".encode(), b"an idiot"]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    best = scorer.features(data, offsets)[:, 3]
    assert best[0] > best[3] > best[1] == best[2]


def test_tables_need_a_shared_folder(spark):
    assert shared.stored(spark.range(3)).count() == 3


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = corpus_pipeline.drop_toxic(spark, docs, SF)
    scores = toxicity.with_score(docs, queries.toxicity_model(spark, docs, SF)).collect()
    ids = {r.doc_id for r in scores if r.score < 0.5}
    assert {r.doc_id for r in kept.collect()} == ids and kept.columns == docs.columns
    texts = {r.doc_id: r.text for r in docs.collect() if r.doc_id in ids}
    single = corpus_pipeline.drop_near_copies(spark, kept, SF)
    alone = {d for d, (_, c) in components_by_hand(texts, 5).items() if c == d}
    assert {r.doc_id for r in single.collect()} == alone and single.columns == docs.columns
    clean = corpus_pipeline.redact_personal_data(spark, single, SF)
    rows = clean.collect()
    assert {r.doc_id for r in rows} == alone and clean.columns == docs.columns
    for r in rows:
        assert r.n_chars == len(r.text)
        assert not base_by_hand(r.text), r.doc_id
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "n_tokens", "ids"]
    times = Counter(r.doc_id for r in out.select("doc_id").collect())
    assert set(times) <= alone and max(times.values()) <= 2
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "minhash_near_dedup", "pii", "source_mix", "byte_bpe"]
