"""Toxicity: misspelled lexicon terms by a Levenshtein automaton over a trie, weighed by what stands around them."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from incident_analytics.llm.arrays import LOWER, Rolling, by_text, byte_hashes, mix, slices, utf8
from incident_analytics.llm.bpe import spread
from incident_analytics.llm.shared import ship, stored

#: Insults to start from; training adds the terms that its labels show.
SEED_TERMS = ("idiot", "moron", "scum", "trash", "clown", "loser", "stupid", "pathetic", "worthless", "disgusting")
#: Words that address the reader, and words that report what others said.
ADDRESS = ("you", "your", "youre", "u", "du", "ihr", "dein", "tu", "vous", "ton", "tú", "usted", "eres")
REPORT = ("said", "says", "called", "quote", "quoted", "wrote", "word", "term", "sagte", "dit", "dijo", "mot", "wort", "palabra")
#: Labelled ids whose features the logistic fit reads; words are counted in all labelled texts.
SAMPLE = 20_000
#: Bits that tell most texts without a label before texts are shuffled.
LABEL_BITS = 1 << 26
#: Words of a run by which near copies are told.
SHINGLE = 4
#: Bytes of words that can become terms.
SHORTEST, LONGEST = 4, 32
#: One edit is allowed in terms of so many bytes; tokens around a hit; bytes within which quotation marks stand.
FUZZY_FROM, WINDOW, QUOTE_BYTES = 5, 4, 60
#: Weight of a misspelled hit, and the share of clean texts in which a near spelling of a term may
#: stand before it counts as another word.
FUZZY_WEIGHT, FUZZY_CLEAN = 0.7, 0.002

#: Bytes of tokens: letters, bytes of longer characters, and signs that stand in for letters.
_TOKEN = np.zeros(256, bool)
_TOKEN[[*range(97, 123), *range(65, 91), *range(128, 256), *b"013457@$"]] = True


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text of the tokens of lower-case texts; typographic quotes part tokens."""
    inside = _TOKEN[data]
    inside = inside & ~_quote_bytes(data)
    n = len(data)
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    edge = offsets[1:-1]
    edge = edge[(edge > 0) & (edge < n)]
    before[edge], after[edge - 1] = False, False
    start, end = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    return start, end, np.searchsorted(offsets, start, "right") - 1


def _quote_bytes(data: np.ndarray) -> np.ndarray:
    """Bytes of quotation marks: " and those of two and three bytes."""
    out = data == 0x22
    for mark in ("«", "»", "“", "”", "„"):
        raw = mark.encode()
        hit = np.ones(max(len(data) - len(raw) + 1, 0), bool)
        for i, b in enumerate(raw):
            hit &= data[i : i + len(hit)] == b
        at = np.flatnonzero(hit)
        for i in range(len(raw)):
            out[at + i] = True
    return out


class Automaton:
    """All strings within one edit of a lexicon term, as one deterministic automaton over bytes.

    Its states are sets of (trie node, edits made): the intersection of the terms' Levenshtein automata with
    the trie is worked out once, and a token costs one table lookup per byte until no term can follow.
    """

    def __init__(self, terms: list[bytes]):
        self.terms = terms
        children: list[dict[int, int]] = [{}]
        ends: dict[int, int] = {}
        for number, term in enumerate(terms):
            node = 0
            for byte in term:
                if byte not in children[node]:
                    children[node][byte] = len(children)
                    children.append({})
                node = children[node][byte]
            ends[node] = number
        alphabet = sorted({b for t in terms for b in t})
        self.kind = np.zeros(256, np.int64)
        self.kind[alphabet] = np.arange(1, len(alphabet) + 1)

        def closed(pairs: set[tuple[int, int]]) -> frozenset[tuple[int, int]]:
            skipped = {(c, 1) for n, e in pairs if e == 0 for c in children[n].values()}
            return frozenset(pairs | skipped)

        start = closed({(0, 0)})
        number = {frozenset(): 0, start: 1}
        queue, rows = [start], [[0] * (len(alphabet) + 1)]
        for state in queue:
            row = []
            free = {(n, 1) for n, e in state if e == 0} | {(c, 1) for n, e in state if e == 0 for c in children[n].values()}
            for byte in (-1, *alphabet):
                pairs = free | {(children[n][byte], e) for n, e in state if byte in children[n]}
                after = closed(pairs)
                if after not in number:
                    number[after] = len(number)
                    queue.append(after)
                row.append(number[after])
            rows.append(row)
        self.table = np.array(rows, np.int32)
        self.term, self.edits = np.full(len(rows), -1, np.int32), np.zeros(len(rows), np.int32)
        for state, at in number.items():
            hits = [(e, ends[n]) for n, e in state if n in ends and (e == 0 or len(terms[ends[n]]) >= FUZZY_FROM)]
            if hits:
                self.edits[at], self.term[at] = min(hits)

    def match(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Tokens that are a term or near one, the term, and the edits."""
        state = np.ones(len(start), np.int32)
        left, step = np.arange(len(start)), 0
        while True:
            left = left[(state[left] > 0) & (start[left] + step < end[left])]
            if not len(left):
                break
            state[left] = self.table[state[left], self.kind[data[start[left] + step]]]
            step += 1
        hit = np.flatnonzero(self.term[state] >= 0)
        return hit, self.term[state[hit]], self.edits[state[hit]]


@dataclass(frozen=True)
class Model:
    terms: tuple[bytes, ...]
    weights: np.ndarray
    #: Near spellings of terms that are words of their own.
    others: frozenset[bytes]
    coefficients: np.ndarray


_FEATURES = 9


class Scorer:
    """Features of texts from the hits of a lexicon and their windows."""

    def __init__(self, terms: tuple[bytes, ...], weights: np.ndarray, others: frozenset[bytes] = frozenset()):
        self.automaton, self.weights = Automaton(list(terms)), weights
        self.others = others
        self.cues = [Automaton([w.encode() for w in words]) for words in (ADDRESS, REPORT)]

    def features(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        n = len(offsets) - 1
        data = LOWER[data]
        start, end, text = tokens(data, offsets)
        count = np.bincount(text, minlength=n)
        hit, term, edits = self.automaton.match(data, start, end)
        counts = edits == 0
        near = np.flatnonzero(~counts)
        counts[near] = [data[x:y].tobytes() not in self.others for x, y in zip(start[hit[near]].tolist(), end[hit[near]].tolist(), strict=True)]
        hit, term, edits = hit[counts], term[counts], edits[counts]
        where = text[hit]
        address, report = (self._near(a, data, start, end, text, hit) for a in self.cues)
        quotes = np.concatenate(([0], np.cumsum(_quote_bytes(data))))
        left, right = np.maximum(start[hit] - QUOTE_BYTES, offsets[where]), np.minimum(end[hit] + QUOTE_BYTES, offsets[where + 1])
        quoted = (quotes[start[hit]] > quotes[left]) & (quotes[right] > quotes[end[hit]])
        # A quoted or reported hit says less than one that addresses somebody.
        context = np.where(quoted, 0.4, 1.0) * np.where(report & ~address, 0.6, 1.0) * np.where(address, 1.3, 1.0)
        exact = edits == 0
        weight = self.weights[term] * context * np.where(exact, 1.0, FUZZY_WEIGHT)
        total = lambda x: np.bincount(where, x, n)
        best = np.zeros((2, n))
        for i, some in enumerate((slice(None), ~exact)):
            np.maximum.at(best[i], where[some], weight[some])
        pairs = np.unique(where.astype(np.int64) << 20 | term)
        kinds = np.bincount(pairs >> 20, minlength=n)
        size = np.log1p(count)
        return np.stack([
            np.ones(n), np.log1p(total(weight)), np.log1p(total(weight * ~exact)), best[0], best[1],
            np.log1p(kinds), np.log1p(total(weight * quoted)), total(weight) / (1 + size), size,
        ], axis=1)

    @staticmethod
    def _near(cue: Automaton, data: np.ndarray, start: np.ndarray, end: np.ndarray, text: np.ndarray, hit: np.ndarray) -> np.ndarray:
        """Whether a cue word stands within WINDOW tokens of a hit in its text; only those tokens are read."""
        if not len(hit):
            return np.zeros(0, bool)
        low, high = np.maximum(hit - WINDOW, 0), np.minimum(hit + WINDOW + 1, len(start))
        around, owner = spread(low, high - low), np.repeat(np.arange(len(hit)), high - low)
        found, _, edits = cue.match(data, start[around], end[around])
        found = found[edits == 0]
        found = found[text[around[found]] == text[hit[owner[found]]]]
        out = np.zeros(len(hit), bool)
        out[owner[found]] = True
        return out


def _known(labels: DataFrame) -> DataFrame:
    """doc_id and toxic, one row for each labelled id."""
    known = labels.filter("toxic is not null and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    return stored(known.agg(F.max("toxic").cast("int").alias("toxic")))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))


def _rows(docs: DataFrame, known: DataFrame) -> DataFrame:
    """text and toxic of all labelled rows."""
    texts = _texts(docs)
    # Only spares shuffling texts: ids whose bit is set by another id go at the join.
    place = F.pmod(F.xxhash64("doc_id"), F.lit(LABEL_BITS))
    bits = known.groupBy(F.bitmap_bucket_number(place).alias("_part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("_bits"))
    texts = texts.withColumn("_part", F.bitmap_bucket_number(place)).withColumn("_bit", F.bitmap_bit_position(place))
    near = texts.join(F.broadcast(bits), "_part").filter("shiftright(cast(conv(hex(substring(_bits, cast(_bit div 8 as int) + 1, 1)), 16, 10) as int), cast(_bit % 8 as int)) & 1 = 1")
    # One plan at all sizes: few labels would be broadcast, many are not.
    return near.select("doc_id", "text").join(known.hint("merge"), "doc_id").select("text", "toxic")


def _sampled(docs: DataFrame, known: DataFrame, sample: int) -> DataFrame:
    """text and toxic of the rows of the `sample` labelled ids with the least hashes; no text is shuffled."""
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    return _texts(docs).join(F.broadcast(chosen), "doc_id").select("text", "toxic")


def _copy_keys(data: np.ndarray, start: np.ndarray, end: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    """A key per text that near copies mostly share and other texts hardly: two least hashes of its runs of SHINGLE words."""
    words = Rolling(byte_hashes(data).run(start, end))
    first = np.searchsorted(text, np.arange(n + 1))
    at = np.arange(len(start))
    last = first[text + 1]
    runs = words.run(at, np.minimum(at + SHINGLE, last))
    whole = (at + SHINGLE <= last) | (at == first[text])
    out = np.zeros(n, np.uint64)
    some = np.flatnonzero(np.diff(first))
    if len(some):
        for salt in (1, 2):
            least = np.minimum.reduceat(np.where(whole, mix(runs ^ mix(np.full(1, salt, np.uint64))), ~np.uint64(0)), first[some])
            out[some] = mix(out[some] + least)
    return out.view(np.int64)


def _term_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, word, toxic): the words of each text once, and a key that near copies mostly share."""
    for batch in batches:
        data, offsets = utf8(batch.column("text"))
        toxic = batch.column("toxic").to_pylist()
        for a, b in slices(offsets):
            part, at = LOWER[data[offsets[a] : offsets[b]]], offsets[a : b + 1] - offsets[a]
            start, end, text = tokens(part, at)
            raw = part.tobytes()
            words: list[set[bytes]] = [set() for _ in range(b - a)]
            for i, x, y in zip(text.tolist(), start.tolist(), end.tolist(), strict=True):
                # A near spelling of the longest term has a byte more.
                if SHORTEST <= y - x <= LONGEST + 1:
                    words[i].add(raw[x:y])
            keys = _copy_keys(part, start, end, text, b - a).tolist()
            for i, some in enumerate(words):
                listed = sorted(some | {b""})
                yield pa.RecordBatch.from_pydict(
                    {"key": pa.array([keys[i]] * len(listed), pa.int64()), "word": pa.array(listed, pa.binary()), "toxic": pa.array([toxic[a + i]] * len(listed), pa.int32())}
                )


def _word_counts(rows: DataFrame) -> DataFrame:
    """word; bad and good, the texts of either label that have it; clean, the rows labelled 0 that have it.

    All that is learned from words is read from here, so labelled texts are shuffled once and written nowhere.
    """
    words = rows.select("text", "toxic").mapInArrow(_term_rows, "key long, word binary, toxic int")
    # Near copies count once per word in bad and good, so the words of a text that was copied often don't look like a habit.
    texts = words.groupBy("key", "word", "toxic").agg(F.count("*").alias("n"))
    is_bad = F.when(F.col("toxic") == 1, 1).otherwise(0)
    clean = F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)
    return stored(texts.groupBy("word").agg(F.sum(is_bad).alias("bad"), F.sum(1 - is_bad).alias("good"), F.sum(clean).alias("clean")))


def _lexicon(counts: DataFrame) -> tuple[tuple[bytes, ...], np.ndarray]:
    """Seed terms and the words whose presence speaks for the label beyond chance, with their log-odds.

    Words of 4 to 32 bytes can become terms: shorter ones have too many others near them, and longer ones are
    addresses and keys. A word's likelihood ratio must pass twice the logarithm of the number of different words, so about one word of
    all passes by chance, whatever the input's size; there is no fixed number of terms.
    """
    counts = counts.filter(F.length("word") <= LONGEST)
    # Each text has the empty word.
    texts = counts.filter("word = X''").first()
    bad, good = (texts["bad"], texts["good"]) if texts else (0, 0)
    n_words = max(counts.count() - 1, 1)
    odds = F.log((F.col("bad") + 0.5) / F.lit(bad + 1.0)) - F.log((F.col("good") + 0.5) / F.lit(good + 1.0))
    share = bad / max(bad + good, 1)
    seen = F.col("bad") + F.col("good")
    part = lambda n, p: F.when(n > 0, n * F.log(n / (seen * F.lit(max(p, 1e-9))))).otherwise(0.0)
    ratio = 2 * (part(F.col("bad"), share) + part(F.col("good"), 1 - share))
    ranked = counts.filter("word != X''").withColumn("odds", odds).filter((F.col("bad") >= 3) & (F.col("odds") > 2.0) & (ratio > 2 * float(np.log(n_words))))
    seeds = [t.encode() for t in SEED_TERMS]
    found = ranked.orderBy(F.desc(F.col("odds") * F.sqrt("bad")), "word").collect()
    weights = dict.fromkeys(seeds, 4.0) | {bytes(r["word"]): min(float(r["odds"]), 8.0) for r in found}
    terms = tuple(dict.fromkeys((*seeds, *(bytes(r["word"]) for r in found))))
    return terms, np.array([weights[t] for t in terms])


def _other_words(counts: DataFrame, terms: tuple[bytes, ...]) -> frozenset[bytes]:
    """Near spellings of terms that texts which are not toxic use: those in more than FUZZY_CLEAN of them."""
    sent = counts.sparkSession.sparkContext.broadcast(Automaton(list(terms)))

    def near(data: np.ndarray, offsets: np.ndarray) -> dict[str, object]:
        out = np.zeros(len(offsets) - 1, np.int32)
        hit, _, edits = sent.value.match(data, offsets[:-1], offsets[1:])
        out[hit] = edits
        return {"edits": out}

    fields = [pa.field("word", pa.binary()), pa.field("edits", pa.int32())]
    texts = counts.filter("word = X''").first()
    often = counts.filter(F.col("clean") > FUZZY_CLEAN * (texts["clean"] if texts else 0)).select("word")
    found = often.mapInArrow(by_text(near, pa.schema(fields), "word"), "word binary, edits int")
    return frozenset(bytes(r["word"]) for r in found.filter("edits > 0").collect())


def _logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray, ridge: float = 0.1, rounds: int = 40) -> np.ndarray:
    """Coefficients by Newton steps with a ridge; each row counts n times."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (n * (y - p)) - ridge * w
        bend = (x * (n * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _features(rows: DataFrame, scorer: Scorer) -> DataFrame:
    """toxic, features x and n, the number of rows that have them: copies of a text are one row."""
    sent = rows.sparkSession.sparkContext.broadcast(scorer)

    def features(data: np.ndarray, offsets: np.ndarray) -> dict[str, object]:
        return {"x": pa.array(list(sent.value.features(data, offsets)), pa.list_(pa.float64()))}

    fields = [pa.field("toxic", pa.int32()), pa.field("x", pa.list_(pa.float64()))]
    found = rows.select("toxic", "text").mapInArrow(by_text(features, pa.schema(fields)), "toxic int, x array<double>")
    return found.groupBy("toxic", "x").agg(F.count("*").alias("n"))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Lexicon weights from all labelled rows, and a logistic model from those of at most `sample` ids.

    Without rows of both labels, a text is toxic if an unquoted exact hit of a seed term stands in it.
    """
    ship(docs.sparkSession)
    known = _known(labels)
    counts = _word_counts(_rows(docs, known))
    lexicon, weights = _lexicon(counts)
    others = _other_words(counts, lexicon)
    got = _features(_sampled(docs, known, sample), Scorer(lexicon, weights, others)).collect()
    y = np.array([r["toxic"] for r in got], float)
    if len(set(y.tolist())) < 2:
        coefficients = np.zeros(_FEATURES)
        coefficients[0], coefficients[3] = -3.0, 1.0
    else:
        coefficients = _logistic(np.array([r["x"] for r in got]), y, np.array([r["n"] for r in got], float))
    return Model(lexicon, weights, others, coefficients)


def with_score(docs: DataFrame, model: Model, out: str = "score") -> DataFrame:
    """The documents with a column of probabilities that they are toxic; every whole text, nulls as empty."""
    ship(docs.sparkSession)
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row")
    sent = docs.sparkSession.sparkContext.broadcast(Scorer(model.terms, model.weights, model.others))
    coefficients = model.coefficients

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column("_text"))
            got = [np.zeros(0)]
            for a, b in slices(offsets):
                x = sent.value.features(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                got.append(1 / (1 + np.exp(-np.clip(x @ coefficients, -30, 30))))
            yield pa.RecordBatch.from_arrays([batch.column("_row"), pa.array(np.concatenate(got))], ["_row", "_score"])

    read = docs.select(row, F.col("text").alias("_text"))
    shape = StructType([read.schema["_row"], StructField("_score", DoubleType())])
    return read.mapInArrow(run, shape).select("_row.*", F.col("_score").alias(out))


def held_out(doc_id: Column, parts: int = 5) -> Column:
    """Rows that training must not see: the checksum of the id as text is divisible by `parts`."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % parts == 0, F.lit(False))
