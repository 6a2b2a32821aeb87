"""Language model scores: n-gram counts in a log-frequency Bloom filter, over exact word counts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from incident_analytics.llm.arrays import LOWER, Words, mix, slices, utf8
from incident_analytics.llm.repeats import CHUNK_BYTES, _packed, _short, _unpacked
from incident_analytics.llm.shared import ship

#: The hash that stands for the end of a text.
END = np.uint64(0x656E64)
#: Without effect, kept for callers that set it: all words take part in n-grams.
VOCABULARY = 1 << 16
#: Counts are kept as levels: level q stands for BASE ** (q - 1) at least.
BASE, LEVELS = 2**0.5, 64
#: What each n-gram count gives to words that did not follow.
DISCOUNT = 0.75
#: Bits per inserted level, probes per level, and bits of a block.
BITS_PER_ITEM, PROBES, BLOCK_BITS = 10, 6, 1 << 19


class LogFrequencyFilter:
    """Which (n-gram, level) were put in. An n-gram's levels lie in one block, so blocks are built apart.

    A count of level q is put in as levels 1 to q, and read by probing one level after the other
    up to the first that is missing. Counts are never read too low; a false level has probability
    below 0.01 at BITS_PER_ITEM.
    """

    def __init__(self, blocks: np.ndarray):
        self.blocks = blocks

    @staticmethod
    def block_of(keys: np.ndarray, n_blocks: int) -> np.ndarray:
        return ((mix(keys) >> np.uint64(32)) % np.uint64(n_blocks)).astype(np.int64)

    @staticmethod
    def place(keys: np.ndarray, level: np.ndarray | int, probe: int) -> np.ndarray:
        salted = mix(keys * np.uint64(64 * 64) + np.asarray(level).astype(np.uint64) * np.uint64(64) + np.uint64(probe))
        return (salted & np.uint64(BLOCK_BITS - 1)).astype(np.int64)

    @staticmethod
    def build_block(keys: np.ndarray, levels: np.ndarray) -> bytes:
        bits = np.zeros(BLOCK_BITS, bool)
        for level in range(1, int(levels.max(initial=0)) + 1):
            some = keys[levels >= level]
            for probe in range(PROBES):
                bits[LogFrequencyFilter.place(some, level, probe)] = True
        return np.packbits(bits).tobytes()

    @staticmethod
    def of(keys: np.ndarray, levels: np.ndarray) -> LogFrequencyFilter:
        """Of as many blocks as the keys need; none without keys."""
        n_blocks = -(-int(levels.sum()) * BITS_PER_ITEM // BLOCK_BITS)
        block = LogFrequencyFilter.block_of(keys, max(n_blocks, 1))
        order = np.argsort(block, kind="stable")
        keys, levels, edges = keys[order], levels[order], np.searchsorted(block[order], np.arange(n_blocks + 1))
        built = [np.frombuffer(LogFrequencyFilter.build_block(keys[a:b], levels[a:b]), np.uint8) for a, b in zip(edges[:-1], edges[1:], strict=True)]
        return LogFrequencyFilter(np.array(built).reshape(n_blocks, BLOCK_BITS // 8))

    def levels(self, keys: np.ndarray) -> np.ndarray:
        out = np.zeros(len(keys), np.int64)
        if not len(self.blocks):
            return out
        block = self.block_of(keys, len(self.blocks))
        left = np.arange(len(keys))
        for level in range(1, LEVELS + 1):
            for probe in range(PROBES):
                at = self.place(keys[left], level, probe)
                left = left[(self.blocks[block[left], at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1]
            if not len(left):
                break
            out[left] = level
        return out


def _tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of all texts, each with its end, and where each text begins (and the last ends)."""
    words = Words(LOWER[data], offsets)
    first = words.first + np.arange(len(offsets))
    out = np.full(first[-1], END, np.uint64)
    inside = np.ones(len(out), bool)
    inside[first[1:] - 1] = False
    out[inside] = words.hashes()
    return out, first


def _levels_of(counts: np.ndarray) -> np.ndarray:
    return np.minimum(np.floor(np.log(counts) / np.log(BASE) + 1e-9).astype(np.int64) + 1, LEVELS)


def _least_count(levels: np.ndarray) -> np.ndarray:
    return np.where(levels > 0, np.maximum(np.ceil(BASE ** (levels - 1.0) - 1e-9), 1), 0)


def _counted(keys_of):
    """A mapInArrow function: (key, n) of what `keys_of` finds in texts, summed over some megabytes before it is sent."""

    def flush(found: list[np.ndarray]) -> pa.RecordBatch:
        keys, n = np.unique(np.concatenate(found), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n)], ["key", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, size = [], 0
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            for a, b in slices(offsets):
                found.append(keys_of(*_tokens(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])))
                size += len(found[-1])
                if size > 4_000_000:
                    yield flush(found)
                    found, size = [], 0
        if size:
            yield flush(found)

    return run


class _Keys:
    """The different keys of a chunk by bucket and value, where each given key stands among them, and its trained count."""

    def __init__(self, keys: np.ndarray, trained: np.ndarray, n_buckets: int):
        different, which = np.unique(keys, return_inverse=True)
        bucket = (different % np.uint64(n_buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.keys, self.at = different[order], place[which]
        self.n = np.bincount(self.at, trained, len(order)).astype(np.int64)
        self.edges = np.searchsorted(bucket[order], np.arange(n_buckets + 1))


class _Chunk:
    """Tokens of the documents of a chunk, its words, and its bigrams with the word that each begins with."""

    def __init__(self, table: pa.Table, n_buckets: int):
        table = table.combine_chunks()
        data, offsets = utf8(table.column("text").chunk(0))
        read = [_tokens(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]) for a, b in slices(offsets)]
        tokens = np.concatenate([t for t, _ in read])
        self.table, self.size = table, np.concatenate([np.diff(f) for _, f in read])
        self.text = np.repeat(np.arange(len(self.size)), self.size)
        trained = table.column("trained").to_numpy()[self.text]
        #: Tokens that stand behind another one of their text.
        self.behind = np.flatnonzero(np.append(False, self.text[1:] == self.text[:-1]))
        self.words = _Keys(tokens, trained, n_buckets)
        self.pairs = _Keys(mix(mix(tokens[self.behind - 1]) + tokens[self.behind]), trained[self.behind], n_buckets)
        self.history = np.zeros(len(self.pairs.keys), np.int64)
        self.history[self.pairs.at] = self.words.at[self.behind - 1]

    def answered(self, answers: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Count and mass of each word, level of each bigram, and the level again where the chunk is its owner."""
        n, mass = np.zeros(len(self.words.keys), np.int64), np.zeros(len(self.words.keys))
        level, own = np.zeros((2, len(self.pairs.keys)), np.uint8)
        for bucket, step, body, levels, owned in zip(*(answers.column(c).to_pylist() for c in ("bucket", "step", "body", "level", "own")), strict=True):
            words, pairs = (slice(*k.edges[bucket : bucket + 2]) for k in (self.words, self.pairs))
            if step == 1:
                n[words] = _unpacked(body)[0]
                level[pairs], own[pairs] = np.frombuffer(levels, np.uint8), np.frombuffer(owned, np.uint8)
            else:
                mass[words] = _unpacked(body)[0].view(np.float64)
        return n, mass, level, own


_KEY_BYTES = 5
_TO_BUCKET, _MASS = "bucket long, chunk long, words binary, pairs binary, n binary", "bucket long, chunk long, words binary"
_TO_CHUNK = "chunk long, bucket long, step int, body binary, level binary, own binary"


def _send_keys(n_buckets: int):
    """Each word and bigram of a chunk once, with how often it stands in training texts of the chunk."""

    def run(table: pa.Table) -> pa.Table:
        chunk = _Chunk(table, n_buckets)
        words, pairs = chunk.words, chunk.pairs
        out: dict[str, list] = {n: [] for n in ("bucket", "chunk", "words", "pairs", "n")}
        for b in range(n_buckets):
            w, p = slice(*words.edges[b : b + 2]), slice(*pairs.edges[b : b + 2])
            body = _packed(np.stack([words.keys[w].view(np.int64), words.n[w]]))
            for name, value in zip(out, (b, table.column("chunk")[0].as_py(), body, _short(pairs.keys[p], _KEY_BYTES), _packed(pairs.n[None, p])), strict=True):
                out[name].append(value)
        return pa.table({n: pa.array(v, pa.int64() if n in ("bucket", "chunk") else pa.binary()) for n, v in out.items()})

    return run


def _answers(table: pa.Table, step: int, body: list[bytes], level: list[bytes], own: list[bytes]) -> pa.Table:
    made = {"body": body, "level": level, "own": own}
    steps = pa.array([step] * table.num_rows, pa.int32())
    return pa.table({"chunk": table.column("chunk"), "bucket": table.column("bucket"), "step": steps} | {n: pa.array(v, pa.binary()) for n, v in made.items()})


def _count(table: pa.Table) -> pa.Table:
    """Exact counts of the words and the filter's levels of the bigrams that each chunk sent.

    `own` repeats the level put in, for one of the chunks that sent a bigram, so that each is added up once.
    """
    heads = [_unpacked(x) for x in table.column("words").to_pylist()]
    keys, n = np.concatenate(heads, axis=1)
    _, which = np.unique(keys, return_inverse=True)
    total = np.bincount(which, n).astype(np.int64)[which] if len(which) else n
    cuts = np.cumsum([h.shape[1] for h in heads])[:-1]
    body = [_packed(x[None]) for x in np.split(total, cuts)]
    raw = [np.frombuffer(x, np.uint8).reshape(-1, _KEY_BYTES) for x in table.column("pairs").to_pylist()]
    wide = np.zeros((sum(map(len, raw)), 8), np.uint8)
    np.concatenate(raw, out=wide[:, 8 - _KEY_BYTES :])
    n = np.concatenate([_unpacked(x)[0] for x in table.column("n").to_pylist()])
    pairs, lead, which = np.unique(wide.view(">u8").ravel().astype(np.uint64), return_index=True, return_inverse=True)
    total = np.bincount(which, n, len(pairs))
    level = np.zeros(len(pairs), np.int64)
    level[total > 0] = _levels_of(total[total > 0])
    read = LogFrequencyFilter.of(pairs[level > 0], level[level > 0]).levels(pairs).astype(np.uint8)[which]
    own = np.zeros(len(which), np.uint8)
    own[lead] = level
    cuts = np.cumsum([len(x) for x in raw])[:-1]
    return _answers(table, 1, body, *([x.tobytes() for x in np.split(y, cuts)] for y in (read, own)))


def _send_mass(n_buckets: int):
    """What the bigrams that the chunk owns take of each of its words' probability, times the word's count."""

    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        chunk = _Chunk(table, n_buckets)
        *_, own = chunk.answered(answers)
        taken = np.where(own > 0, _least_count(own.astype(np.int64)) - DISCOUNT, 0.0)
        mass = np.bincount(chunk.history, taken, len(chunk.words.keys))
        both = np.stack([chunk.words.keys.view(np.int64), mass.view(np.int64)])
        edges = chunk.words.edges
        body = [_packed(both[:, edges[b] : edges[b + 1]]) for b in range(n_buckets)]
        return pa.table({"bucket": np.arange(n_buckets), "chunk": pa.array([table.column("chunk")[0].as_py()] * n_buckets, pa.int64()), "words": pa.array(body, pa.binary())})

    return run


def _add_mass(table: pa.Table) -> pa.Table:
    heads = [_unpacked(x) for x in table.column("words").to_pylist()]
    keys, mass = np.concatenate(heads, axis=1)
    _, which = np.unique(keys, return_inverse=True)
    # Levels' least counts less the discount are multiples of a quarter, so sums don't depend on their order.
    total = np.bincount(which, mass.view(np.float64))[which] if len(which) else np.zeros(0)
    body = [_packed(x.view(np.int64)[None]) for x in np.split(total, np.cumsum([h.shape[1] for h in heads])[:-1])]
    return _answers(table, 2, body, *[[b""] * len(heads)] * 2)


def _score(n_buckets: int, norm: float):
    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        chunk = _Chunk(table, n_buckets)
        n, mass, level, _ = chunk.answered(answers)
        # Share of a history's probability that goes to words outside its n-grams.
        rest = np.maximum(1 - mass / np.maximum(n, 1), 1e-6)
        word = chunk.words.at
        h, w = word[chunk.behind - 1], word[chunk.behind]
        alone = (n[w] + 0.1) / norm
        # A word that training doesn't have follows nothing there, whatever the filter says.
        least = np.where(n[w] > 0, _least_count(level.astype(np.int64))[chunk.pairs.at], 0)
        behind = np.maximum(least - DISCOUNT, 0) / np.maximum(n[h], 1) + rest[h] * alone
        # What a known history changes: log10 of the mixed probability over that of the word alone.
        gain = np.where(n[h] > 0, np.log10(behind / alone), 0.0)
        texts = len(chunk.size)
        made = pa.table({
            "doc_id": chunk.table.column("doc_id"), "n_tokens": chunk.size.astype(np.int64),
            "n_known": np.bincount(chunk.text, n[word] > 0, texts).astype(np.int64),
            "base_score": np.bincount(chunk.text, (np.log10(n + 0.1) - np.log10(norm))[word], texts),
            "gain": np.bincount(chunk.text[chunk.behind], gain, texts),
        })
        return made.filter(chunk.table.column("scored"))

    return run


def _scored(rows: DataFrame) -> DataFrame:
    """Scores of the rows that are `scored`, by all n-grams of those that are `trained`.

    Texts are dealt to chunks and shuffled once. A chunk sends each of its words and bigrams once, with its
    trained count; buckets add them up, put the bigrams into their part of the filter and answer. Then chunks send
    what the bigrams take from each word, and buckets answer the sums. Nothing goes to the driver or to all tasks
    but two totals.
    """
    ship(rows.sparkSession)
    size = rows.select(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0)).alias("n")).first()["n"]
    n_chunks = max(-(-size // CHUNK_BYTES), 1)
    counts = rows.filter("trained").select("text").mapInArrow(_counted(lambda t, _: t), "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    whole = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    norm = whole["n"] + 0.1 * (whole["v"] + 1)
    chunked = rows.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_chunks)))

    def by_chunk(df: DataFrame):
        return df.groupBy("chunk")

    sent = by_chunk(chunked).applyInArrow(_send_keys(n_chunks), _TO_BUCKET)
    levels = sent.groupBy("bucket").applyInArrow(_count, _TO_CHUNK)
    taken = by_chunk(chunked).cogroup(by_chunk(levels)).applyInArrow(_send_mass(n_chunks), _MASS)
    masses = taken.groupBy("bucket").applyInArrow(_add_mass, _TO_CHUNK)
    shape = "doc_id long, n_tokens long, n_known long, base_score double, gain double"
    out = by_chunk(chunked).cogroup(by_chunk(levels.union(masses))).applyInArrow(_score(n_chunks, norm), shape)
    base = F.col("base_score") if whole["n"] else F.lit(0.0) * F.col("n_tokens")
    return out.select("doc_id", "n_tokens", "n_known", F.lit(whole["n"]).cast("long").alias("train_tokens"), base.alias("base_score"), (base + F.col("gain")).alias("score"))


def scores(docs: DataFrame, training: DataFrame | Column) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score of each row of `docs`.

    training: the rows to learn from, or a condition that says which of `docs` they are, so that texts travel once.
    base_score adds up the smoothed exact unigrams; score mixes in the n-grams behind known histories: all
    of them, with the counts that the filter gives. A null or empty text has its end only. Repeated rows and
    ids are scored alone. Without training rows each token has probability 1.
    """
    doc_id = F.col("doc_id").cast("long").alias("doc_id")
    if isinstance(training, Column):
        return _scored(docs.select(doc_id, "text", F.lit(True).alias("scored"), F.coalesce(training, F.lit(False)).alias("trained")))
    rows = docs.select(doc_id, "text", F.lit(True).alias("scored"), F.lit(False).alias("trained"))
    return _scored(rows.unionAll(training.select(doc_id, "text", F.lit(False).alias("scored"), F.lit(True).alias("trained"))))
