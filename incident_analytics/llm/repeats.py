"""Runs of symbols that occur before, found across all documents without sending every position.

A window is `length` consecutive units (bytes or words) of one document. Its anchor is the gram of least
hash inside it, so equal windows have equal anchors, and neighbouring windows mostly share theirs. A segment
is a run of windows with one anchor. Documents are dealt to chunks, and only this travels between them:

1. each chunk sends the keys of its anchors, once each, to buckets; a bucket answers which keys occur again;
2. each chunk sends its different segments with such a key, each with its first place in the chunk; a
   bucket finds equal windows in all segments it got and answers where each first occurs;
3. each chunk marks what its windows cover and finishes its documents.

A passage in every document is one segment per chunk, whatever the number of copies in the chunk. Its edges, and
any phrase shorter than a window that many texts share, are one key with as many different segments: the windows
of a key with more than HEAVY of them go alone, each with its own hash as key.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from incident_analytics.llm.arrays import Rolling, numbered, slices, spread, utf8
from incident_analytics.llm.shared import ship

_LOW = np.uint64(0xFFFFFFFF)
#: Bytes of text of a chunk, and buckets per chunk.
CHUNK_BYTES, BUCKETS_PER_CHUNK = 8 << 20, 2
#: Different segments of one key that may meet in a bucket; beyond it their windows are dealt one by one.
HEAVY = 4096


def windows_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` consecutive values."""
    span, out = 1, values
    while 2 * span <= width:
        out = np.minimum(out[:-span], out[span:]) if len(out) > span else out[:0]
        span *= 2
    rest = width - span
    if rest and len(out) > rest:
        out = np.minimum(out[:-rest], out[rest:])
    return out[: max(len(values) - width + 1, 0)]


@dataclass
class Segments:
    """Runs of windows with one anchor: first unit, number of windows, key, digest of the units, document."""

    start: np.ndarray
    count: np.ndarray
    key: np.ndarray
    digest: np.ndarray
    doc: np.ndarray

    def alone(self, some: np.ndarray, values: np.ndarray, length: int) -> Segments:
        """Each window of some segments as a segment whose key is the hash of all its units."""
        count = self.count[some]
        within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        start = np.repeat(self.start[some], count) + within
        key = Rolling(values).run(start, start + length)
        return Segments(start, np.ones(len(start), np.int64), key, key, np.repeat(self.doc[some], count))

    @staticmethod
    def of(values: np.ndarray, first: np.ndarray, length: int, gram: int) -> Segments:
        """values: a hash per unit; first: first unit of each document, and the end."""
        rolling = Rolling(values)
        grams = rolling.windows(gram)
        packed = (grams & ~_LOW) | np.arange(len(grams), dtype=np.uint64)
        anchor = (windows_min(packed, length - gram + 1) & _LOW).astype(np.int64)
        ends = np.repeat(first[1:], np.diff(first))[: len(anchor)]
        starts = np.flatnonzero(np.arange(length, length + len(anchor)) <= ends)
        anchor = anchor[starts]
        fresh = np.ones(len(starts), bool)
        fresh[1:] = (anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1)
        at = np.flatnonzero(fresh)
        start, count = starts[at], np.diff(np.append(at, len(starts)))
        digest = rolling.run(start, start + count + length - 1)
        return Segments(start, count, grams[anchor[at]], digest, np.searchsorted(first, start, "right") - 1)


@dataclass(frozen=True)
class Units:
    """How texts fall into units. `read` gives a hash per unit, the units of each text and each unit's byte range;
    `first_of` finds where windows first occur; `ordered` says whether places in one document count."""

    length: int
    gram: int
    ordered: bool
    read: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]
    raw: Callable[[np.ndarray, np.ndarray, np.ndarray], bytes]
    first_of: Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


class Chunk:
    """The documents of a chunk and their segments, found slice by slice."""

    def __init__(self, table: pa.Table, units: Units):
        table = table.combine_chunks()
        self.table, self.units = table, units
        self.ids = table.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
        column = table.column("text")
        self.data, self.offsets = utf8(column.chunk(0) if column.num_chunks else pa.array([], pa.string()))

    def values(self, part: int) -> np.ndarray:
        """The hash of each unit of a part."""
        a, b = list(slices(self.offsets))[part]
        return self.units.read(self.data[self.offsets[a] : self.offsets[b]], self.offsets[a : b + 1] - self.offsets[a])[0]

    def parts(self) -> Iterator[tuple[int, int, np.ndarray, tuple, Segments]]:
        for a, b in slices(self.offsets):
            data = self.data[self.offsets[a] : self.offsets[b]]
            read = self.units.read(data, self.offsets[a : b + 1] - self.offsets[a])
            yield a, b, data, read, Segments.of(read[0], read[1], self.units.length, self.units.gram)


def _keys(found: list[Segments], n_buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different keys by bucket and value, whether each occurs again, and where each bucket begins."""
    keys, n = np.unique(np.concatenate([s.key for s in found] or [np.zeros(0, np.uint64)]), return_counts=True)
    bucket = (keys % np.uint64(n_buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    return keys[order], n[order] > 1, np.searchsorted(bucket[order], np.arange(n_buckets + 1))


def _different(found: list[Segments], keys: np.ndarray) -> np.ndarray:
    """A byte per key for its number of different segments: c stands for 2 ** (c / 2) at least. One or two are 0."""
    key, digest = (np.concatenate([getattr(s, n) for s in found] or [np.zeros(0, np.uint64)]) for n in ("key", "digest"))
    ranked, n = np.unique(key, return_counts=True)
    ranked = ranked[n > 2]
    out = np.zeros(len(keys), np.uint8)
    if not len(ranked):
        return out
    at = np.minimum(np.searchsorted(ranked, key), len(ranked) - 1)
    often = np.flatnonzero(ranked[at] == key)
    at, digest = at[often], digest[often]
    order = np.lexsort((digest, at))
    at, digest = at[order], digest[order]
    fresh = np.ones(len(at), bool)
    fresh[1:] = (at[1:] != at[:-1]) | (digest[1:] != digest[:-1])
    code = np.floor(2 * np.log2(np.bincount(at[fresh], minlength=len(ranked))) + 1e-9).astype(np.uint8)
    at = np.minimum(np.searchsorted(ranked, keys), len(ranked) - 1)
    return np.where(ranked[at] == keys, code[at], 0).astype(np.uint8)


def _bits(bits: np.ndarray, more: np.ndarray) -> bytes:
    """A bit per key, and behind them bytes for those that are set."""
    return np.packbits(bits).tobytes() + more.tobytes()


def _read_bits(body: bytes, size: int) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(body, np.uint8)
    return np.unpackbits(raw, count=size).astype(bool), raw[-(-size // 8) :]


def _rows(columns: dict[str, list], schema: pa.Schema) -> pa.Table:
    return pa.table({f.name: pa.array(columns[f.name], f.type) for f in schema}, schema=schema)


_TO_BUCKET = pa.schema([("bucket", pa.int64()), ("chunk", pa.int64()), ("body", pa.binary()), ("more", pa.binary())])
_TO_CHUNK = pa.schema([("chunk", pa.int64()), ("bucket", pa.int64()), ("step", pa.int32()), ("body", pa.binary())])
_BUCKET_SHAPE, _CHUNK_SHAPE = "bucket long, chunk long, body binary, more binary", "chunk long, bucket long, step int, body binary"


def _short(keys: np.ndarray, width: int) -> bytes:
    """The upper `width` bytes of each key."""
    return np.ascontiguousarray(keys.astype(">u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def _send_keys(units: Units, n_buckets: int, width: int):
    def run(table: pa.Table) -> pa.Table:
        found = [s for *_, s in Chunk(table, units).parts()]
        keys, twice, first = _keys(found, n_buckets)
        different = _different(found, keys)
        out: dict[str, list] = {f.name: [] for f in _TO_BUCKET}
        for b in np.flatnonzero(np.diff(first)).tolist():
            some = slice(first[b], first[b + 1])
            for name, value in zip(out, (b, table.column("chunk")[0].as_py(), _short(keys[some], width), _bits(twice[some], different[some][twice[some]])), strict=True):
                out[name].append(value)
        return _rows(out, _TO_BUCKET)

    return run


def _find_again(width: int):
    def run(table: pa.Table) -> pa.Table:
        bodies = [np.frombuffer(x, np.uint8).reshape(-1, width) for x in table.column("body").to_pylist()]
        heads = [_read_bits(x, len(y)) for x, y in zip(table.column("more").to_pylist(), bodies, strict=True)]
        twice = np.concatenate([x for x, _ in heads])
        different = np.ones(len(twice))
        different[twice] = 2 ** (np.concatenate([x for _, x in heads]) / 2)
        wide = np.zeros((sum(map(len, bodies)), 8), np.uint8)
        np.concatenate(bodies, out=wide[:, 8 - width :])
        keys = wide.view(">u8").ravel().astype(np.uint64)
        _, which, n = np.unique(keys, return_inverse=True, return_counts=True)
        again = (n[which] > 1) | twice
        heavy = (np.bincount(which, different) > HEAVY)[which]
        cuts = np.cumsum([len(x) for x in bodies])[:-1]
        n_rows = table.num_rows
        return _rows(
            {
                "chunk": table.column("chunk").to_pylist(), "bucket": table.column("bucket").to_pylist(), "step": [1] * n_rows,
                "body": [_bits(x, np.packbits(y[x])) for x, y in zip(np.split(again, cuts), np.split(heavy, cuts), strict=True)],
            },
            _TO_CHUNK,
        )

    return run


def _asked(answers: pa.Table, found: list[Segments], n_buckets: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each part, which of its segments have a key that occurs again, and of those one with many segments."""
    keys, again, first = _keys(found, n_buckets)
    again[:] = False
    heavy = again.copy()
    for bucket, step, body in zip(*(answers.column(c).to_pylist() for c in ("bucket", "step", "body")), strict=True):
        if step == 1:
            bits, more = _read_bits(body, first[bucket + 1] - first[bucket])
            some = first[bucket] + np.flatnonzero(bits)
            again[some] = True
            heavy[some] = np.unpackbits(more, count=len(some))

    def having(wanted: np.ndarray) -> list[np.ndarray]:
        if not len(wanted):
            return [np.zeros(len(s.key), bool) for s in found]
        return [wanted[np.minimum(np.searchsorted(wanted, s.key), len(wanted) - 1)] == s.key for s in found]

    return list(zip(having(np.sort(keys[again & ~heavy])), having(np.sort(keys[heavy])), strict=True))


def _light(chunk: Chunk) -> tuple[list[Segments], list[int], list[np.ndarray]]:
    """Segments of the chunk, the first document of each part and the first unit of each document."""
    found, at, firsts = [], [], []
    for a, _, _, read, segments in chunk.parts():
        found.append(segments)
        at.append(a)
        firsts.append(read[1])
    return found, at, firsts


def _occurrences(chunk: Chunk, answers: pa.Table, n_buckets: int) -> dict[str, np.ndarray]:
    """Of the segments asked for: part, start, windows, document, place in it, bucket, and their different ones.

    `kind` numbers the different segments by bucket, key and digest, as both rounds need the same order.
    """
    found, at, firsts = _light(chunk)
    asked = _asked(answers, found, n_buckets)
    columns: dict[str, list] = {n: [] for n in ("part", "start", "count", "doc", "place", "key", "digest")}
    for i, (segments, (keep, heavy)) in enumerate(zip(found, asked, strict=True)):
        kept = [Segments(*(getattr(segments, name)[keep] for name in ("start", "count", "key", "digest", "doc")))]
        if heavy.any():
            kept.append(segments.alone(heavy, chunk.values(i), chunk.units.length))
        for some in kept:
            columns["part"].append(np.full(len(some.start), i))
            for name in ("start", "count", "key", "digest"):
                columns[name].append(getattr(some, name))
            columns["doc"].append(some.doc + at[i])
            columns["place"].append(some.start - firsts[i][some.doc])
    out = {n: np.concatenate(v) if v else np.zeros(0, np.int64) for n, v in columns.items()}
    bucket = (out["key"].astype(np.uint64) % np.uint64(n_buckets)).astype(np.int64)
    order = np.lexsort((out["place"], chunk.ids[out["doc"]], out["digest"], out["key"], bucket))
    out = {n: v[order] for n, v in out.items()} | {"bucket": bucket[order]}
    fresh = np.ones(len(order), bool)
    same = [out[n][1:] == out[n][:-1] for n in ("digest", "key", "bucket", "count")]
    fresh[1:] = ~np.logical_and.reduce(same)
    out["kind"] = np.cumsum(fresh) - 1
    out["lead"] = np.flatnonzero(fresh)
    return out


def _send_segments(units: Units, n_buckets: int):
    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        out: dict[str, list] = {f.name: [] for f in _TO_BUCKET}
        if not table.num_rows:
            return _rows(out, _TO_BUCKET)
        chunk = Chunk(table, units)
        o = _occurrences(chunk, answers, n_buckets)
        lead = o["lead"]
        texts: list[bytes] = [b""] * len(lead)
        by_part = np.argsort(o["part"][lead], kind="stable")
        part_of = o["part"][lead][by_part]
        for i, (a, b) in enumerate(slices(chunk.offsets)):
            mine = by_part[np.searchsorted(part_of, i) : np.searchsorted(part_of, i, "right")]
            if len(mine):
                data = chunk.data[chunk.offsets[a] : chunk.offsets[b]]
                _, _, begin, end = units.read(data, chunk.offsets[a : b + 1] - chunk.offsets[a])
                start, last = o["start"][lead[mine]], o["start"][lead[mine]] + o["count"][lead[mine]] + units.length - 2
                raw = data.tobytes()
                for j, x, y in zip(mine.tolist(), begin[start].tolist(), end[last].tolist(), strict=True):
                    texts[j] = units.raw(raw, x, y)
        edges = np.searchsorted(o["bucket"][lead], np.arange(n_buckets + 1))
        for bucket in np.flatnonzero(np.diff(edges)).tolist():
            x, y = edges[bucket], edges[bucket + 1]
            some = lead[x:y]
            head = np.stack([o["count"][some], [len(t) for t in texts[x:y]], o["place"][some], chunk.ids[o["doc"][some]]]).astype(np.int64)
            for name, value in zip(out, (bucket, table.column("chunk")[0].as_py(), b"".join(texts[x:y]), _packed(head)), strict=True):
                out[name].append(value)
        return _rows(out, _TO_BUCKET)

    return run


def _packed(columns: np.ndarray) -> bytes:
    """Rows of int64, byte plane by byte plane, so that the shuffle's compression finds the zeros together."""
    return np.array(columns.shape, np.int64).tobytes() + np.ascontiguousarray(np.ascontiguousarray(columns).view(np.uint8).reshape(-1, 8).T).tobytes()


def _unpacked(body: bytes) -> np.ndarray:
    shape = np.frombuffer(body, np.int64, 2)
    planes = np.frombuffer(body, np.uint8, offset=16).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view(np.int64).reshape(shape)


def _find_first(units: Units):
    """Answers, per segment, runs of windows (offset, count) with the document and place of their first occurrence."""

    def run(table: pa.Table) -> pa.Table:
        heads = [_unpacked(x) for x in table.column("more").to_pylist()]
        count, size, place, doc = np.concatenate(heads, axis=1)
        data = np.frombuffer(b"".join(table.column("body").to_pylist()), np.uint8)
        # Chunks send the same passage over and over: each is looked at once, with its first occurrence.
        stop = np.cumsum(size)
        one, same = numbered(data, stop - size, stop)
        order = np.lexsort((place, doc, same))
        lead = order[np.searchsorted(same[order], np.arange(len(one)))] if len(one) else one
        short = data[spread((stop - size)[lead], size[lead])]
        one_doc, one_place = units.first_of(short, size[lead], count[lead], doc[lead], place[lead])
        seg = np.repeat(np.arange(len(count)), count)
        begin = np.concatenate(([0], np.cumsum(count)))
        offset = np.arange(len(seg)) - begin[seg]
        at = (np.cumsum(count[lead]) - count[lead])[same][seg] + offset
        first_doc, first_place = one_doc[at], one_place[at]
        base = first_place - offset
        fresh = np.ones(len(seg), bool)
        fresh[1:] = (seg[1:] != seg[:-1]) | (first_doc[1:] != first_doc[:-1]) | (units.ordered & (base[1:] != base[:-1]))
        at = np.flatnonzero(fresh)
        runs = np.stack([seg[at], offset[at], np.diff(np.append(at, len(seg))), first_doc[at], base[at]])
        if not units.ordered:
            runs[4] = 0
        cuts = np.searchsorted(seg[at], np.cumsum([h.shape[1] for h in heads]))
        shift = np.concatenate(([0], np.cumsum([h.shape[1] for h in heads])[:-1]))
        bodies = []
        for i, x in enumerate(np.split(np.arange(len(at)), cuts[:-1])):
            mine = runs[:, x].copy()
            mine[0] -= shift[i]
            bodies.append(_packed(mine))
        return _rows({"chunk": table.column("chunk").to_pylist(), "bucket": table.column("bucket").to_pylist(), "step": [2] * len(heads), "body": bodies}, _TO_CHUNK)

    return run


def _covered(chunk: Chunk, answers: pa.Table, n_buckets: int) -> Iterator[tuple[int, int, np.ndarray, tuple, np.ndarray]]:
    """For each part, which of its units lie in a window that occurs before."""
    units = chunk.units
    o = _occurrences(chunk, answers, n_buckets)
    edges = np.searchsorted(o["bucket"][o["lead"]], np.arange(n_buckets + 1))
    runs = [np.zeros((5, 0), np.int64)]
    for bucket, step, body in zip(*(answers.column(c).to_pylist() for c in ("bucket", "step", "body")), strict=True):
        if step == 2:
            some = _unpacked(body).copy()
            some[0] += edges[bucket]
            runs.append(some)
    kind, offset, count, doc, base = np.concatenate(runs, axis=1)
    order = np.argsort(kind, kind="stable")
    kind, offset, count, doc, base = (x[order] for x in (kind, offset, count, doc, base))
    per_kind = np.searchsorted(kind, np.arange(len(o["lead"]) + 1))
    n = np.diff(per_kind)[o["kind"]]
    which = np.repeat(np.arange(len(n)), n)
    run = np.arange(len(which)) - np.repeat(np.concatenate(([0], np.cumsum(n)[:-1])) if len(n) else n, n) + per_kind[o["kind"]][which]
    own = chunk.ids[o["doc"]][which]
    later = own > doc[run]
    if units.ordered:
        later |= (own == doc[run]) & (o["place"][which] > base[run])
    which, run = which[later], run[later]
    begin = o["start"][which] + offset[run]
    end = begin + count[run] + units.length - 1
    part = o["part"][which]
    order = np.argsort(part, kind="stable")
    part, begin, end = part[order], begin[order], end[order]
    for i, (a, b) in enumerate(slices(chunk.offsets)):
        data = chunk.data[chunk.offsets[a] : chunk.offsets[b]]
        read = units.read(data, chunk.offsets[a : b + 1] - chunk.offsets[a])
        some = slice(*np.searchsorted(part, [i, i + 1]))
        total = len(read[0])
        edge = np.bincount(begin[some], minlength=total + 1) - np.bincount(end[some], minlength=total + 1)
        yield a, b, data, read, np.cumsum(edge[:total]) > 0


def without_repeats(docs: DataFrame, units: Units, finish, schema: pa.Schema, shape: str) -> DataFrame:
    """What `finish` makes of each document and the units in windows that occur before.

    docs: doc_id (long, not null) and text. finish(data, read, covered, offsets) gives the columns of a part
    besides doc_id. Texts are shuffled once; the three rounds read the same shuffle.
    """
    ship(docs.sparkSession)
    size = docs.select(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0)).alias("n")).first()["n"]
    n_chunks = max(-(-size // CHUNK_BYTES), 1)
    n_buckets = n_chunks * BUCKETS_PER_CHUNK
    # Enough bytes of a key that few keys look like another; those that do are only compared in vain.
    width = min(max(-(-(int(size).bit_length() + 8) // 8), 4), 8)
    chunked = docs.select("doc_id", "text", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_chunks)).alias("chunk"))

    def finished(table: pa.Table, answers: pa.Table) -> pa.Table:
        chunk = Chunk(table, units)
        out = []
        for a, b, data, read, covered in _covered(chunk, answers, n_buckets):
            made = finish(data, read, covered, chunk.offsets[a : b + 1] - chunk.offsets[a])
            made = {"doc_id": pa.array(chunk.ids[a:b])} | made
            out.append(pa.table({f.name: pa.array(made[f.name], f.type) for f in schema}, schema=schema))
        return pa.concat_tables(out) if out else schema.empty_table()

    def by_chunk(df: DataFrame):
        return df.groupBy("chunk")

    keys = by_chunk(chunked).applyInArrow(_send_keys(units, n_buckets, width), _BUCKET_SHAPE)
    again = keys.groupBy("bucket").applyInArrow(_find_again(width), _CHUNK_SHAPE)
    segments = by_chunk(chunked).cogroup(by_chunk(again)).applyInArrow(_send_segments(units, n_buckets), _BUCKET_SHAPE)
    firsts = segments.groupBy("bucket").applyInArrow(_find_first(units), _CHUNK_SHAPE)
    return by_chunk(chunked).cogroup(by_chunk(again.union(firsts))).applyInArrow(finished, shape)
