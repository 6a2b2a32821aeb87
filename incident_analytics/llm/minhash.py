"""Near-duplicate documents: min-max hashing, banding, and confirmation on whole shingle sets.

Equal sets are one class, so thousands of copies travel once. Classes that share a band are candidates, but the pairs
of a band are never made: a group of edited copies of one text shares bands all over, though few of its
pairs are alike enough. First each class is compared with one class of each of its bands, the one that shares
most bands with others, as the original of many copies does. Bands whose classes are then in one component are
done. In the others classes meet by their rarest shingles: two sets with a likeness of 0.8 share one of
their rarest fifth, and at places that leave room for the rest. An edited copy's rarest shingles are its own edits, so
it meets hardly anybody in vain. This second search is exact: it loses no pair of the classes it is given.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from incident_analytics.llm.arrays import LOWER, Rolling, Words, by_text, mix
from incident_analytics.llm.components import components
from incident_analytics.llm.shared import ship, stored

#: Words of a shingle; least similarity in per cent.
SHINGLE, LIKENESS = 4, 80
#: Bands of two permutations each; with minimum and maximum a band holds four values. A pair of
#: similarity 0.8 shares no band with probability (1 - 0.8 ** 4) ** 32, below 1e-7.
BANDS = 32
#: Longs of a sketch, which holds a byte of each of the 4 * BANDS values.
SKETCH = 4 * BANDS // 8

_A = mix(np.arange(2 * BANDS, dtype=np.uint64) + np.uint64(1 << 40)) | np.uint64(1)
_B = mix(np.arange(2 * BANDS, dtype=np.uint64) + np.uint64(1 << 41))


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts, and where those of each begin (and end)."""
    words = Words(LOWER[data], offsets)
    rolling = Rolling(words.hashes())
    count = words.count
    starts = words.first[:-1]
    at = np.arange(len(words))
    whole = at + k <= np.repeat(words.first[1:], count)
    few = np.flatnonzero((count > 0) & (count < k))
    begin = np.concatenate((at[whole], starts[few]))
    end = np.concatenate((at[whole] + k, starts[few] + count[few]))
    text = np.concatenate((words.text[whole], few))
    hashes = rolling.run(begin, end)
    order = np.argsort(hashes)
    order = order[np.argsort(text[order], kind="stable")]
    hashes, text = hashes[order], text[order]
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    hashes, text = hashes[fresh], text[fresh]
    return hashes, np.searchsorted(text, np.arange(len(offsets)))


def _class_of(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two digests of each set; the first names its class."""
    out = []
    for salt in (1, 2):
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(hashes ^ mix(np.array([salt], np.uint64))), dtype=np.uint64)))
        out.append(mix(total[first[1:]] - total[first[:-1]] + np.diff(first).astype(np.uint64)).view(np.int64))
    return out[0], out[1]


def signatures(data: np.ndarray, offsets: np.ndarray, k: int = SHINGLE) -> dict[str, object]:
    """Set size, class digests, sketch and band keys of each text; an empty set has no class and no bands."""
    hashes, first = shingle_sets(data, offsets, k)
    size = np.diff(first)
    full = np.flatnonzero(size)
    bands = np.zeros((len(full), BANDS), np.uint64)
    sketch = np.zeros((len(full), 4 * BANDS), np.uint8)
    if len(full):
        at = first[:-1][full]
        value = np.empty_like(hashes)
        for i in range(2 * BANDS):
            np.multiply(hashes, _A[i], out=value)
            value += _B[i]
            for j, end in enumerate((np.minimum.reduceat(value, at), np.maximum.reduceat(value, at))):
                bands[:, i // 2] = mix(bands[:, i // 2] ^ end)
                sketch[:, 2 * i + j] = mix(end) & np.uint64(255)
        bands = mix(bands + np.arange(BANDS, dtype=np.uint64))
    ends = np.zeros(len(size) + 1, np.int32)
    np.cumsum(np.where(size > 0, BANDS, 0), out=ends[1:])
    one, two = _class_of(hashes, first)
    empty = size == 0
    return {
        "n_shingles": size,
        "node": pa.array(one, mask=empty), "check": pa.array(two, mask=empty),
        "sketch": pa.ListArray.from_arrays(pa.array(ends // (BANDS // SKETCH)), pa.array(sketch.ravel().view(np.int64))),
        "bands": pa.ListArray.from_arrays(pa.array(ends), pa.array(bands.ravel().view(np.int64))),
    }


def _sets(docs: DataFrame, k: int) -> DataFrame:
    """Class digests and the sorted shingle hashes of each row."""

    def rows(data: np.ndarray, offsets: np.ndarray) -> dict[str, object]:
        hashes, first = shingle_sets(data, offsets, k)
        one, two = _class_of(hashes, first)
        return {"_one": one, "_two": two, "shingles": pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(hashes.view(np.int64)))}

    schema = pa.schema([("_one", pa.int64()), ("_two", pa.int64()), ("shingles", pa.list_(pa.int64()))])
    return docs.select("text").mapInArrow(by_text(rows, schema), "_one long, _two long, shingles array<long>")


def _links(pairs: DataFrame, sets: DataFrame, likeness: int) -> DataFrame:
    """Pairs (a, b) whose whole shingle sets are alike; each set goes to its pairs."""
    with_a = pairs.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("x")), "a")
    with_b = with_a.join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("y")), "b")
    common = with_b.select("a", "b", (F.size("x") + F.size("y")).alias("both"), F.size(F.array_intersect("x", "y")).alias("common"))
    return common.filter(F.lit(100) * F.col("common") >= likeness * (F.col("both") - F.col("common"))).select("a", "b")


def _differing(likeness: int) -> Column:
    """Whether two sketches differ in more bytes than alike sets do, but for six standard deviations."""
    values, agree = 4 * BANDS, likeness / 100 + (1 - likeness / 100) / 256
    most = values * (1 - agree) + 6 * (values * agree * (1 - agree)) ** 0.5
    differ = F.lit(0)
    for i in range(SKETCH):
        odd = F.col("sketch")[i].bitwiseXOR(F.col("_sketch")[i])
        # The lowest bit of each byte tells whether any of its bits is set.
        for step in (4, 2, 1):
            odd = odd.bitwiseOR(F.shiftrightunsigned(odd, step))
        differ = differ + F.bit_count(odd.bitwiseAND(F.lit(0x0101010101010101)))
    return differ > F.lit(most)


def _with_pivots(bands: DataFrame, likeness: int) -> DataFrame:
    """Pairs of each band's pivot with the band's other classes of a possible size, whose sketches don't contradict."""
    pivots = bands.groupBy("band").agg(F.max(F.struct("degree", "id", "size", "sketch")).alias("pivot"))
    one = pivots.select("band", *(F.col(f"pivot.{c}").alias(f"_{c}") for c in ("id", "size", "sketch")))
    met = bands.join(one, "band").filter("id <> _id").filter(f"100 * least(size, _size) >= {likeness} * greatest(size, _size)")
    pairs = met.filter(~_differing(likeness)).select(F.least("id", "_id").alias("a"), F.greatest("id", "_id").alias("b"))
    return pairs.distinct()


def prefix_pairs(sets: DataFrame, likeness: int = LIKENESS) -> DataFrame:
    """Pairs (a, b) of `sets` (id, label, shingles) of different labels, among them all with the likeness.

    The shingles of each set are put in one order, the rarest first. Sets x and y, y not larger, with the likeness t share
    t / (1 + t) of both sizes together, so a shared shingle is among the first |x| - t |x| + 1 of x and the first
    |y| - 2t / (1 + t) |y| + 1 of y, and what follows in both sets is enough for the rest.
    """
    named = sets.select("id", "label", F.size("shingles").alias("size"), F.explode("shingles").alias("shingle"))
    # A shingle of one set alone meets nobody; its place counts.
    counts = named.groupBy("shingle").agg(F.count("*").alias("times")).filter("times > 1")
    shared = named.join(counts, "shingle").groupBy("id", "label", "size").agg(F.sort_array(F.collect_list(F.struct("times", "shingle"))).alias("order"))
    shared = shared.withColumn("alone", F.col("size") - F.size("order"))
    t = likeness
    probes = F.col("size") - F.ceil(F.col("size") * t / F.lit(100)) + 1 - F.col("alone")
    rows = shared.filter(probes > 0).select(
        "id", "label", "size", "alone", F.posexplode(F.slice("order", 1, F.least(probes, F.size("order")).cast("int"))).alias("at", "entry")
    )
    rows = rows.select("id", "label", "size", (F.col("alone") + F.col("at")).cast("int").alias("at"), F.col("entry.shingle").alias("shingle"))
    y = rows.select("shingle", *(F.col(c).alias(f"_{c}") for c in ("id", "label", "size", "at")))
    y = y.filter(f"_at <= _size - ceil(_size * {2 * t} / {100 + t}.0)")
    smaller = (F.col("_size") < F.col("size")) | ((F.col("_size") == F.col("size")) & (F.col("_id") < F.col("id")))
    possible = F.expr(f"100 * _size >= {t} * size")
    room = F.least(F.col("size") - F.col("at"), F.col("_size") - F.col("_at"))
    enough = F.expr(f"{100 + t}") * room >= t * (F.col("size") + F.col("_size"))
    met = rows.join(y, (rows.shingle == y.shingle) & smaller & possible & (F.col("label") != F.col("_label")) & enough)
    return met.select(F.least("id", "_id").alias("a"), F.greatest("id", "_id").alias("b")).distinct()


def near_duplicates(docs: DataFrame, k: int = SHINGLE, likeness: int = LIKENESS) -> DataFrame:
    """doc_id, n_shingles and component_id of each row.

    A row without words has no shingle and is its own component; rows that share a doc_id share its
    component if their texts do; component_id is null only if all doc_ids of a component are.
    """
    ship(docs.sparkSession)
    docs = docs.selectExpr("cast(doc_id as long) doc_id", "text")
    fields = [("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("node", pa.int64()), ("check", pa.int64()), ("sketch", pa.list_(pa.int64())), ("bands", pa.list_(pa.int64()))]
    shape = "doc_id long, n_shingles long, node long, check long, sketch array<long>, bands array<long>"
    rows = stored(docs.mapInArrow(by_text(lambda d, o: signatures(d, o, k), pa.schema(fields)), shape))
    filled = rows.filter("node is not null")
    grouped = filled.groupBy("node", "check").agg(
        F.min("doc_id").alias("least"), F.max("n_shingles").alias("size"), F.min("sketch").alias("sketch"), F.min("bands").alias("bands")
    )
    # Both digests tell classes apart; a number stands for them from here on.
    classes = stored(grouped.withColumn("id", F.monotonically_increasing_id()))
    members = classes.select("id", F.explode("bands").alias("band"))
    shared = members.groupBy("band").agg(F.count("*").alias("n")).filter("n > 1")
    in_bands = stored(members.join(shared, "band"))
    degree = in_bands.groupBy("id").agg(F.sum("n").alias("degree")).withColumnRenamed("id", "_id")
    busy = stored(classes.join(degree, classes.id == degree._id).select("id", "node", "check", "least", "size", "sketch", "degree"))
    # One text of each of these classes: ids first, as rows may share one.
    wanted = busy.select(F.col("least").alias("_least")).distinct()
    texts = docs.join(wanted.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("_least")), "left_semi")
    found = _sets(texts, k).join(busy.select("id", "node", "check"), (F.col("_one") == F.col("node")) & (F.col("_two") == F.col("check")))
    sets = stored(found.groupBy("id").agg(F.first("shingles").alias("shingles")))

    named = in_bands.select("band", "id").join(busy.select("id", "degree", "size", "sketch"), "id")
    links = stored(_links(stored(_with_pivots(named, likeness)), sets, likeness))
    label = F.coalesce("label", "id").alias("label")
    labels = in_bands.select("band", "id").join(components(links).withColumnRenamed("node", "id"), "id", "left").select("band", "id", label)
    labels = stored(labels)
    # Bands of several components are open; pairs of one component need no comparison.
    open_ = labels.groupBy("band").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high").select("band")
    left = labels.join(open_, "band", "left_semi").select("id", "label").distinct()
    pairs = stored(prefix_pairs(sets.join(left, "id"), likeness))
    links = links.union(_links(pairs, sets, likeness))
    known = classes.join(components(links).withColumnRenamed("node", "_id"), F.col("id") == F.col("_id"), "left")
    known = known.select("node", "check", "least", F.coalesce("label", "id").alias("label"))
    least = known.groupBy("label").agg(F.min("least").alias("component_id"))
    of_class = known.join(least, "label").select(F.col("node").alias("_node"), F.col("check").alias("_check"), "component_id")
    joined = rows.select("doc_id", "n_shingles", "node", "check").join(of_class, (F.col("node") == F.col("_node")) & (F.col("check") == F.col("_check")), "left")
    own = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return joined.select("doc_id", "n_shingles", own.alias("component_id"))
