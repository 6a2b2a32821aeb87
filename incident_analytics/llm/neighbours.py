"""Nearest neighbours by several shifted space-filling curves.

Vectors are projected to few dimensions and put in the order of a Hilbert curve, once for each of several curves that differ
in projection and shift, so that neighbours which one curve tears apart are close on another. Spark sorts each curve by
range into blocks of bounded size. A query is compared exactly with the blocks around its place on each curve; the
finds of all curves are merged and ranked.

How far to look is measured, not set: for a bounded number of queries the true neighbours are found by comparing
these with all vectors, and the window is the least that holds the wanted share of them on one curve at
least. On data with structure that is a short window at any size; on data without any it is a share of all vectors.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from incident_analytics.llm.shared import ship, stored

#: Neighbours of each query; curves; dimensions and bits per dimension of a curve.
NEIGHBOURS, CURVES, PROJECTED, BITS = 10, 4, 8, 7
#: Bytes of a block's vectors. A block has at least 64 vectors.
BLOCK_BYTES = 1 << 20
#: Vectors whose projections set the cells of the curves; queries that set the window; share of their
#: true neighbours that the window must hold.
SAMPLE, PROBES, RECALL = 1024, 128, 0.95


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of points (rows) with coordinates from 0 to 2 ** bits - 1; at most 63 bits in all.

    From the highest bit down, each coordinate's bit says how the cube below is mirrored or turned;
    undoing that and reading the bits of all coordinates in Gray code order gives the place.
    """
    axes = [np.ascontiguousarray(c).astype(np.int64) for c in cells.T]
    first = axes[0]
    for bit in range(bits - 1, 0, -1):
        below = (1 << bit) - 1
        for axis in axes:
            inverted = (axis >> bit & 1).astype(bool)
            swap = np.where(inverted, 0, (first ^ axis) & below)
            axis ^= swap if axis is not first else 0
            first ^= np.where(inverted, below, swap)
    for i in range(1, len(axes)):
        axes[i] ^= axes[i - 1]
    turned = np.zeros(len(cells), np.int64)
    for bit in range(bits - 1, 0, -1):
        turned ^= np.where(axes[-1] >> bit & 1, (1 << bit) - 1, 0)
    key = np.zeros(len(cells), np.int64)
    for bit in range(bits - 1, -1, -1):
        for axis in axes:
            key = key << 1 | ((axis ^ turned) >> bit & 1)
    return key


@dataclass
class Curves:
    """Projections of vectors by their dimension, and the cuts of the cells where the sample has that dimension."""

    cuts: dict[int, list[np.ndarray]]
    count: int

    @staticmethod
    def projection(dim: int, curve: int) -> tuple[np.ndarray, np.ndarray]:
        """Orthonormal directions and the shift of the curve; the same on every machine."""
        rng = np.random.default_rng([dim, curve])
        width = min(PROJECTED, dim)
        return np.linalg.qr(rng.normal(size=(dim, width)))[0], rng.uniform(0, 1, width)

    @classmethod
    def fitted(cls, sample: list[np.ndarray], count: int) -> Curves:
        by_dim: dict[int, list[np.ndarray]] = {}
        for x in sample:
            by_dim.setdefault(len(x), []).append(x)
        steps = np.arange(1, 1 << BITS) / (1 << BITS)
        cuts = {d: [np.quantile(np.stack(xs) @ cls.projection(d, c)[0], steps, axis=0) for c in range(count)] for d, xs in by_dim.items()}
        return cls(cuts, count)

    def keys(self, vectors: np.ndarray, curve: int) -> np.ndarray:
        """Places of vectors of one dimension on the curve."""
        dim = vectors.shape[1]
        directions, shift = self.projection(dim, curve)
        flat = vectors @ directions
        if dim in self.cuts:
            cuts = self.cuts[dim][curve]
            cells = np.stack([np.searchsorted(cuts[:, i], flat[:, i], "right") for i in range(flat.shape[1])], axis=1) / (1 << BITS)
        else:
            cells = 0.5 + np.arctan(flat) / np.pi
        # Twice as wide a grid has room for the shift.
        moved = np.floor((np.nan_to_num(cells) + shift) / 2 * (1 << BITS))
        return hilbert(np.clip(moved, 0, (1 << BITS) - 1).astype(np.int64), BITS)


def usable(vector: Column) -> Column:
    """Whether a vector takes part: not null, not empty, not zero, and all components finite numbers."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _per_block(dim: int, width: int) -> int:
    return max(64, BLOCK_BYTES // (dim * width))


_KEYS = "line long, key long, node long, asked boolean, vector binary"
_BLOCK = "line long, part int, first long, count int, cell int, nodes binary, vectors binary, asked array<int>"


def _on_curves(curves: Curves, kind: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The key of each vector on each curve. A line is a curve of one dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("embedding")
            ends, flat = np.asarray(column.offsets), np.asarray(column.values).astype(kind)
            size = np.diff(ends)
            for dim in np.unique(size).tolist():
                rows = np.flatnonzero(size == dim)
                matrix = flat[ends[rows][:, None] + np.arange(dim)]
                ids = batch.select(["node", "asked"]).take(pa.array(rows))
                binary = pa.array([x.tobytes() for x in matrix], pa.binary())
                for curve in range(curves.count):
                    line = pa.array(np.full(len(rows), dim * curves.count + curve, np.int64))
                    yield pa.RecordBatch.from_arrays(
                        [line, pa.array(curves.keys(matrix.astype(np.float64), curve)), ids.column("node"), ids.column("asked"), binary],
                        names=["line", "key", "node", "asked", "vector"],
                    )

    return run


def _packed(width: int, count: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Blocks of the sorted vectors of a partition; `first` is the place of the first one in the partition's part of the line."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        line, part, first = None, 0, 0
        nodes: list[int] = []
        vectors: list[bytes] = []
        asked: list[int] = []

        def block() -> pa.RecordBatch:
            cell = _per_block(line // count, width)
            row = [line, part, first, len(nodes), cell, np.array(nodes, np.int64).tobytes(), b"".join(vectors), asked]
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int32())]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names=[f.split(" ")[0] for f in _BLOCK.split(", ")])

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("part", "line", "node", "asked", "vector"))
            for at, of, node, wanted, vector in zip(*columns, strict=True):
                part = at
                if nodes and (of != line or len(nodes) == _per_block(line // count, width)):
                    yield block()
                    first = first + len(nodes) if of == line else 0
                    nodes, vectors, asked = [], [], []
                line = of
                if wanted:
                    asked.append(len(nodes))
                nodes.append(node)
                vectors.append(vector)
        if nodes:
            yield block()

    return run


def _nearest(queries: np.ndarray, vectors: np.ndarray, nodes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k nearest of `vectors` to each query, exactly: index of the query, node, distance. Ties go to smaller nodes."""
    q, x = queries.astype(np.float64), vectors.astype(np.float64)
    k = min(k, len(x))
    with np.errstate(over="ignore", invalid="ignore"):
        sizes = (x * x).sum(1)
        rough = (q * q).sum(1)[:, None] + sizes - 2 * (q @ x.T)
        # What the products can be off by; vectors nearer than that to the last place are measured too.
        slack = 1e-9 * ((q * q).sum(1) + sizes.max())
        last = np.partition(rough, k - 1, axis=1)[:, k - 1]
        maybe = ~(rough > (last + slack)[:, None])
        at, of = np.nonzero(maybe)
        exact = np.sqrt(((q[at] - x[of]) ** 2).sum(1))
    order = np.lexsort((nodes[of], exact, at))
    at, of, exact = at[order], of[order], exact[order]
    place = np.arange(len(at)) - np.searchsorted(at, at)
    kept = place < k
    return at[kept], nodes[of[kept]], exact[kept]


def _found(query: np.ndarray, node: np.ndarray, score: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(query), pa.array(node), pa.array(score)], names=["query", "node", "score"])


def _compared(kind: str, count: int, k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Queries of a block against the vectors of another one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("line", "wanted", "points", "nodes", "vectors"))
            for line, wanted, points, nodes, vectors in zip(*columns, strict=True):
                dim = line // count
                names = np.frombuffer(wanted, np.int64)
                at, node, score = _nearest(
                    np.frombuffer(points, kind).reshape(-1, dim), np.frombuffer(vectors, kind).reshape(-1, dim), np.frombuffer(nodes, np.int64), k
                )
                yield _found(names[at], node, score)

    return run


def _probed(probes: dict[int, tuple[np.ndarray, np.ndarray]], kind: str, count: int, k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The nearest vectors that a task reads to each probe; `probes` has nodes and vectors by dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for line, nodes, vectors in zip(*(batch.column(c).to_pylist() for c in ("line", "nodes", "vectors")), strict=True):
                dim = line // count
                if dim not in probes:
                    continue
                made = _nearest(probes[dim][1], np.frombuffer(vectors, kind).reshape(-1, dim), np.frombuffer(nodes, np.int64), k)
                at, node, score = (np.concatenate(x) for x in zip(best[dim], made, strict=True)) if dim in best else made
                order = np.lexsort((node, score, at))
                at, node, score = at[order], node[order], score[order]
                kept = np.arange(len(at)) - np.searchsorted(at, at) < k
                best[dim] = at[kept], node[kept], score[kept]
        for dim, (at, node, score) in best.items():
            yield _found(probes[dim][0][at], node, score)

    return run


def _located(wanted: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """line, node and place of the wanted nodes (sorted)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for line, start, nodes in zip(*(batch.column(c).to_pylist() for c in ("line", "start", "nodes")), strict=True):
                names = np.frombuffer(nodes, np.int64)
                hit = np.flatnonzero(np.isin(names, wanted))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(hit), line)), pa.array(names[hit]), pa.array(start + hit)], names=["line", "node", "place"])

    return run


def _sources(kind: str, count: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The queries of each block: line, cell size, places of the first and last one, their nodes and vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for line, cell, start, nodes, vectors, asked in zip(*(batch.column(c).to_pylist() for c in ("line", "cell", "start", "nodes", "vectors", "asked")), strict=True):
                points = np.frombuffer(vectors, kind).reshape(-1, line // count)[asked]
                out.append((line, cell, start + asked[0], start + asked[-1], np.frombuffer(nodes, np.int64)[asked].tobytes(), points.tobytes()))
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
            names = ["line", "cell", "low", "high", "wanted", "points"]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=names)

    return run


@dataclass
class Index:
    """Every usable vector on every curve.

    `classes`: node (its least id), ids (the least ones), embedding and asked, one row per different vector.
    `blocks`: the curves in pieces, with `start`, the place on the line, and `members`, the length of the line.
    """

    classes: DataFrame
    blocks: DataFrame
    kind: str
    curves: int
    k: int

    def window(self, probes: int = PROBES, recall: float = RECALL) -> int | None:
        """Least distance on a curve that holds `recall` of the true neighbours of the probes; None without queries."""
        draw = self.classes.filter("asked").orderBy(F.xxhash64("node"), "node").limit(probes).select("node", "embedding").collect()
        if not draw:
            return None
        by_dim: dict[int, list] = {}
        for row in draw:
            by_dim.setdefault(len(row["embedding"]), []).append(row)
        sent = {d: (np.array([r["node"] for r in rows], np.int64), np.array([r["embedding"] for r in rows], self.kind)) for d, rows in by_dim.items()}
        once = self.blocks.filter(F.col("line") % self.curves == 0)
        near = once.select("line", "nodes", "vectors").mapInArrow(_probed(sent, self.kind, self.curves, self.k + 1), "query long, node long, score double")
        best = near.filter("query <> node").withColumn("_rank", F.row_number().over(Window.partitionBy("query").orderBy("score", "node")))
        true = [(r["query"], r["node"]) for r in best.filter(F.col("_rank") <= self.k).collect()]
        if not true:
            return 0
        names = np.unique(np.array(true, np.int64))
        places = self.blocks.select("line", "start", "nodes").mapInArrow(_located(names), "line long, node long, place long").collect()
        at = {(r["node"], r["line"] % self.curves): r["place"] for r in places}
        gaps = np.sort([min(abs(at[q, c] - at[x, c]) for c in range(self.curves)) for q, x in true])
        return int(gaps[min(len(gaps), int(np.ceil(recall * len(gaps)))) - 1])

    def search(self, window: int) -> DataFrame:
        """query, node, score: the nearest classes in the windows of each query's class, itself included."""
        # Places are cut into cells; blocks meet in the first cell that a window and a block share.
        size = F.col("cell").cast("long")
        sources = self.blocks.filter(F.size("asked") > 0).select("line", "cell", "start", "nodes", "vectors", "asked")
        sources = sources.mapInArrow(_sources(self.kind, self.curves), "line long, cell int, low long, high long, wanted binary, points binary")
        low, high = F.greatest(F.col("low") - window, F.lit(0)), F.col("high") + window
        wide = sources.select("line", "wanted", "points", F.floor(low / size).alias("_from"), F.floor(high / size).alias("_to"))
        wide = wide.select("*", F.explode(F.sequence("_from", "_to")).alias("_cell"))
        last = F.floor((F.col("start") + F.col("count") - 1) / size)
        near = self.blocks.select(F.col("line").alias("_line"), "nodes", "vectors", F.floor(F.col("start") / size).alias("_begin"), last.alias("_end"))
        near = near.select("*", F.explode(F.sequence("_begin", "_end")).alias("_at"))
        met = wide.join(near, (wide.line == near._line) & (wide._cell == near._at)).filter(F.col("_cell") == F.greatest("_from", "_begin"))
        found = met.select("line", "wanted", "points", "nodes", "vectors").mapInArrow(
            _compared(self.kind, self.curves, self.k + 1), "query long, node long, score double"
        )
        merged = found.groupBy("query", "node").agg(F.min("score").alias("score"))
        order = Window.partitionBy("query").orderBy("score", "node")
        return merged.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= self.k + 1).drop("_rank")


def indexed(vectors: DataFrame, asked: Column, k: int = NEIGHBOURS, curves: int = CURVES) -> tuple[Index, DataFrame]:
    """The index of `vectors` (vec_id, embedding), and the queries among them: query_id and node of their class."""
    ship(vectors.sparkSession)
    kind = "f4" if dict(vectors.dtypes)["embedding"] == "array<float>" else "f8"
    points = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<float>" if kind == "f4" else "array<double>"))
    points = points.filter(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    points = points.withColumn("same", F.unhex(F.sha2(F.col("embedding").cast("string"), 256)))
    # Equal vectors are one class, so thousands of copies are one place on a curve. Of a class at most k + 1 ids can be an answer.
    ids = stored(points.groupBy("vec_id").agg(F.min("same").alias("same")))
    placed = ids.withColumn("_rank", F.row_number().over(Window.partitionBy("same").orderBy("vec_id"))).filter(F.col("_rank") <= k + 1)
    least = placed.groupBy("same").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    queries = ids.filter(asked)
    wanted = queries.select(F.col("same").alias("_same")).distinct()
    named = least.join(wanted, least.same == wanted._same, "left").select("same", "ids", F.col("_same").isNotNull().alias("asked"))
    whole = points.groupBy("same").agg(F.first("embedding").alias("embedding"))
    classes = stored(whole.join(named, "same").select(F.col("ids")[0].alias("node"), "ids", "same", "embedding", "asked"))

    sample = classes.orderBy(F.xxhash64("same"), "node").limit(SAMPLE).select("embedding").collect()
    fitted = Curves.fitted([np.array(r["embedding"], np.float64) for r in sample], curves)
    keyed = classes.select("node", "asked", "embedding").mapInArrow(_on_curves(fitted, kind), _KEYS)
    order = ["line", "key", "node"]
    ordered = keyed.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    width = np.dtype(kind).itemsize
    blocks = stored(ordered.select("part", "line", "node", "asked", "vector").mapInArrow(_packed(width, curves), _BLOCK))
    runs = blocks.groupBy("line", "part").agg(F.sum("count").alias("rows"))
    line = Window.partitionBy("line")
    before = F.sum("rows").over(line.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    # A row for each partition and line, so it may go to every task.
    starts = runs.select("line", "part", F.coalesce(before, F.lit(0)).alias("_before"), F.sum("rows").over(line).alias("members"))
    located = blocks.join(F.broadcast(starts), ["line", "part"]).withColumn("start", F.col("first") + F.col("_before"))
    named = queries.join(classes.select("same", "node"), "same").select(F.col("vec_id").alias("query_id"), "node")
    return Index(classes, located, kind, curves, k), named


def nearest(
    vectors: DataFrame, asked: Column, k: int = NEIGHBOURS, curves: int = CURVES, probes: int = PROBES, recall: float = RECALL
) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found for each row for which `asked` (on vec_id) holds.

    Score is the Euclidean distance in double precision; nearest first, ties to the smaller vec_id. A query is no neighbour
    of its own id. Rows with null vec_id, and vectors that are null, empty, zero or hold null or non-finite
    components, take no part; of different vectors with one vec_id the one with the least digest does. Vectors are compared with those
    of the same length only. No rows: no results.
    """
    index, queries = indexed(vectors, asked, k, curves)
    window = index.window(probes, recall)
    found = index.search(window or 0)
    members = index.classes.select(F.col("node").alias("_node"), F.explode("ids").alias("vec_id"))
    every = found.join(members, found.node == members._node).select(F.col("query").alias("_query"), "vec_id", "score")
    # Queries of one class share the k + 1 nearest ids.
    shared = Window.partitionBy("_query").orderBy("score", "vec_id")
    every = every.withColumn("_rank", F.row_number().over(shared)).filter(F.col("_rank") <= k + 1).drop("_rank")
    own = queries.join(every, queries.node == every._query).filter("query_id <> vec_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return own.select("query_id", rank.alias("rank"), "vec_id", "score").filter(F.col("rank") <= k)
