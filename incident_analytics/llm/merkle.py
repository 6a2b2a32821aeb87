"""A Merkle manifest of a dataset: a tree per group, a tree over the groups, proofs and their checks.

A tree is stored in aligned blocks of a fixed height; the roots of a layer's blocks are the leaves of the next
layer. Inside a block the nodes lie in van Emde Boas order: the block is split at half its height, the
top subtree comes first, then each bottom subtree, and each of these is laid out the same way. So a path
touches few neighbouring pieces whatever the size of a cache line or page, and the place of a node follows from
its depth and index by a few shifts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, partial
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from incident_analytics.llm.ranks import ranked
from incident_analytics.llm.shared import ship, stored

#: Levels of a block above its leaves; a block has 2 ** height leaves at most.
HEIGHT = 8
#: Bytes of a digest, and of an entry of a path: a digest after a byte that tells its side.
DIGEST, ENTRY = 32, 33
#: Sides of an entry: no sibling (the node is alone in its run), sibling right, sibling left.
ALONE, RIGHT, LEFT = 0, 1, 2


def leaf_digest(*fields: Column) -> Column:
    """Binary SHA-256 of fields: `-` for null, else the number of UTF-8 bytes, a colon and the value."""
    texts = [f.cast("string") for f in fields]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.unhex(F.sha2(F.concat(*parts), 256))


@cache
def _splits(levels: int) -> tuple[tuple[int, int, int], ...]:
    """For each depth of a perfect tree the depth of the top subtree's root, its size, and the size of a bottom subtree."""
    out = [(0, 0, 0)] * (levels + 1)

    def split(low: int, high: int) -> None:
        if high - low < 2:
            return
        middle = low + (high - low) // 2
        out[middle] = (low, (1 << (middle - low)) - 1, (1 << (high - middle)) - 1)
        split(low, middle)
        split(middle, high)

    split(0, levels + 1)
    return tuple(out)


def address(levels: int, depth: int, index: np.ndarray) -> np.ndarray:
    """Van Emde Boas places of the nodes `index` (from the left) at `depth` of a perfect tree of `levels` levels."""
    if depth == 0:
        return np.zeros(len(index), np.int64)
    root, top, bottom = _splits(levels)[depth]
    return address(levels, root, index >> (depth - root)) + top + (index & top) * bottom


@cache
def _places(levels: int) -> tuple[np.ndarray, ...]:
    return tuple(address(levels, d, np.arange(1 << d)) for d in range(levels + 1))


def node(*below: bytes) -> bytes:
    """The digest of a run of nodes, which are hashed as lower-case hexadecimal text."""
    return sha256("".join([x.hex() for x in below]).encode()).digest()


def build(leaves: list[bytes], levels: int) -> bytearray:
    """The nodes of a block in van Emde Boas order; places without a node are zero."""
    out = bytearray(DIGEST * ((2 << levels) - 1))
    row = leaves
    for depth in range(levels, -1, -1):
        if depth < levels:
            row = [node(*row[i : i + 2]) for i in range(0, len(row), 2)]
        for x, at in zip(row, (_places(levels)[depth][: len(row)] * DIGEST).tolist(), strict=True):
            out[at : at + DIGEST] = x
    return out


def path(nodes: bytes, levels: int, count: int, index: int) -> bytes:
    """Entries of the siblings of leaf `index`, from below, in a block of `count` leaves."""
    out = []
    for depth in range(levels, 0, -1):
        sibling = index ^ 1
        if sibling < count:
            at = int(_places(levels)[depth][sibling]) * DIGEST
            out.append(bytes([LEFT if index & 1 else RIGHT]) + nodes[at : at + DIGEST])
        else:
            out.append(bytes(ENTRY))
        index, count = index >> 1, (count + 1) >> 1
    return b"".join(out)


def fold(digest: bytes, entries: bytes) -> bytes:
    """The root that a leaf and the entries of its path give."""
    for at in range(0, len(entries), ENTRY):
        side, sibling = entries[at], entries[at + 1 : at + ENTRY]
        digest = node(digest) if side == ALONE else node(digest, sibling) if side == RIGHT else node(sibling, digest)
    return digest


def siblings(entries: bytes) -> str:
    """The siblings of a path as hexadecimal text."""
    return "".join([entries[at + 1 : at + ENTRY].hex() for at in range(0, len(entries), ENTRY) if entries[at] != ALONE])


@dataclass
class Tree:
    """Stored layers of one kind of trees, lowest first; each has the blocks of all trees that reach so high.

    A block row has tree, block, members (nodes of its layer), levels, count (its leaves), nodes, root and, in the lowest
    layer, keys and claims of its leaves (else null).
    """

    layers: list[DataFrame]
    height: int

    def roots(self) -> DataFrame:
        """tree and its root."""
        tops = [layer.filter(F.col("members") <= 1 << self.height).select("tree", "root") for layer in self.layers]
        return _union(tops)


@dataclass
class Manifest:
    """The trees of all groups, the tree over their roots, and the name of the leaves' key."""

    groups: Tree
    forest: Tree

    def proofs(self) -> DataFrame:
        """Of each leaf: key, leaf, subroot, root, path, proof, claim, folded.

        proof is the digest of the path's siblings, folded the root that the claimed digest and the path give.
        """
        tops = _proofs(self.forest, None).select(
            F.col("key").alias("tree"), F.col("leaf").alias("subroot"), F.col("subroot").alias("root"), "path"
        )
        return _proofs(self.groups, stored(tops))


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def _blocks(nodes: DataFrame, height: int, key: str | None = None) -> DataFrame:
    """The stored blocks of a layer, see `Tree`. `nodes` has tree, position, members, digest and, with `key`, that and claim."""
    fields = ["position", "digest", *([F.col(key).alias("key"), "claim"] if key else [])]
    grouped = nodes.groupBy("tree", F.shiftright("position", height).alias("block")).agg(
        F.first("members").alias("members"), F.sort_array(F.collect_list(F.struct(*fields))).alias("rows")
    )
    kind = dict(nodes.dtypes)[key] if key else "bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column("rows")
            ends, flat = rows.offsets.to_pylist(), rows.values
            digests = flat.field("digest").to_pylist()
            claims = flat.field("claim").to_pylist() if key else None
            made = {"levels": [], "count": [], "nodes": [], "root": [], "claims": []}
            for n, a, b in zip(batch.column("members").to_pylist(), ends, ends[1:], strict=False):
                levels = min(height, (n - 1).bit_length())
                block = bytes(build(digests[a:b], levels))
                made["levels"].append(levels)
                made["count"].append(b - a)
                made["nodes"].append(block)
                made["root"].append(block[:DIGEST])
                made["claims"].append(b"".join(claims[a:b]) if key else None)
            kept = [batch.column(c) for c in ("tree", "block", "members")]
            numbers = [pa.array(made[c], pa.int32()) for c in ("levels", "count")]
            digested = [pa.array(made[c], pa.binary()) for c in ("nodes", "root", "claims")]
            keys = pa.ListArray.from_arrays(rows.offsets, flat.field("key")) if key else pa.nulls(batch.num_rows, pa.list_(pa.int64()))
            names = ["tree", "block", "members", "levels", "count", "nodes", "root", "claims", "keys"]
            yield pa.RecordBatch.from_arrays([*kept, *numbers, *digested, keys], names=names)

    shape = "tree string, block long, members long, levels int, count int, nodes binary, root binary, claims binary"
    return stored(grouped.mapInArrow(run, f"{shape}, keys array<{kind}>"))


def _tree(leaves: DataFrame, key: str, height: int) -> Tree:
    """Trees over `leaves` (tree, `key`, digest, claim): per tree in order of key, then digest."""
    layer = _blocks(ranked(leaves, "tree", [key, "digest"]), height, key)
    layers = [layer]
    while layer.filter(F.col("members") > 1 << height).limit(1).count():
        above = layer.filter(F.col("members") > 1 << height).select(
            "tree", F.col("block").alias("position"), F.col("root").alias("digest"),
            F.shiftright(F.col("members") + ((1 << height) - 1), height).alias("members"),
        )
        layer = _blocks(above, height)
        layers.append(layer)
    return Tree(layers, height)


def manifest(leaves: DataFrame, group: str, key: str, height: int = HEIGHT) -> Manifest:
    """Trees over `leaves`, stored as blocks of `height` levels.

    `leaves` has `group` (string), `key`, digest and claim (both binary; claim is a digest to be checked against the
    tree, equal to digest where nothing is claimed). A tree per group has the leaves in order of key, null first; equal
    keys are ordered by digest, and equal rows are leaves of their own. In each level two neighbours
    become the digest of both, a lone last one the digest of itself, until one is left. The roots, in order of the
    group's UTF-8 bytes with null first, are the leaves of the last tree. No leaves: no trees.
    """
    ship(leaves.sparkSession)
    leaves = stored(leaves.select(F.col(group).alias("tree"), key, "digest", "claim"))
    groups = _tree(leaves, key, height)
    tops = groups.roots().select(F.lit("").alias("tree"), F.col("tree").alias("member"), F.col("root").alias("digest"), F.col("root").alias("claim"))
    return Manifest(groups, _tree(stored(tops), "member", height))


def _joined(layer: DataFrame, above: DataFrame | None) -> DataFrame:
    """Blocks with what stands above their root: subroot, top (the last root) and path."""
    if above is None:
        return layer.withColumns({"subroot": F.col("root"), "top": F.col("root"), "path": F.lit(b"")})
    up = above.withColumnsRenamed({"tree": "_tree", "block": "_block"})
    return layer.join(up, layer.tree.eqNullSafe(up._tree) & (layer.block == up._block)).drop("_tree", "_block")


def _proofs(tree: Tree, tops: DataFrame | None) -> DataFrame:
    """key, leaf, subroot, root, path, proof, claim, folded of each leaf. `tops` has tree, subroot, root and path above each tree."""
    if tops is not None:
        tops = tops.select("tree", F.lit(0).cast("long").alias("block"), "subroot", F.col("root").alias("top"), "path")
    above = None
    for layer in reversed(tree.layers[1:]):
        last = _joined(layer.filter(F.col("members") <= 1 << tree.height), tops)
        blocks = last if above is None else last.unionByName(_joined(layer, above))
        above = stored(blocks.mapInArrow(partial(_children, tree.height), "tree string, block long, subroot binary, top binary, path binary"))
    lowest = tree.layers[0]
    blocks = _joined(lowest.filter(F.col("members") <= 1 << tree.height), tops)
    blocks = blocks if above is None else blocks.unionByName(_joined(lowest, above))
    kind = dict(lowest.dtypes)["keys"].removeprefix("array<").removesuffix(">")
    shape = f"key {kind}, leaf binary, subroot binary, root binary, path binary, proof binary, claim binary, folded binary"
    return blocks.mapInArrow(_leaves, shape)


def _rows(batch: pa.RecordBatch, *names: str) -> Iterator[tuple]:
    return zip(*(batch.column(c).to_pylist() for c in names), strict=True)


def _children(height: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each block of the layer below: its number and the path above its root."""
    for batch in batches:
        for tree, block, levels, count, nodes, subroot, top, above in _rows(
            batch, "tree", "block", "levels", "count", "nodes", "subroot", "top", "path"
        ):
            paths = [path(nodes, levels, count, i) + above for i in range(count)]
            first = block << height
            yield pa.RecordBatch.from_arrays(
                [pa.array([tree] * count, pa.string()), pa.array(range(first, first + count), pa.int64()),
                 pa.array([subroot] * count, pa.binary()), pa.array([top] * count, pa.binary()), pa.array(paths, pa.binary())],
                names=["tree", "block", "subroot", "top", "path"],
            )


def _leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The proof of each leaf and what its claimed digest folds to."""
    for batch in batches:
        keys = batch.column("keys")
        starts = keys.offsets.to_pylist()
        for i, (levels, count, nodes, subroot, top, above, claims) in enumerate(
            _rows(batch, "levels", "count", "nodes", "subroot", "top", "path", "claims")
        ):
            at = (_places(levels)[levels][:count] * DIGEST).tolist()
            inside = [path(nodes, levels, count, j) for j in range(count)]
            said = [claims[j : j + DIGEST] for j in range(0, len(claims), DIGEST)]
            # Leaves of a block that fold to one root share what is above it.
            below = [fold(x, p) for x, p in zip(said, inside, strict=True)]
            over = {x: fold(x, above) for x in set(below)}
            rest = siblings(above)
            proofs = [sha256((siblings(p) + rest).encode()).digest() for p in inside]
            yield pa.RecordBatch.from_arrays(
                [keys.values[starts[i] : starts[i + 1]], pa.array([nodes[a : a + DIGEST] for a in at], pa.binary()),
                 pa.array([subroot] * count, pa.binary()), pa.array([top] * count, pa.binary()),
                 pa.array([p + above for p in inside], pa.binary()), pa.array(proofs, pa.binary()), pa.array(said, pa.binary()),
                 pa.array([over[x] for x in below], pa.binary())],
                names=["key", "leaf", "subroot", "root", "path", "proof", "claim", "folded"],
            )
