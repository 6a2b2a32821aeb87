"""Equality joins whose heavy keys, and only those, are spread over several tasks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from incident_analytics.operators.salting import dealt_salt, free_name

#: Share of all rows from which on a key is heavy, and the share that one of its pieces has at most.
HEAVY_SHARE = 0.01
#: Keys that the sketch follows for each key that can be heavy.
FOLLOWED = 100


def heavy_keys(df: DataFrame, on: str | Sequence[str], share: float = HEAVY_SHARE) -> DataFrame:
    """Heavy keys of ``df``: key_hash, pieces.

    A mergeable sketch of frequent items runs over the key columns alone; each task sends a few thousand
    entries. It finds every key of ``share`` of the rows or more (at most ``1 / share`` of them) and takes no other for one
    but on the border. ``pieces`` says over how many tasks a key has to go so that none gets more than ``share``. Null keys
    don't count. Hashes stand for keys, so keys of several columns and any type work; two keys of one
    hash would both be taken for heavy, which costs a few rows and changes no result.
    """
    if not 0 < share < 1:
        raise ValueError("share must be between 0 and 1")
    keys = [on] if isinstance(on, str) else list(on)
    most = int(1 / share) + 1
    known = df.select(*keys).dropna("any", subset=keys).select(F.xxhash64(*keys).alias("key_hash"))
    found = known.agg(
        F.count("*").alias("total"),
        F.call_function("approx_top_k", F.col("key_hash"), F.lit(most), F.lit(most * FOLLOWED)).alias("top"),
    )
    each = found.select("total", F.inline("top")).withColumnRenamed("item", "key_hash")
    pieces = F.ceil(F.col("count") / (F.col("total") * share)).cast("int")
    return each.filter(F.col("count") >= F.col("total") * share).select("key_hash", pieces.alias("pieces"))


def _with_pieces(df: DataFrame, keys: list[str], heavy: DataFrame, name: str) -> DataFrame:
    """``df`` without null keys, with the number of pieces of each key: 1 unless it is heavy."""
    key_hash, found = free_name("key_hash", df), free_name(f"{name}_found", df)
    marked = df.dropna("any", subset=keys).withColumn(key_hash, F.xxhash64(*keys))
    # At most 1 / share rows, so they may go to every task.
    few = F.broadcast(heavy.select(F.col("key_hash").alias(key_hash), F.col("pieces").alias(found)))
    joined = marked.join(few, key_hash, "left")
    return joined.withColumn(name, F.coalesce(found, F.lit(1))).drop(key_hash, found)


def join_heavy_keys(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    how: str = "inner",
    share: float = HEAVY_SHARE,
) -> DataFrame:
    """Shuffle join of ``left`` with ``right`` that no hot key of ``left`` slows down.

    A key of at least ``share`` of the left rows is spread over as many tasks as it takes to bring each below that, and
    its right rows are copied to these; all other keys join as usual, their right rows once. Rows are those of the plain
    join (``inner`` or ``left_semi``); null keys never match. The left key columns are read once more, for the sketch.
    """
    if how not in ("inner", "left_semi"):
        raise ValueError(f"unknown join type {how!r}")
    keys = [on] if isinstance(on, str) else list(on)
    heavy = heavy_keys(left, keys, share)
    salt = free_name("salt", left, right)
    pieces = free_name("pieces", left, right)
    spread = _with_pieces(left, keys, heavy, pieces)
    spread = spread.withColumn(salt, dealt_salt(left, F.col(pieces))).drop(pieces)
    copied = replicated(right, keys, heavy, salt)
    return spread.join(copied.hint("merge"), [*keys, salt], how).select(*left.columns, *([c for c in right.columns if c not in keys] if how == "inner" else []))


def replicated(right: DataFrame, on: str | Sequence[str], heavy: DataFrame, salt: str = "salt") -> DataFrame:
    """The right rows with a salt: those of a heavy key once for each of its pieces, all others once."""
    keys = [on] if isinstance(on, str) else list(on)
    pieces = free_name("pieces", right)
    counted = _with_pieces(right, keys, heavy, pieces)
    return counted.withColumn(salt, F.explode(F.sequence(F.lit(0), F.col(pieces) - 1))).drop(pieces)
