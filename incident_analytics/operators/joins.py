"""Equality joins with a selectable strategy."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from incident_analytics.operators.salting import DEFAULT_SALTS, dealt_salt, free_name

STRATEGIES = ("auto", "broadcast", "merge", "shuffle_hash", "shuffle_replicate_nl")
HOWS = ("inner", "left_semi")

MAX_BROADCAST_BYTES = 64 * 1024 * 1024

_FIXED_WIDTH = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
_ROW_OVERHEAD = 16


def _bytes(df: DataFrame) -> DataFrame:
    width = F.lit(_ROW_OVERHEAD)
    for field in df.schema.fields:
        width = width + F.lit(8)
        if not isinstance(field.dataType, _FIXED_WIDTH):
            text = F.col(f"`{field.name}`").cast("string")
            width = width + F.coalesce(F.octet_length(text), F.lit(0))
    return df.agg(F.coalesce(F.sum(width.cast("bigint")), F.lit(0)).alias("bytes"))


def measured_bytes(*frames: DataFrame) -> int:
    """Bytes that the rows of the largest of ``frames`` take, measured: one job over all of them."""
    each = [_bytes(df) for df in frames]
    return reduce(DataFrame.union, each).agg(F.max("bytes").alias("bytes")).first()["bytes"]


def fits_broadcast(*frames: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """Whether each of ``frames`` was measured to be at most ``max_bytes``, in one job."""
    return measured_bytes(*frames) <= max_bytes


def join_with(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str] | Column,
    how: str = "inner",
    strategy: str = "auto",
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
    salts: int = DEFAULT_SALTS,
) -> DataFrame:
    """Join the big ``left`` with the lookup ``right`` on equal keys.

    ``on`` is one or more column names of both sides, or a condition. Null keys never
    match. All strategies give the same rows:

    ``auto``
        no hint: Spark broadcasts below ``spark.sql.autoBroadcastJoinThreshold`` and
        otherwise sorts and merges; AQE splits skewed keys.
    ``broadcast``
        broadcasts ``right`` if it measures at most ``max_broadcast_bytes`` (this runs one
        aggregation over it), else joins by ``merge``.
    ``merge``, ``shuffle_hash``
        Spark's hints of these names. Shuffle hash keeps a partition of ``right`` in memory.
    ``shuffle_replicate_nl``
        spreads the left rows of each key over ``salts`` tasks and replicates the right
        rows to them, see `salted_join`. There is no nested loop: comparing all pairs of
        rows grows with the product of the two sides. Needs column names.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown strategy {strategy!r}, not one of {STRATEGIES}")
    if how not in HOWS:
        raise ValueError(f"unknown join type {how!r}, not one of {HOWS}")
    if strategy == "shuffle_replicate_nl":
        if isinstance(on, Column):
            raise ValueError("shuffle_replicate_nl joins by column names, not by a condition")
        return salted_join(left, right, on, how, salts)
    if strategy == "broadcast" and not fits_broadcast(right, max_bytes=max_broadcast_bytes):
        strategy = "merge"
    if strategy != "auto":
        right = right.hint(strategy)
    return left.join(right, on if isinstance(on, (str, Column)) else list(on), how)


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    how: str = "inner",
    salts: int = DEFAULT_SALTS,
) -> DataFrame:
    """Shuffle join that spreads each key of ``left`` over ``salts`` tasks.

    For few keys that are known to be skewed: without the salt all rows of one key meet in one task. The
    right rows are replicated ``salts`` times; with one salt it is the plain merge join, which can use a
    partitioning that is there. `join_heavy_keys` finds the keys that need it and replicates for those only.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if salts == 1:
        return left.join(right.hint("merge"), keys, how)
    salt = free_name("salt", left, right)
    # Null keys match nothing. Dropped here, they do not travel as one hot key.
    for key in keys:
        left = left.filter(F.col(key).isNotNull())
        right = right.filter(F.col(key).isNotNull())
    spread = left.withColumn(salt, dealt_salt(left, salts))
    replicas = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    replicated = right.withColumn(salt, replicas)
    return spread.join(replicated.hint("merge"), [*keys, salt], how).drop(salt)
