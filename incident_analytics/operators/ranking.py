"""Top-k per group and extreme distinct values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from incident_analytics.operators.salting import dealt_salt, free_name

_LIMIT_SETTING = "spark.sql.optimizer.windowGroupLimitThreshold"


def rank_in_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], rank: str = "ranking"
) -> DataFrame:
    """Number the rows of each group from 1. ``order`` should end in a unique key."""
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def top_k_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str = "ranking"
) -> DataFrame:
    """The first ``k`` rows of each group.

    A hot group does not arrive whole in one task: Spark cuts each group to ``k`` rows in
    every input partition before the shuffle (the plan shows two WindowGroupLimit steps).
    It does so for ``k`` up to its setting ``windowGroupLimitThreshold``; beyond it the groups are
    cut in salted parts first. The rows are the same.
    """
    if k > int(df.sparkSession.conf.get(_LIMIT_SETTING)):
        salt = free_name("salt", df)
        parts = df.withColumn(salt, dealt_salt(df))
        first = rank_in_group(parts, [*keys, salt], order, rank).filter(F.col(rank) <= k)
        df = first.drop(salt, rank)
    return rank_in_group(df, keys, order, rank).filter(F.col(rank) <= k)


def extreme_values(df: DataFrame, column: str, n: int = 3, side: str = "top") -> DataFrame:
    """The ``n`` highest or lowest distinct values of a column; null is no value.

    Each partition contributes at most ``n`` rows (TakeOrderedAndProject). Null sorts last
    and is dropped after the cut.
    """
    if side not in ("top", "bottom"):
        raise ValueError(f"side is 'top' or 'bottom', not {side!r}")
    by = F.desc_nulls_last(column) if side == "top" else F.asc_nulls_last(column)
    return df.select(column).distinct().orderBy(by).limit(n).filter(F.col(column).isNotNull())
