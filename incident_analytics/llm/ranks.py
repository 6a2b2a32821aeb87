"""Positions in a sorted order, without a window over all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from incident_analytics.llm.shared import stored

#: Bits of the place of a row in its partition, as Spark's increasing ids have them.
_PLACE = 33


def _free(frame: DataFrame, *names: str) -> list[str]:
    taken, out = {c.casefold() for c in frame.columns}, []
    for name in names:
        while name in taken:
            name = f"_{name}"
        out.append(name)
    return out


def in_order(rows: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """`rows` sorted over all partitions, stored, with `part` and `place`, the place in the partition.

    Null keys come first. Rows with equal keys are dealt out by where they stand, so a key that a third of all
    rows share is no task of its own. `rows` should be a stored table: it is read twice.
    """
    (tie,) = _free(rows, "tie")
    marked = rows.withColumn(tie, F.monotonically_increasing_id())
    ordered = marked.repartitionByRange(*keys, tie).sortWithinPartitions(*keys, tie).drop(tie)
    at = F.monotonically_increasing_id()
    return stored(
        ordered.select("*", F.shiftright(at, _PLACE).alias("part"), at.bitwiseAND(F.lit((1 << _PLACE) - 1)).alias("place"))
    )


def ranked(rows: DataFrame, group: str, keys: Sequence[str | Column]) -> DataFrame:
    """`rows` with `position`, from 0 in each `group` in order of `keys`, and `members`, the group's rows.

    Only a row for each group and partition goes through the windows. A null group is one like any other.
    """
    placed = in_order(rows, [group, *keys])
    runs = placed.groupBy("part", F.col(group).alias("_group")).agg(F.min("place").alias("_first"), F.count("*").alias("_rows"))
    whole = Window.partitionBy("_group")
    before = F.sum("_rows").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = runs.select(
        F.col("part").alias("_part"), "_group", (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_rows").over(whole).alias("members"),
    )
    joined = placed.join(starts, (placed.part == starts._part) & placed[group].eqNullSafe(starts._group))
    return joined.select(*rows.columns, (F.col("place") + F.col("_shift")).alias("position"), "members")
