"""Layouts that let later reads skip: by place on a space-filling curve, and by buckets of a key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from incident_analytics.operators.salting import dealt_salt, free_name

#: Bits of each column on the curve.
CURVE_BITS = 20


def interleaved(columns: Sequence[Column], ranges: Sequence[tuple[float, float]], bits: int = CURVE_BITS) -> Column:
    """Place on the Z-order curve: the bits of all columns, scaled to their ranges, in turns. Null counts as the least."""
    if len(columns) * bits > 63:
        raise ValueError("the bits of all columns must fit into 63")
    key = F.lit(0).cast("bigint")
    top = (1 << bits) - 1
    for i, (column, (low, high)) in enumerate(zip(columns, ranges, strict=True)):
        width = (high - low) or 1.0
        scaled = F.floor((column.cast("double") - low) / width * top)
        cell = F.greatest(F.least(F.coalesce(scaled, F.lit(0)), F.lit(top)), F.lit(0)).cast("bigint")
        for b in range(bits):
            bit = F.shiftright(cell, b).bitwiseAND(F.lit(1))
            key = key.bitwiseOR(F.shiftleft(bit, b * len(columns) + i))
    return key


def write_zordered(df: DataFrame, path: str, by: Sequence[str], files: int, bloom: Sequence[str] = ()) -> None:
    """Write Parquet so that a range of any of the numbers ``by`` touches few files and row groups, replacing ``path``.

    One pass finds the ranges of the columns, one deals the rows to ``files`` files by their place on the curve; rows at one
    place may go to several files, so no place is one task. Codes named by ``bloom`` get a Bloom
    filter per row group, for reads that look for one code.
    """
    ends = df.agg(*(f(F.col(f"`{c}`").cast("double")).alias(f"{n}_{i}") for i, c in enumerate(by) for n, f in (("low", F.min), ("high", F.max)))).first()
    ranges = [(ends[f"low_{i}"] or 0.0, ends[f"high_{i}"] or 0.0) for i in range(len(by))]
    place, salt = free_name("place", df), free_name("salt", df)
    keyed = df.withColumns({place: interleaved([F.col(f"`{c}`") for c in by], ranges), salt: dealt_salt(df, 1 << 16)})
    ordered = keyed.repartitionByRange(files, place, salt).sortWithinPartitions(place).drop(place, salt)
    writer = ordered.write.mode("overwrite")
    for column in bloom:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    writer.parquet(path)


def in_box(df: DataFrame, box: dict[str, tuple[float, float]]) -> DataFrame:
    """Rows whose named columns lie in the given ranges, ends included; the scan gets the conditions."""
    inside = [(F.col(f"`{c}`") >= low) & (F.col(f"`{c}`") <= high) for c, (low, high) in box.items()]
    return df.filter(reduce(Column.__and__, inside))


def write_bucketed(df: DataFrame, table: str, keys: Sequence[str], buckets: int, path: str) -> DataFrame:
    """Write ``df`` as a table of the session's catalogue, in ``buckets`` buckets of its keys; returns the table.

    Two tables with the same buckets of their join keys are joined, and a table is grouped by its keys, without
    shuffling them again: worth it for tables that are joined more than once.
    """
    # One task per bucket writes one file each; a hot key fills its bucket either way.
    dealt = df.repartition(buckets, *keys)
    dealt.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(table)
    return df.sparkSession.table(table)
