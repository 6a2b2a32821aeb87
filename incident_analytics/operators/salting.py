"""Dealing the rows of a hot key out to several tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_SALTS = 16


def _hashable(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_hashable(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _hashable(kind.elementType)
    return not isinstance(kind, (T.MapType, T.VariantType))


def dealt_salt(df: DataFrame, salts: int | Column = DEFAULT_SALTS) -> Column:
    """A salt from 0 to ``salts - 1`` for each row of ``df``; ``salts`` may differ by row.

    It depends on the content of the row and on the partition the row is read in. So even
    exact copies of one row spread, and a task that is run again deals out the same salts,
    which a random salt would not. Columns of types that can't be hashed are left out; if that
    leaves none, the place of the row in its partition decides.
    """
    hashed = [f"`{f.name}`" for f in df.schema.fields if _hashable(f.dataType)]
    content = F.xxhash64(*hashed) if hashed else F.monotonically_increasing_id()
    mixed = content + F.spark_partition_id()
    return F.pmod(mixed, salts if isinstance(salts, Column) else F.lit(salts)).cast("int")


def free_name(wanted: str, *frames: DataFrame) -> str:
    """A column name that none of the frames uses yet."""
    taken = {name.casefold() for df in frames for name in df.columns}
    while wanted in taken:
        wanted = f"_{wanted}"
    return wanted
