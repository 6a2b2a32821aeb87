"""Union of record eras."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def union_eras(first: DataFrame, *others: DataFrame) -> DataFrame:
    """All rows of all eras, by column name; duplicates stay. Eras must share a schema."""
    shape = {(f.name, f.dataType.simpleString()) for f in first.schema.fields}
    for era in others:
        difference = shape ^ {(f.name, f.dataType.simpleString()) for f in era.schema.fields}
        if difference:
            raise ValueError(f"eras differ in {sorted(difference)}")
    return reduce(DataFrame.unionByName, others, first)
