"""Lookup tables: one row per key, selection by membership, labels by table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from incident_analytics.operators.joins import join_with


def one_per_key(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """One row per key with the smallest non-null ``value``: the same on every run."""
    return df.groupBy(*keys).agg(F.min(value).alias(value))


def keep_matching(
    df: DataFrame, chosen: DataFrame, on: str | Sequence[str], strategy: str = "auto"
) -> DataFrame:
    """Rows of ``df`` whose key is among those of ``chosen``; repeated keys add no rows."""
    return join_with(df, chosen, on, "left_semi", strategy)


def decode_by_table(
    df: DataFrame, code: str, table: DataFrame, table_code: str, table_label: str, label: str
) -> DataFrame:
    """Add ``label``, looked up in a table of unique codes; unknown codes stay as they are."""
    found = table.select(
        F.col(table_code).alias("_code"), F.col(table_label).alias("_label")
    )
    joined = df.join(found, F.col(code) == F.col("_code"), "left")
    return joined.withColumn(label, F.coalesce("_label", code)).drop("_code", "_label")


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with the number of rows of each."""
    counted = df.groupBy(*keys).agg(F.count("*").alias("copies"))
    return counted.filter(F.col("copies") > 1)


def assert_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Return ``df`` if no key repeats, else fail. Runs a job.

    For lookup tables: a repeated key multiplies the rows that are joined with it.
    """
    example = repeated_keys(df, keys).first()
    if example is not None:
        raise ValueError(f"repeated key: {example.asDict()}")
    return df
