"""Named views, SQL text and SQL functions."""

from __future__ import annotations

import re
from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession


def register(df: DataFrame, name: str) -> DataFrame:
    """Make ``df`` known to SQL text under ``name`` and return it."""
    df.createOrReplaceTempView(name)
    return df


def run_sql(
    spark: SparkSession,
    text: str,
    tables: Mapping[str, DataFrame] | None = None,
    values: Mapping[str, Any] | None = None,
) -> DataFrame:
    """Run SQL text over views, over ``tables`` named as ``{name}`` and values as ``:name``.

    Tables passed this way need no view name, so concurrent callers cannot collide.
    """
    return spark.sql(text, args=dict(values) if values else None, **(tables or {}))


def run_script(
    spark: SparkSession,
    text: str,
    tables: Mapping[str, DataFrame] | None = None,
    values: Mapping[str, Any] | None = None,
) -> DataFrame:
    """Run several SQL statements, ``BEGIN ... END``, and return the result of the last one.

    Tables and values are bound by name as in `run_sql`. Variables (``DECLARE``, ``SET``) and branches (``IF``) live
    in the script alone. The statements before the last one run at once.
    """
    if not re.fullmatch(r"(?is)\s*begin\b.*\bend\s*;?\s*", text):
        raise ValueError("a script is BEGIN ... END")
    return run_sql(spark, text, tables, values)


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def register_labels(spark: SparkSession, name: str, labels: Mapping[str, str]) -> None:
    """Create the temporary SQL function ``name(code)``: the label of a code.

    A code without a label is returned as it is. It is a SQL expression, not Python code.
    """
    if not re.fullmatch(r"[A-Za-z_]\w*", name):
        raise ValueError(f"not a function name: {name!r}")
    pairs = ", ".join(_literal(text) for pair in labels.items() for text in pair)
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(code STRING) RETURNS STRING "
        f"RETURN coalesce(try_element_at(map({pairs}), code), code)"
    )
