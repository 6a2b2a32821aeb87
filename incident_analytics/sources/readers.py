"""CSV and Parquet scans, and the typed readers of the four input tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from incident_analytics.operators.sets import union_eras
from incident_analytics.sources.schemas import TABLES, UNREADABLE, accounted, canonicalize, stored_text


def read_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType | str | None = None,
    sep: str = ",",
    multi_line: bool = False,
    empty_as_null: bool = False,
) -> DataFrame:
    """Read CSV files with a header line; never infers types.

    Quotes inside a quoted value are doubled (``"a ""b"", c"``), as is usual. A value without quotes
    that is empty is null; a quoted empty one is empty text, or null with ``empty_as_null``.
    ``multi_line`` reads quoted line breaks; such files can't be split between tasks.

    Without a ``schema`` every column is text under its header's name; only one header line
    is read to learn the names. The header of every file is checked against the schema, so
    a file with another order of columns is an error and is not read under wrong names.
    """
    reader = spark.read.option("header", True).option("sep", sep).option("enforceSchema", False)
    reader = reader.option("quote", '"').option("escape", '"').option("multiLine", multi_line)
    # Spark takes empty text for null where both are written alike; this text is in no file.
    reader = reader.option("nullValue", "" if empty_as_null else "\u0000")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(paths if isinstance(paths, str) else list(paths))


def read_parquet(
    spark: SparkSession, paths: str | Sequence[str], types: Mapping[str, str] | None = None
) -> DataFrame:
    """Read Parquet files or directories of one schema.

    ``types`` are those of columns that folders are named by: Spark would infer them and turn
    ``zip=01234`` into the number 1234.
    """
    listed = [paths] if isinstance(paths, str) else list(paths)
    found = spark.read.parquet(*listed)
    wanted = {name.casefold(): kind for name, kind in (types or {}).items()}
    fields = [
        f"`{f.name}` {wanted.get(f.name.casefold(), f.dataType.simpleString())}"
        for f in found.schema.fields
    ]
    if fields == [f"`{f.name}` {f.dataType.simpleString()}" for f in found.schema.fields]:
        return found
    return spark.read.schema(", ".join(fields)).parquet(*listed)


def read_table(
    spark: SparkSession,
    table: str,
    *paths: str,
    fmt: str = "csv",
    columns: Sequence[str] | None = None,
    sep: str = ",",
    multi_line: bool = False,
    account: Observation | None = None,
) -> DataFrame:
    """Read one of the four input tables in canonical shape.

    ``sep`` and ``multi_line`` are those of `read_csv`; empty values are null. Each path is one era: it may order
    its columns differently and is typed on its own before the eras are united. Only the ``columns`` asked for
    are parsed. ``account`` counts the values of them that are unreadable, see `accounted`.
    """
    if not paths:
        raise ValueError("no path given")
    if fmt not in ("csv", "parquet"):
        raise ValueError(f"unknown format {fmt!r}")
    eras = []
    for path in paths:
        if fmt == "csv":
            raw = read_csv(spark, path, sep=sep, multi_line=multi_line, empty_as_null=True)
        else:
            raw = read_parquet(spark, path, stored_text(table))
        eras.append(canonicalize(raw, TABLES[table], columns, marks=account is not None))
    # A typed copy lacks the raw-only columns that an era of text has, and its values are readable.
    shared = [c for c in eras[0].columns if all(c in era.columns for era in eras) and not c.startswith(UNREADABLE)]
    marks = list(dict.fromkeys(c for era in eras for c in era.columns if c.startswith(UNREADABLE)))
    united = union_eras(*[
        era.select(*shared, *(c if c in era.columns else F.lit(False).alias(c) for c in marks)) for era in eras
    ])
    return united if account is None else accounted(united, account)


def read_incidents(spark: SparkSession, *paths: str, **options) -> DataFrame:
    """Incident records of one or more eras; options as in `read_table`."""
    return read_table(spark, "incidents", *paths, **options)


def read_income(spark: SparkSession, *paths: str, **options) -> DataFrame:
    """Median income per ZIP code; options as in `read_table`."""
    return read_table(spark, "income", *paths, **options)


def read_revgeo(spark: SparkSession, *paths: str, **options) -> DataFrame:
    """ZIP code per coordinate; options as in `read_table`."""
    return read_table(spark, "revgeo", *paths, **options)


def read_stations(spark: SparkSession, *paths: str, **options) -> DataFrame:
    """Police stations with position and area number; options as in `read_table`."""
    return read_table(spark, "stations", *paths, **options)
