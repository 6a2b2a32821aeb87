"""CSV and Parquet sinks, and the CSV to Parquet conversion."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from incident_analytics.sources.readers import read_csv
from incident_analytics.sources.schemas import TABLES, accounted, canonicalize, stored_columns


def _one_line(df: DataFrame) -> DataFrame:
    """``df``, failing when it runs into text with a line break."""
    checked = {}
    for field in df.schema.fields:
        if isinstance(field.dataType, T.StringType):
            text = F.col(f"`{field.name}`")
            broken = F.raise_error(F.lit(f"line break in column {field.name}")).cast("string")
            checked[field.name] = F.when(text.rlike("[\\r\\n]"), broken).otherwise(text)
    return df.withColumns(checked) if checked else df


def write_csv(
    df: DataFrame,
    path: str,
    sep: str = ",",
    keep_blanks: bool = True,
    multi_line: bool = False,
) -> None:
    """Write CSV with a header, replacing what is at ``path``.

    What `read_csv` reads back is what was written: quotes are doubled, null is nothing, empty text is
    ``""``, outer blanks stay unless ``keep_blanks`` is off. Text with a line break is an error,
    as a reader that splits files would take it for two rows, unless ``multi_line`` says that it
    will be read so.
    """
    df = df if multi_line else _one_line(df)
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("sep", sep)
        .option("quote", '"')
        .option("escape", '"')
        .option("nullValue", "")
        .option("emptyValue", '""')
        .option("ignoreLeadingWhiteSpace", not keep_blanks)
        .option("ignoreTrailingWhiteSpace", not keep_blanks)
        .csv(path)
    )


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Write Parquet, replacing what is at ``path``.

    With ``partition_by`` the rows are rebalanced by those columns first: a small value
    goes to one file rather than one file per task, and AQE splits a value that holds a
    large part of all rows over several tasks.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


@dataclass(frozen=True)
class Conversion:
    """One CSV to Parquet job.

    ``table`` names one of the four input tables and gives the copy canonical names and
    types; without it all columns stay text under their own headers. ``partition_by`` names
    columns to lay the copy out by, such as ``rptd_year``. ``sep`` and ``multi_line`` are those of
    the source, see `read_csv`.
    """

    source: str
    target: str
    table: str | None = None
    sep: str = ","
    columns: tuple[str, ...] | None = None
    partition_by: tuple[str, ...] = ()
    multi_line: bool = False


def typed_source(
    spark: SparkSession, job: Conversion, paths: str | Sequence[str] | None = None, account: Observation | None = None
) -> DataFrame:
    """What a conversion writes, of its source or of some files of it; ``account`` is that of `read_table`."""
    typed = job.table is not None
    df = read_csv(
        spark, paths or job.source, sep=job.sep, multi_line=job.multi_line, empty_as_null=typed
    )
    if job.table is not None:
        wanted = stored_columns(job.table, job.columns)
        df = canonicalize(df, TABLES[job.table], wanted, marks=account is not None)
    return df if account is None else accounted(df, account)


def convert(spark: SparkSession, jobs: Iterable[Conversion]) -> list[dict[str, int]]:
    """Run the conversions; a job without ``partition_by`` is a map-only copy, no shuffle.

    Returns, per job, the number of rows and of unreadable values per column, counted as they were written.
    """
    counts = []
    for job in jobs:
        account = Observation()
        write_parquet(typed_source(spark, job, account=account), job.target, job.partition_by)
        counts.append(account.get)
    return counts
