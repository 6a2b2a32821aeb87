"""Benchmark tables in the shape of the raw input files.

Whole tables: every row of a source table becomes one row of a file. Dates, times, money
and codes are rendered as the text that the files hold, so that reading them back takes
the parsing route.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from incident_analytics.functions.times import US_TIMESTAMP
from incident_analytics.operators.sets import union_eras
from incident_analytics.sources.readers import read_parquet, read_table
from incident_analytics.sources.schemas import TABLES, canonicalize, stored_columns
from incident_analytics.sources.scratch import scratch_path
from incident_analytics.sources.writers import Conversion, convert, write_csv

# Two codes share a label; their counts stay apart, as codes are counted.
LABELS = {"1-URGENT": "Urgent", "2-HIGH": "High", "3-MEDIUM": "High"}
NO_PRIORITY = "4-NOT SPECIFIED"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/{name}.parquet")


def us_text(timestamp: str) -> Column:
    return F.date_format(timestamp, US_TIMESTAMP)


def _place(custkey: str) -> tuple[Column, Column]:
    """Coordinate of a customer; two customers share one."""
    place = F.floor(F.col(custkey) / 2)
    lat = 33.5 + F.floor(place / 500) * 0.001
    lon = -118.9 + (place % 500) * 0.001
    return lat.alias("LAT"), lon.alias("LON")


def _eras(df: DataFrame, timestamp: str) -> list[DataFrame]:
    """The rows before 1998, and all others."""
    # Plain comparisons, so that both scans skip the row groups of the other era.
    limit, at = F.lit("1998-01-01").cast("timestamp_ntz"), F.col(timestamp)
    return [df.filter(at < limit), df.filter((at >= limit) | at.isNull())]


def order_eras(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Orders as incident files of two eras: dates, coordinate, and priority for descent."""
    descent = F.nullif(F.col("o_orderpriority"), F.lit(NO_PRIORITY))
    return [
        era.select(
            F.col("o_orderkey").alias("DR_NO"),
            us_text("o_orderdate").alias("Date Rptd"),
            us_text("o_orderdate").alias("DATE OCC"),
            descent.alias("Vict Descent"),
            *_place("o_custkey"),
        )
        for era in _eras(table(spark, sf_dir, "orders"), "o_orderdate")
    ]


def event_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as an incident file: HHMM time, and event type for premises."""
    hhmm = F.hour("ts") * 100 + F.minute("ts")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("DR_NO"),
        F.lpad(hhmm.cast("string"), 4, "0").alias("TIME OCC"),
        F.col("event_type").alias("Premis Desc"),
    )


def lineitem_eras(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Line items as incident files of two eras: supplier for area, quantity for weapon
    code. The position is unknown in part (a 0) where tax or discount is 0."""
    lat = F.when(F.col("l_tax") == 0, 0.0).otherwise(33.7 + (F.col("l_discount") + F.col("l_tax")))
    lon = F.when(F.col("l_discount") == 0, 0.0).otherwise(-118.6 + F.col("l_linenumber") * 0.05)
    return [
        era.select(
            F.col("l_orderkey").alias("DR_NO"),
            F.col("l_suppkey").alias("AREA "),
            F.col("l_quantity").cast("int").alias("Weapon Used Cd"),
            lat.alias("LAT"),
            lon.alias("LON"),
        )
        for era in _eras(table(spark, sf_dir, "lineitem"), "l_shipdate")
    ]


def revgeo_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as coordinates with a ZIP code; two ZIP codes for most coordinates."""
    zip_code = (F.col("c_custkey") + 90000).cast("string")
    return table(spark, sf_dir, "customer").select(
        *_place("c_custkey"), F.concat(zip_code, F.lit(" ")).alias("ZIPcode")
    )


def income_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as ZIP codes with a currency text; no number for type ECONOMY."""
    money = F.concat(F.lit("$"), F.format_number(F.floor("p_retailprice") * 50, 2))
    return table(spark, sf_dir, "part").select(
        (F.col("p_partkey") + 90000).cast("string").alias("Zip Code"),
        F.when(F.col("p_type") == "ECONOMY", "n/a")
        .otherwise(money)
        .alias("Estimated Median Income"),
    )


def station_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as stations."""
    return table(spark, sf_dir, "supplier").select(
        (-118.6 + F.col("s_nationkey") * 0.015).alias("X"),
        (33.7 + F.col("s_nationkey") * 0.02).alias("Y"),
        F.col("s_name").alias("DIVISION"),
        F.col("s_suppkey").alias("PREC"),
    )


def columns_in(name: str, df: DataFrame) -> list[str]:
    """Canonical columns that a raw file has."""
    headers = {c.strip() for c in df.columns}
    return [f.name for f in TABLES[name] if f.raw in headers]


def direct(name: str, *files: DataFrame) -> DataFrame:
    """The files in canonical shape, without a copy on disk."""
    return union_eras(*[canonicalize(df, TABLES[name], columns_in(name, df)) for df in files])


def through_csv(name: str, *files: DataFrame) -> DataFrame:
    """The files in canonical shape, written as CSV and read back."""
    spark, columns = files[0].sparkSession, columns_in(name, files[0])
    return read_table(spark, name, *_as_csv(name, files), columns=columns)


def through_parquet(name: str, *files: DataFrame) -> DataFrame:
    """The files in canonical shape, written as CSV, converted to Parquet and read back."""
    spark, columns = files[0].sparkSession, stored_columns(name, columns_in(name, files[0]))
    jobs = [
        Conversion(path, scratch_path(spark, f"{name}-parquet"), name, columns=tuple(columns))
        for path in _as_csv(name, files)
    ]
    convert(spark, jobs)
    targets = [job.target for job in jobs]
    return read_table(spark, name, *targets, fmt="parquet", columns=columns)


def _as_csv(name: str, files: tuple[DataFrame, ...]) -> list[str]:
    paths = [scratch_path(df.sparkSession, f"{name}-csv") for df in files]
    for df, path in zip(files, paths):
        write_csv(df, path)
    return paths
