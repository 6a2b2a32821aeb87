"""Months with the most incidents from stored partial counts, for input that grows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from incident_analytics.operators.ranking import top_k_per_group
from incident_analytics.sources.increments import VERSION, current_versions, read_converted
from incident_analytics.sources.writers import Conversion

_STATE = f"year int, month int, n bigint, {VERSION} string"


def _read(spark: SparkSession, state: str) -> DataFrame:
    empty = spark.createDataFrame([], _STATE)
    empty.write.mode("ignore").partitionBy(VERSION).parquet(state)
    return spark.read.schema(_STATE).parquet(state)


def update_month_counts(spark: SparkSession, job: Conversion, manifest: str, state: str) -> int:
    """Count the files that were converted since the last update; returns their number.

    ``state`` holds incidents per year, month and file version, at most a few hundred rows a file. Counts of a version
    are replaced as a whole, so an update that was killed can be repeated.
    """
    done = _read(spark, state).select(VERSION).distinct()
    new = current_versions(spark, manifest).join(done, VERSION, "left_anti")
    fresh = new.count()
    if not fresh:
        return 0
    # Folders are read for the new versions only.
    rows = read_converted(spark, job, manifest, keep_version=True).join(F.broadcast(new), VERSION, "left_semi")
    months = rows.groupBy(VERSION, F.year("date_occ").alias("year"), F.month("date_occ").alias("month"))
    counted = months.agg(F.count("*").alias("n")).select("year", "month", "n", VERSION)
    writer = counted.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(VERSION).parquet(state)
    return fresh


def top_months_from_state(spark: SparkSession, manifest: str, state: str, k: int = 3) -> DataFrame:
    """`top_months` from the stored counts of the current file versions; no incident is read."""
    known = _read(spark, state).join(F.broadcast(current_versions(spark, manifest)), VERSION, "left_semi")
    months = known.groupBy("year", "month").agg(F.sum("n").alias("crime_total"))
    ranked = top_k_per_group(months, ["year"], [F.desc("crime_total"), F.asc("month")], k)
    return ranked.orderBy("year", "ranking")
