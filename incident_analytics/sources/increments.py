"""Conversion of a folder that grows: each run reads the files that are new.

A manifest table lists the files that were converted. Rows of a file go to a partition of their own, named by the
file's version (path, size and time of change), which a run replaces as a whole. A run that was killed can therefore be
repeated at any point: what it wrote is written again, and what is not in the manifest isn't read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from incident_analytics.sources.readers import read_csv, read_parquet
from incident_analytics.sources.schemas import TABLES, canonicalize, stored_columns, stored_text
from incident_analytics.sources.writers import Conversion

VERSION = "source_version"
_MANIFEST = "path string, bytes bigint, changed timestamp, source_version string, run bigint"


def _version() -> Column:
    """A name for the file that a row comes from, another one after each change."""
    changed = F.unix_micros("_metadata.file_modification_time")
    return F.md5(F.concat_ws("|", "_metadata.file_path", F.col("_metadata.file_size"), changed)).alias(VERSION)


def listed_files(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """The files of a folder and its subfolders, without reading them: path, bytes, changed, source_version."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(folder)
    told = {"file_path": "path", "file_size": "bytes", "file_modification_time": "changed"}
    return files.select(*(F.col(f"_metadata.{c}").alias(name) for c, name in told.items()), _version())


def read_manifest(spark: SparkSession, manifest: str) -> DataFrame:
    """The files converted so far; an empty table is made where there is none."""
    spark.createDataFrame([], _MANIFEST).write.mode("ignore").parquet(manifest)
    return spark.read.schema(_MANIFEST).parquet(manifest)


def convert_new(spark: SparkSession, job: Conversion, manifest: str, pattern: str = "*") -> list[str]:
    """Convert the files of the folder ``job.source`` that are new or changed since the last run; returns their paths.

    The copy is laid out by `VERSION` and then by ``job.partition_by``. Other files of the copy are not touched. One run at a
    time may write a manifest.
    """
    done = read_manifest(spark, manifest)
    fresh = listed_files(spark, job.source, pattern).join(done, VERSION, "left_anti")
    # As many rows as new files, which the driver has to name to the reader anyway.
    found = fresh.select("path", "bytes", "changed", VERSION).collect()
    if not found:
        return []
    paths = sorted(row["path"] for row in found)
    typed = job.table is not None
    raw = read_csv(spark, paths, sep=job.sep, multi_line=job.multi_line, empty_as_null=typed)
    named = raw.select("*", _version())
    if job.table is not None:
        named = canonicalize(named, TABLES[job.table], stored_columns(job.table, job.columns), also=(VERSION,))
    layout = [VERSION, *job.partition_by]
    if job.partition_by:
        named = named.hint("rebalance", *layout)
    writer = named.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*layout).parquet(job.target)
    last = done.agg(F.coalesce(F.max("run"), F.lit(0)).alias("run")).first()["run"]
    entries = [(*row, last + 1) for row in found]
    spark.createDataFrame(entries, _MANIFEST).coalesce(1).write.mode("append").parquet(manifest)
    return paths


def current_versions(spark: SparkSession, manifest: str) -> DataFrame:
    """The version of each file that was converted last: source_version."""
    latest = F.max_by(VERSION, F.struct("run", "changed")).alias(VERSION)
    return read_manifest(spark, manifest).groupBy("path").agg(latest).select(VERSION)


def read_converted(spark: SparkSession, job: Conversion, manifest: str, keep_version: bool = False) -> DataFrame:
    """The rows of the current version of each converted file.

    A semi join with the manifest on the column that folders are named by: Spark reads no other folders.
    """
    types = {VERSION: "string", **(stored_text(job.table) if job.table else {})}
    rows = read_parquet(spark, job.target, types)
    # A row per file, as the driver's list of files has it.
    kept = rows.join(F.broadcast(current_versions(spark, manifest)), VERSION, "left_semi")
    return kept if keep_version else kept.drop(VERSION)
