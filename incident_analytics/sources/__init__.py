"""Scans, sinks, schemas and the CSV to Parquet conversion."""

from incident_analytics.sources.increments import convert_new, current_versions, read_converted, read_manifest
from incident_analytics.sources.layout import in_box, write_bucketed, write_zordered
from incident_analytics.sources.readers import (
    read_csv,
    read_incidents,
    read_income,
    read_parquet,
    read_revgeo,
    read_stations,
    read_table,
)
from incident_analytics.sources.schemas import accounted, as_typed, canonicalize
from incident_analytics.sources.writers import Conversion, convert, write_csv, write_parquet

__all__ = [
    "Conversion",
    "accounted",
    "as_typed",
    "canonicalize",
    "convert",
    "convert_new",
    "current_versions",
    "in_box",
    "read_converted",
    "read_manifest",
    "read_csv",
    "read_incidents",
    "read_income",
    "read_parquet",
    "read_revgeo",
    "read_stations",
    "read_table",
    "write_bucketed",
    "write_csv",
    "write_parquet",
    "write_zordered",
]
