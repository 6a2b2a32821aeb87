"""Coordinates and distances. All built-in expressions, so they stay in generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: mean radius of the earth in km.
EARTH_RADIUS_KM = 6371.0


def is_located(lat: Column, lon: Column) -> Column:
    """Whether a coordinate is known: not null, and neither part is the 0 of "unknown"."""
    return lat.isNotNull() & lon.isNotNull() & (lat != 0) & (lon != 0)


def is_degrees(lat: Column, lon: Column) -> Column:
    """Whether a coordinate is within the range of degrees."""
    return (F.abs(lat) <= 90) & (F.abs(lon) <= 180)


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in km of two points in degrees.

    Null if a part is null or out of the range of degrees.
    """
    sin_dlat = F.sin((F.radians(lat2) - F.radians(lat1)) / 2)
    sin_dlon = F.sin((F.radians(lon2) - F.radians(lon1)) / 2)
    chord = sin_dlat * sin_dlat + (
        F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * sin_dlon * sin_dlon
    )
    chord = F.least(chord, F.lit(1.0))  # rounding may pass 1 at opposite points
    distance = F.atan2(F.sqrt(chord), F.sqrt(1 - chord)) * (2 * EARTH_RADIUS_KM)
    return F.when(is_degrees(lat1, lon1) & is_degrees(lat2, lon2), distance)
