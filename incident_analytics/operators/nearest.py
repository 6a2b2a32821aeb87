"""Joins of coordinates that are near each other, but not equal to the last digit."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from incident_analytics.functions.geo import EARTH_RADIUS_KM, haversine_km, is_degrees

#: Parts of the radius that are searched one after the other.
RINGS = (1 / 16, 1.0)


class _Grid:
    """Cells that a circle of a radius around any point of a cell leaves at most to the neighbouring cells.

    Bands of latitude are as high as the radius. Each band has as many cells as its widest circle allows, fewer near
    the poles, and the last cell of a band is the neighbour of the first.
    """

    def __init__(self, radius_km: float):
        # A little wider, so that no rounding puts a point at the very radius out of reach.
        self.angle = math.degrees(radius_km / EARTH_RADIUS_KM) * (1 + 1e-9) + 1e-12
        self.bands = max(1, math.floor(180 / self.angle))
        self.height = 180 / self.bands

    def band(self, lat: Column) -> Column:
        return F.least(F.floor((lat + 90) / self.height), F.lit(self.bands - 1)).cast("long")

    def cells(self, band: Column) -> Column:
        """Number of cells of a band."""
        low, high = band * self.height - 90, (band + 1) * self.height - 90
        # Points of the neighbouring bands look for cells of this one too.
        farthest = F.greatest(F.abs(low), F.abs(high)) + self.height
        near_pole = farthest + self.angle >= 90
        width = F.degrees(F.asin(F.lit(math.sin(math.radians(self.angle))) / F.cos(F.radians(farthest))))
        return F.when(near_pole, 1).otherwise(F.greatest(F.floor(F.lit(360.0) / width), F.lit(1))).cast("long")

    def cell(self, lon: Column, band: Column) -> Column:
        return F.floor((lon + 180) / 360 * self.cells(band)).cast("long")


def _within(spots: DataFrame, places: DataFrame, radius_km: float) -> DataFrame:
    """Of each spot (lat, lon) the nearest place (place_lat, place_lon, kept) within the radius: lat, lon, best."""
    grid = _Grid(radius_km)
    own = grid.band(F.col("lat"))
    around = F.explode(F.filter(F.sequence(own - 1, own + 1), lambda b: (b >= 0) & (b < grid.bands)))
    looking = spots.select("lat", "lon", around.alias("band"))
    at, n = grid.cell(F.col("lon"), F.col("band")), grid.cells(F.col("band"))
    looking = looking.select("lat", "lon", "band", at.alias("at"), n.alias("n"))
    # Each cell once, so that a pair meets once.
    cells = F.explode(F.array_distinct(F.transform(F.sequence(F.col("at") - 1, F.col("at") + 1), lambda c: F.pmod(c, F.col("n")))))
    looking = looking.select("lat", "lon", "band", cells.alias("cell"))
    band = grid.band(F.col("place_lat"))
    placed = places.withColumn("place_band", band)
    cell = F.pmod(grid.cell(F.col("place_lon"), F.col("place_band")), grid.cells(F.col("place_band")))
    placed = placed.withColumn("place_cell", cell)
    same = (F.col("band") == F.col("place_band")) & (F.col("cell") == F.col("place_cell"))
    km = haversine_km(F.col("lat"), F.col("lon"), F.col("place_lat"), F.col("place_lon"))
    met = looking.join(placed, same).select("lat", "lon", "place_lat", "place_lon", "kept", km.alias("km")).filter(F.col("km") <= radius_km)
    return met.groupBy("lat", "lon").agg(F.min(F.struct("km", "place_lat", "place_lon", "kept")).alias("best"))


def join_nearest(
    left: DataFrame,
    right: DataFrame,
    keep: Sequence[str],
    radius_km: float,
    at: tuple[str, str] = ("lat", "lon"),
    right_at: tuple[str, str] = ("lat", "lon"),
    rings: Sequence[float] = RINGS,
) -> DataFrame:
    """``left`` with ``keep`` of the nearest ``right`` row within ``radius_km``, and its distance ``km``.

    For coordinates of different precision, which an equality join would lose. Left rows without a right row in reach, or
    without a valid coordinate, are left out. Of right rows at one place the least ``keep`` counts; of
    places at the same distance the one farther south, then west.

    Different left positions are looked up once each, so a position with a third of all rows is one. A position
    meets only the places of its cell of a grid and the cells around. Smaller circles (``rings``, parts of the radius) come
    first: in a crowded spot a position is done with the few places next to it.
    """
    if radius_km <= 0 or not rings or max(rings) != 1 or min(rings) <= 0:
        raise ValueError("radius and rings must be positive, and the last ring the whole radius")
    taken = {c.casefold() for c in left.columns} & {*(c.casefold() for c in keep), "km"}
    if taken:
        raise ValueError(f"both sides have columns named {sorted(taken)}")
    lat, lon, place_lat, place_lon = (F.col(f"`{c}`").cast("double") for c in (*at, *right_at))
    spots = left.select(lat.alias("lat"), lon.alias("lon")).filter(is_degrees(F.col("lat"), F.col("lon"))).distinct()
    kept = F.struct(*(F.col(f"`{c}`") for c in keep)).alias("kept")
    places = right.select(place_lat.alias("place_lat"), place_lon.alias("place_lon"), kept)
    places = places.filter(is_degrees(F.col("place_lat"), F.col("place_lon")))
    places = places.groupBy("place_lat", "place_lon").agg(F.min("kept").alias("kept"))
    found = []
    for ring in sorted(rings):
        found.append(_within(spots, places, radius_km * ring))
        spots = spots.join(found[-1].select("lat", "lon"), ["lat", "lon"], "left_anti")
    near = reduce(DataFrame.union, found)
    near = near.select(F.col("lat").alias("_lat"), F.col("lon").alias("_lon"), "best.km", "best.kept.*")
    joined = left.join(near, (lat == F.col("_lat")) & (lon == F.col("_lon")))
    return joined.select(*(left[f"`{c}`"] for c in left.columns), *(F.col(f"`{c}`") for c in keep), "km")
