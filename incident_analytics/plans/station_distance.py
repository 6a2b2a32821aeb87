"""Firearm incidents and their mean distance to the responsible police station."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from incident_analytics.functions.geo import haversine_km, is_located
from incident_analytics.functions.sums import mean_of_units, to_units
from incident_analytics.functions.text import has_prefix
from incident_analytics.operators.heavy import HEAVY_SHARE, join_heavy_keys
from incident_analytics.operators.joins import MAX_BROADCAST_BYTES, fits_broadcast

ROUTES = ("auto", "broadcast", "repartition")


def located_firearm_incidents(incidents: DataFrame, prefix: str = "1") -> DataFrame:
    """Incidents with a weapon code of the prefix and a known position."""
    armed = incidents.filter(has_prefix(F.col("weapon_cd"), prefix))
    located = armed.filter(is_located(F.col("lat"), F.col("lon")))
    return located.select("area", "lat", "lon", "dr_no")


def station_distance(
    incidents: DataFrame,
    stations: DataFrame,
    route: str = "auto",
    prefix: str = "1",
    heavy_share: float = HEAVY_SHARE,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Per division: division, average_distance (km, two decimals), incidents_total.

    Most incidents first. An incident belongs to the station whose ``prec`` is its area.

    The mean is exact to the last place: distances are summed as whole micrometres, so all routes, runs and
    numbers of partitions give the same figures. The routes differ in the join:

    ``auto``
        plain join, Spark chooses.
    ``broadcast``
        map-side join: the stations go to every task, and an incident leaves its task as part of a sum.
        Stations that measure more than ``max_broadcast_bytes`` continue as ``repartition``.
    ``repartition``
        reduce-side join by area. Areas of more than ``heavy_share`` of the incidents are spread over
        several tasks, see `join_heavy_keys`.
    """
    if route not in ROUTES:
        raise ValueError(f"unknown route {route!r}, not one of {ROUTES}")
    placed = stations.filter(F.col("lat").isNotNull() & F.col("lon").isNotNull()).select(
        F.col("prec").alias("area"),
        F.col("lat").alias("station_lat"),
        F.col("lon").alias("station_lon"),
        "division",
    )
    facts = located_firearm_incidents(incidents, prefix)
    small = route == "broadcast" and fits_broadcast(placed, max_bytes=max_broadcast_bytes)
    if route == "auto" or small:
        joined = facts.join(F.broadcast(placed) if small else placed, "area")
    else:
        joined = join_heavy_keys(facts, placed, "area", share=heavy_share)
    km = haversine_km(F.col("lat"), F.col("lon"), F.col("station_lat"), F.col("station_lon"))
    # The distance as a column of its own: inside the sums Spark would work it out anew.
    measured = joined.select("division", "dr_no", to_units(km).alias("units"))
    per_division = measured.groupBy("division").agg(
        mean_of_units(F.col("units")).alias("average_distance"),
        F.count("dr_no").alias("incidents_total"),
    )
    return per_division.orderBy(F.desc("incidents_total"), "division")
