"""Victims by descent in the ZIP codes with the highest or lowest incomes."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from incident_analytics.functions.text import DESCENT_LABELS, decode
from incident_analytics.operators.joins import MAX_BROADCAST_BYTES, fits_broadcast, join_with
from incident_analytics.operators.lookups import one_per_key
from incident_analytics.operators.ranking import extreme_values

SIDES = ("top", "bottom", "both")


def income_profile(
    incidents: DataFrame,
    revgeo: DataFrame,
    income: DataFrame,
    year: int = 2015,
    strategy: str = "auto",
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Victims reported in ``year`` by ZIP code, its income and descent code.

    Small next to the incidents: ZIP codes times descents. Both sides of the report can be
    taken from it by `victims_of_side`.

    Every strategy counts per coordinate and descent before it joins: a coordinate with a large
    part of all rows shrinks to a few in the tasks that read it, and no join shuffles incidents.
    ``broadcast`` measures the lookups in one job and continues as ``merge`` if one is above
    ``max_broadcast_bytes``; that changes the plan only. ``shuffle_replicate_nl`` has no hot key
    left to spread, so it replicates nothing.
    """
    zips = one_per_key(revgeo, ["lat", "lon"], "zip")
    if strategy == "broadcast":
        small = fits_broadcast(zips, income, max_bytes=max_broadcast_bytes)
        zips, income = (F.broadcast(zips), F.broadcast(income)) if small else (zips, income)
        strategy = "auto" if small else "merge"
    known = incidents.filter((F.col("rptd_year") == year) & F.col("vict_descent").isNotNull())
    victims = known.groupBy("lat", "lon", "vict_descent").agg(F.count("*").alias("victims"))
    placed = join_with(victims, zips, ["lat", "lon"], strategy=strategy, salts=1)
    per_zip = placed.groupBy("zip", "vict_descent").agg(F.sum("victims").alias("victims"))
    # Always true. It keeps the sum in every use of the profile, so that all uses have the
    # same plan up to here and Spark computes it once (ReusedExchange).
    per_zip = per_zip.filter(F.col("victims") > 0)
    return join_with(per_zip, income, "zip", strategy=strategy, salts=1)


def victims_of_side(
    profile: DataFrame,
    n: int = 3,
    side: str = "top",
    strategy: str = "auto",
    labels: Mapping[str, str] = DESCENT_LABELS,
) -> DataFrame:
    """Victims by descent in the ZIP codes that have one of the ``n`` extreme incomes.

    Incomes are those of ZIP codes with incidents. Several ZIP codes may share one, so more
    than ``n`` ZIP codes may be in.
    """
    incomes = extreme_values(profile, "median_income", n, side)
    # Spark knows that at most n values come and broadcasts them if they are few.
    matched = profile.join(incomes, "median_income", "left_semi")
    zips = matched.select("zip").distinct()
    # For "broadcast" Spark decides when it knows the size of the selection. Measuring it here
    # would read all incidents once more.
    strategy = "auto" if strategy == "broadcast" else strategy
    chosen = join_with(profile, zips, "zip", "left_semi", strategy, salts=1)
    totals = chosen.groupBy("vict_descent").agg(F.sum("victims").alias("total_victims"))
    labelled = totals.select(
        decode(F.col("vict_descent"), labels).alias("victim_descent"), "total_victims"
    )
    return labelled.orderBy(F.desc("total_victims"), "victim_descent")


def victims_by_income(
    incidents: DataFrame,
    revgeo: DataFrame,
    income: DataFrame,
    year: int = 2015,
    n: int = 3,
    side: str = "top",
    strategy: str = "auto",
    labels: Mapping[str, str] = DESCENT_LABELS,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Victims by descent, most first, of incidents reported in ``year`` in the ZIP codes
    with the ``n`` highest (``side="top"``) or lowest (``"bottom"``) incomes:
    victim_descent, total_victims. ``strategy`` is that of `join_with`, for all joins.

    ``side="both"`` gives both, with a first column ``side``; the incidents are read once.
    """
    if side not in SIDES:
        raise ValueError(f"unknown side {side!r}, not one of {SIDES}")
    profile = income_profile(incidents, revgeo, income, year, strategy, max_broadcast_bytes)
    if side != "both":
        return victims_of_side(profile, n, side, strategy, labels)
    top, bottom = (
        victims_of_side(profile, n, one, strategy, labels).select(F.lit(one).alias("side"), "*")
        for one in ("top", "bottom")
    )
    both = top.unionByName(bottom)
    return both.orderBy(F.desc("side"), F.desc("total_victims"), "victim_descent")
