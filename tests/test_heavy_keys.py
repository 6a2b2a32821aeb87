"""Joins with hot keys, and of near coordinates, against brute force."""

from __future__ import annotations

import math
import random

import pytest
from helpers import executed_plan, rows_of
from pyspark.sql import functions as F

from incident_analytics.operators import heavy_keys, join_heavy_keys, join_nearest
from incident_analytics.operators.heavy import replicated


@pytest.fixture(scope="module")
def hot(spark):
    """A third of 30,000 rows on one key, a tenth on another, few on each of the rest; some null keys."""
    key = F.when(F.col("id") % 3 == 0, -7).when(F.col("id") % 10 == 1, 5).when(F.col("id") % 100 == 2, None)
    left = spark.range(30_000).select(key.when(F.lit(True), F.col("id") % 4000 + 100).alias("k"), F.col("id").alias("salt"))
    right = spark.range(6000).select((F.col("id") - 10).alias("k"), (F.col("id") * 2).alias("pieces"))
    return left, right


def test_only_heavy_keys_are_found(spark, hot):
    left, right = hot
    found = heavy_keys(left, "k", 0.05)
    hashes = {r["key_hash"]: r["pieces"] for r in found.collect()}
    named = {r["k"]: r["h"] for r in spark.createDataFrame([(-7,), (5,)], "k bigint").select("k", F.xxhash64("k").alias("h")).collect()}
    assert set(hashes) == set(named.values())
    assert hashes[named[-7]] == 7 and hashes[named[5]] in (1, 2)
    # Right rows are copied for those alone.
    copies = replicated(right, "k", found).groupBy("k").count().filter("count > 1")
    assert {r["k"]: r["count"] for r in copies.collect()} == {k: hashes[h] for k, h in named.items() if hashes[h] > 1}


@pytest.mark.parametrize("how", ["inner", "left_semi"])
def test_heavy_join_is_the_plain_join(hot, how):
    left, right = hot
    for share in (0.01, 0.2, 0.9):
        got = join_heavy_keys(left, right, "k", how, share)
        plain = left.join(right, "k", how)
        assert got.columns == plain.columns
        assert got.exceptAll(plain).isEmpty() and plain.exceptAll(got).isEmpty()


def test_heavy_join_spreads_the_hot_key(spark, hot):
    left, right = hot
    joined = join_heavy_keys(left, right, ["k"])
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, "false")
    try:
        plan = executed_plan(joined)
        assert "SortMergeJoin [k" in plan and "approx_top_k" in plan and "Python" not in plan
        spread = joined.withColumn("part", F.spark_partition_id()).groupBy("k", "part").count().filter("k = -7").collect()
    finally:
        spark.conf.unset(setting)
    assert len(spread) == 8 and max(r["count"] for r in spread) < 5000


def test_heavy_join_of_odd_tables(spark, hot):
    left, right = hot
    assert join_heavy_keys(left.limit(0), right, "k").count() == 0
    assert join_heavy_keys(left.filter("k is null"), right, "k").count() == 0
    two = left.withColumn("t", F.lit("x"))
    assert join_heavy_keys(two, right.withColumn("t", F.lit("x")), ["k", "t"]).count() == left.join(right, "k").count()
    with pytest.raises(ValueError):
        join_heavy_keys(left, right, "k", "full")
    with pytest.raises(ValueError):
        heavy_keys(left, "k", 1.5)


def km(a, b):
    """Distance by the angle between two vectors."""
    (la, lo), (lb, lp) = (tuple(map(math.radians, p)) for p in (a, b))
    first = (math.cos(la) * math.cos(lo), math.cos(la) * math.sin(lo), math.sin(la))
    second = (math.cos(lb) * math.cos(lp), math.cos(lb) * math.sin(lp), math.sin(lb))
    return 6371.0 * 2 * math.asin(min(1.0, math.dist(first, second) / 2))


@pytest.mark.parametrize(("radius", "rings"), [(150.0, (1.0,)), (150.0, (0.1, 0.5, 1.0)), (3000.0, (1 / 16, 1.0)), (25_000.0, (1.0,))])
def test_nearest_by_hand(spark, radius, rings):
    rng = random.Random(radius)
    # Around the poles, across the date line, and crowded in one place.
    def point():
        kind = rng.random()
        if kind < 0.2:
            return rng.choice([-1, 1]) * rng.uniform(88, 90), rng.uniform(-180, 180)
        if kind < 0.4:
            return rng.uniform(-60, 60), rng.choice([-180.0, 180.0, rng.uniform(179, 180), rng.uniform(-180, -179)])
        if kind < 0.7:
            return 34 + rng.uniform(0, 1), -118 + rng.uniform(0, 1)
        return rng.uniform(-90, 90), rng.uniform(-180, 180)

    places = [(*point(), f"z{i}") for i in range(120)]
    spots = [(i, *point()) for i in range(150)] + [(900, None, 1.0), (901, 95.0, 1.0), (902, math.nan, 0.0), (903, *places[0][:2]), (904, *places[0][:2])]
    right = spark.createDataFrame([*places, (None, 1.0, "no"), (*places[0][:2], "zz")], "LAT double, LON double, zip string")
    left = spark.createDataFrame(spots, "id int, y double, x double")
    got = {r["id"]: r for r in join_nearest(left, right, ["zip"], radius, ("y", "x"), ("LAT", "LON"), rings).collect()}
    want = {}
    for i, y, x in spots:
        if y is None or not -90 <= y <= 90:
            continue
        far, name = min((km((y, x), p[:2]), p[2]) for p in places)
        if far <= radius:
            want[i] = (name, far)
    assert set(got) == set(want) and 10 < len(want)
    for i, (name, far) in want.items():
        assert got[i]["km"] == pytest.approx(far, abs=1e-4)
        assert got[i]["zip"] == name


def test_nearest_plan_and_arguments(spark):
    left = spark.createDataFrame([(1, 34.0, -118.0)] * 5, "id int, lat double, lon double")
    right = spark.createDataFrame([(34.0001, -118.0, "a")], "lat double, lon double, zip string")
    joined = join_nearest(left, right, ["zip"], 1.0)
    assert joined.columns == ["id", "lat", "lon", "zip", "km"] and joined.count() == 5
    plan = executed_plan(joined)
    assert not any(word in plan for word in ("CartesianProduct", "NestedLoop", "Python"))
    assert join_nearest(left.limit(0), right, ["zip"], 1.0).count() == 0
    assert join_nearest(left, right.limit(0), ["zip"], 1.0).count() == 0
    for bad in ({"radius_km": 0}, {"radius_km": 1.0, "rings": (0.5,)}):
        with pytest.raises(ValueError):
            join_nearest(left, right, ["zip"], **bad)
    with pytest.raises(ValueError):
        join_nearest(left, right.withColumnRenamed("zip", "id"), ["id"], 1.0)
    assert rows_of(joined.select("zip").distinct()) == [("a",)]
