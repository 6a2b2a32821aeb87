from __future__ import annotations

import math
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from incident_analytics.functions import DAYPARTS, currency_to_int, daypart, haversine_km
from incident_analytics.operators import extreme_values, salted_join, top_k_per_group, union_eras

few = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
lat = st.floats(-90, 90)
lon = st.floats(-180, 180)
key = st.one_of(st.none(), st.integers(0, 3))
keyed = st.lists(st.tuples(key, st.integers(-5, 5)), max_size=60)


@few
@given(st.lists(st.tuples(lat, lon, lat, lon), min_size=1, max_size=200))
def test_distance_is_a_distance(spark, points):
    a, b, c, d = map(F.col, "abcd")
    df = spark.createDataFrame(points, "a double, b double, c double, d double").select(
        haversine_km(a, b, c, d).alias("there"),
        haversine_km(c, d, a, b).alias("back"),
        haversine_km(a, b, a, b).alias("nowhere"),
    )
    for there, back, nowhere in df.collect():
        assert math.isclose(there, back, abs_tol=1e-6)
        assert nowhere == 0
        assert 0 <= there <= math.pi * 6371.0 + 1e-6


def test_every_minute_has_a_part_of_the_day(spark):
    minutes = spark.range(24 * 60).select(
        F.format_string("%02d%02d", F.floor(F.col("id") / 60), F.col("id") % 60).alias("hhmm")
    )
    counts = {r[0]: r[1] for r in minutes.groupBy(daypart(F.col("hhmm"))).count().collect()}
    assert counts == dict(zip(DAYPARTS, (7 * 60, 5 * 60, 4 * 60, 8 * 60)))


@few
@given(st.lists(st.integers(0, 2**31 - 1), min_size=1, max_size=100))
def test_currency_comes_back(spark, amounts):
    df = spark.createDataFrame([(n, f"${n:,}") for n in amounts], "n bigint, t string")
    assert df.filter(~currency_to_int(F.col("t")).eqNullSafe(F.col("n").cast("int"))).count() == 0


@few
@given(keyed, keyed)
def test_union_keeps_all_rows(spark, first, second):
    one, two = (spark.createDataFrame(rows, "k int, v int") for rows in (first, second))
    got = Counter(tuple(r) for r in union_eras(one, two.select("v", "k")).collect())
    assert got == Counter(first) + Counter(second)


@few
@given(keyed, keyed, st.integers(1, 5))
def test_salted_join_is_a_join(spark, first, second, salts):
    left = spark.createDataFrame(first, "k int, v int")
    right = spark.createDataFrame(second, "k int, w int")
    got = Counter(tuple(r) for r in salted_join(left, right, "k", salts=salts).collect())
    assert got == Counter(
        (k, v, w) for k, v in first for j, w in second if k is not None and k == j
    )


@few
@given(keyed, st.integers(1, 4))
def test_top_k_and_extremes(spark, rows, k):
    df = spark.createDataFrame(sorted(set(rows), key=repr), "k int, v int")
    top = top_k_per_group(df, ["k"], [F.asc("v")], k)
    got = Counter((r.k, r.v, r.ranking) for r in top.collect())
    expected = Counter()
    for key in {key for key, _ in rows}:
        values = sorted({v for j, v in rows if j == key})[:k]
        expected.update((key, v, i + 1) for i, v in enumerate(values))
    assert got == expected
    lowest = sorted({v for _, v in rows})[:k]
    assert sorted(r.v for r in extreme_values(df, "v", k, "bottom").collect()) == lowest
