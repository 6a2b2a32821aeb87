from __future__ import annotations

import pytest
from helpers import executed_plan, rows_of
from pyspark.sql import functions as F

from incident_analytics.functions import DESCENT_LABELS
from incident_analytics.operators import (
    STRATEGIES,
    assert_unique,
    decode_by_table,
    extreme_values,
    join_with,
    keep_matching,
    measured_bytes,
    one_per_key,
    rank_in_group,
    register,
    register_labels,
    repeated_keys,
    run_sql,
    salted_join,
    top_k_per_group,
)
from incident_analytics.operators import ranking
from incident_analytics.operators.salting import dealt_salt

LEFT = [(1, "a"), (1, "a"), (1, "b"), (2, "c"), (3, "d"), (None, "e")]
RIGHT = [(1, 10), (1, 11), (2, 20), (4, 40), (None, 50)]


@pytest.fixture(scope="module")
def sides(spark):
    return (
        spark.createDataFrame(LEFT, "k int, v string"),
        spark.createDataFrame(RIGHT, "k int, w int"),
    )


def pairs(how):
    """What the join must give, by brute force."""
    if how == "left_semi":
        keys = {k for k, _ in RIGHT if k is not None}
        return sorted([row for row in LEFT if row[0] in keys], key=repr)
    return sorted(
        [(k, v, w) for k, v in LEFT for k2, w in RIGHT if k is not None and k == k2], key=repr
    )


@pytest.mark.parametrize("how", ["inner", "left_semi"])
@pytest.mark.parametrize("strategy", STRATEGIES)
def test_strategies_agree(sides, strategy, how):
    left, right = sides
    for on in ("k", ["k"]):
        assert rows_of(join_with(left, right, on, how, strategy)) == pairs(how)


@pytest.mark.parametrize(
    ("strategy", "operator"),
    [
        ("broadcast", "BroadcastHashJoin"),
        ("merge", "SortMergeJoin"),
        ("shuffle_hash", "ShuffledHashJoin"),
        ("shuffle_replicate_nl", "SortMergeJoin"),
    ],
)
@pytest.mark.parametrize("how", ["inner", "left_semi"])
def test_strategy_is_the_one_that_runs(sides, strategy, operator, how):
    left, right = sides
    plan = executed_plan(join_with(left, right, "k", how, strategy))
    assert operator in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_too_big_to_broadcast(sides):
    left, right = sides
    joined = join_with(left, right, "k", strategy="broadcast", max_broadcast_bytes=50)
    assert rows_of(joined) == pairs("inner")
    assert "SortMergeJoin" in executed_plan(joined)


def test_measured_bytes_counts_text(spark):
    short = spark.createDataFrame([("x",), (None,)], "t string")
    long = spark.createDataFrame([("x" * 1000,), (None,)], "t string")
    assert measured_bytes(long) - measured_bytes(short) == 999
    assert measured_bytes(short.filter("t = 'y'")) == 0


def test_join_by_condition(sides):
    left, right = sides
    same = F.col("l.k") == F.col("r.k")
    joined = join_with(left.alias("l"), right.alias("r"), same, strategy="merge")
    assert rows_of(joined.select("l.k", "v", "w")) == pairs("inner")
    with pytest.raises(ValueError):
        join_with(left, right, same, strategy="shuffle_replicate_nl")


def test_join_rejects_unknown_names(sides):
    with pytest.raises(ValueError):
        join_with(*sides, "k", strategy="nested")
    with pytest.raises(ValueError):
        join_with(*sides, "k", how="full")


def test_salt_spreads_copies_of_one_row(spark):
    copies = spark.range(8000).repartition(8).select(F.lit(1).alias("k"), F.lit("x").alias("salt"))
    shares = [r["count"] for r in copies.groupBy(dealt_salt(copies, 16)).count().collect()]
    assert len(shares) >= 8 and max(shares) <= 8000 / 4
    again = [r["count"] for r in copies.groupBy(dealt_salt(copies, 16)).count().collect()]
    assert sorted(again) == sorted(shares)
    right = spark.createDataFrame([(1, 2)], "k int, salt2 int")
    joined = salted_join(copies, right, "k")  # a column named salt is no obstacle
    assert joined.columns == ["k", "salt", "salt2"]
    assert joined.count() == 8000


def test_top_k_breaks_ties_by_the_last_key(spark):
    df = spark.createDataFrame(
        [(1, 5, 10), (1, 4, 10), (1, 1, 20), (1, 2, 10), (2, 1, 1)], "y int, m int, n int"
    )
    top = top_k_per_group(df, ["y"], [F.desc("n"), F.asc("m")], 3)
    assert rows_of(top) == [(1, 1, 20, 1), (1, 2, 10, 2), (1, 4, 10, 3), (2, 1, 1, 1)]
    assert executed_plan(top).count("WindowGroupLimit") == 2


def test_big_k_cuts_hot_groups_in_parts(spark, monkeypatch):
    df = spark.range(4000).repartition(8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5).alias("g"), "id"
    )
    order = [F.desc("id")]
    plain = rank_in_group(df, ["g"], order).filter("ranking <= 50")
    setting = "spark.sql.optimizer.windowGroupLimitThreshold"
    spark.conf.set(setting, "20")
    try:
        assert rows_of(top_k_per_group(df, ["g"], order, 50)) == rows_of(plain)
        mapped = df.withColumn("m", F.create_map(F.lit("k"), "id"))
        assert rows_of(top_k_per_group(mapped, ["g"], order, 50).drop("m")) == rows_of(plain)
        only = df.select(F.create_map(F.lit("k"), "id").alias("m"))
        assert top_k_per_group(only, [], [F.col("m")["k"]], 50).count() == 50
    finally:
        spark.conf.unset(setting)


def test_extreme_values(spark):
    df = spark.createDataFrame([(3,), (1,), (None,), (3,), (2,), (5,)], "n int")
    assert rows_of(extreme_values(df, "n", 3)) == [(2,), (3,), (5,)]
    assert rows_of(extreme_values(df, "n", 3, "bottom")) == [(1,), (2,), (3,)]
    assert rows_of(extreme_values(df, "n", 9, "bottom")) == [(1,), (2,), (3,), (5,)]
    assert rows_of(extreme_values(df.filter("n is null"), "n")) == []
    assert "TakeOrderedAndProject" in executed_plan(extreme_values(df, "n").groupBy().count())
    with pytest.raises(ValueError):
        extreme_values(df, "n", 3, "middle")


def test_one_per_key(spark):
    df = spark.createDataFrame(
        [(1.0, 2.0, "90002"), (1.0, 2.0, "90001"), (1.0, 2.0, None), (1.0, 3.0, None)],
        "lat double, lon double, zip string",
    )
    assert rows_of(one_per_key(df, ["lat", "lon"], "zip")) == [
        (1.0, 2.0, "90001"), (1.0, 3.0, None)
    ]


def test_keep_matching_adds_no_rows(sides):
    left, right = sides
    assert rows_of(keep_matching(left, right, "k")) == pairs("left_semi")


def test_decode_by_table(spark):
    df = spark.createDataFrame([("A",), ("-",), (None,)], "c string")
    table = spark.createDataFrame(list(DESCENT_LABELS.items()), "code string, label string")
    got = decode_by_table(df, "c", table, "code", "label", "name")
    assert rows_of(got) == sorted([("A", "Other Asian"), ("-", "-"), (None, None)], key=repr)


def test_repeated_keys(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 1)], "k int, v int")
    assert rows_of(repeated_keys(df, ["k"])) == [(1, 2)]
    with pytest.raises(ValueError, match="repeated key"):
        assert_unique(df, ["k"])
    assert assert_unique(df, ["k", "v"]) is df


def test_views_and_sql(spark):
    df = register(spark.range(5).toDF("n"), "some_numbers")
    assert rows_of(run_sql(spark, "SELECT sum(n) FROM some_numbers")) == [(10,)]
    got = run_sql(spark, "SELECT n FROM {numbers} WHERE n >= :low", {"numbers": df}, {"low": 3})
    assert rows_of(got) == [(3,), (4,)]


def test_sql_label_function(spark):
    register_labels(spark, "descent_label", {**DESCENT_LABELS, "'": "it's \\ a quote"})
    got = spark.sql(
        "SELECT descent_label('H'), descent_label('-'), descent_label(NULL), descent_label('\\'')"
    )
    assert rows_of(got) == [("Hispanic/Latin/Mexican", "-", None, "it's \\ a quote")]
    with pytest.raises(ValueError):
        register_labels(spark, "f(x); DROP", {})
