"""The four reports against brute force, and against each other."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import pytest
from helpers import (
    INCIDENT_HEADER,
    INCOME,
    INCOME_HEADER,
    REVGEO,
    REVGEO_HEADER,
    STATION_HEADER,
    STATIONS,
    executed_plan,
    incident,
    random_incidents,
    rows_of,
    write_file,
)
from pyspark.sql import functions as F

from incident_analytics.functions import DAYPARTS_GREEK
from incident_analytics.operators import STRATEGIES
from incident_analytics.plans import (
    daypart_counts,
    daypart_counts_sql,
    income_profile,
    month_counts,
    station_distance,
    top_months,
    top_months_report,
    top_months_sql,
    victims_by_income,
    victims_of_side,
)
from incident_analytics.sources.schemas import TABLES, canonicalize
from incident_analytics.sources import (
    Conversion,
    convert,
    read_incidents,
    read_income,
    read_revgeo,
    read_stations,
    write_csv,
)

OLD, NEW = random_incidents(1500, 1), random_incidents(1500, 2)
ROWS = [dict(zip(INCIDENT_HEADER, row)) for row in OLD + NEW]


@pytest.fixture(scope="module")
def data(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("files")
    old = write_file(folder / "old.csv", INCIDENT_HEADER, OLD)
    new = write_file(folder / "new.csv", INCIDENT_HEADER, NEW)
    jobs = [Conversion(p, p.replace(".csv", ".parquet"), "incidents") for p in (old, new)]
    convert(spark, jobs)
    return {
        "csv": read_incidents(spark, old, new),
        "parquet": read_incidents(spark, *[j.target for j in jobs], fmt="parquet"),
        "revgeo": read_revgeo(spark, write_file(folder / "r.csv", REVGEO_HEADER, REVGEO)),
        "income": read_income(spark, write_file(folder / "i.csv", INCOME_HEADER, INCOME)),
        "stations": read_stations(spark, write_file(folder / "s.csv", STATION_HEADER, STATIONS)),
    }


def in_order(df):
    return [tuple(row) for row in df.collect()]


def null_first(value):
    return (value is not None, value)


# Months


def monthly_by_hand():
    counts = Counter()
    for row in ROWS:
        text = row["DATE OCC"]
        readable = re.fullmatch(r"(\d\d)/\d\d/(\d{4}) .*", text)
        counts[(int(readable[2]), int(readable[1])) if readable else (None, None)] += 1
    return counts


def top_months_by_hand(k):
    per_year = defaultdict(list)
    for (year, month), n in monthly_by_hand().items():
        per_year[year].append((month, n))
    result = []
    for year in sorted(per_year, key=null_first):
        ranked = sorted(per_year[year], key=lambda m: (-m[1], null_first(m[0])))[:k]
        result += [(year, month, n, i + 1) for i, (month, n) in enumerate(ranked)]
    return result


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_top_months(spark, data, fmt):
    for k in (1, 3, 12):
        expected = top_months_by_hand(k)
        assert in_order(top_months(data[fmt], k)) == expected
        assert in_order(top_months_sql(spark, data[fmt], k)) == expected


def test_both_ways_of_dating_agree(data):
    by_text = month_counts(data["csv"])
    by_row = month_counts(data["csv"].drop("date_occ_text"))
    assert rows_of(by_text) == rows_of(by_row)
    assert by_text.schema.simpleString() == by_row.schema.simpleString()
    assert sum(r[2] for r in rows_of(by_text)) == len(ROWS)


def test_equal_totals_rank_the_earlier_month_first(spark, tmp_path):
    months = [1, 1, 1, 2, 2, 9, 4, 4, 4, 4, 7]
    rows = [incident(date_occ=f"{m:02d}/05/2015 12:00:00 AM") for m in months]
    df = read_incidents(spark, write_file(tmp_path / "a.csv", INCIDENT_HEADER, rows))
    assert in_order(top_months(df, 4)) == [
        (2015, 4, 4, 1), (2015, 1, 3, 2), (2015, 2, 2, 3), (2015, 7, 1, 4)
    ]


def test_months_report(data, tmp_path):
    report = top_months_report(top_months(data["csv"], 1))
    assert [len(v) for v in report.collect()[-1]] == [4, 5, 11, 7]
    write_csv(report, str(tmp_path / "out"), "|")


# Parts of the day


def dayparts_by_hand(compat=False):
    counts = Counter()
    for row in ROWS:
        if row["Premis Desc"] != "STREET":
            continue
        text = row["TIME OCC"]
        if text is None:
            counts["Night" if compat else "Unknown"] += 1
            continue
        hour = int(str(int(text))[:2]) if compat else int(text) // 100
        counts[
            "Morning" if 5 <= hour < 12
            else "Afternoon" if 12 <= hour < 17
            else "Evening" if 17 <= hour < 21
            else "Night"
        ] += 1
    return sorted(counts.items(), key=lambda c: (-c[1], c[0]))


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_daypart_counts(spark, data, fmt):
    expected = dayparts_by_hand()
    assert in_order(daypart_counts(data[fmt])) == expected
    assert in_order(daypart_counts_sql(spark, data[fmt])) == expected
    assert in_order(daypart_counts(data[fmt], compat="prefix2")) == dayparts_by_hand(compat=True)
    greek = daypart_counts(data[fmt], labels=DAYPARTS_GREEK)
    assert {label for label, _ in in_order(greek)} == {*DAYPARTS_GREEK, "Unknown"}


def test_premises_reach_the_scan(data):
    plan = executed_plan(daypart_counts(data["parquet"]))
    assert "EqualTo(premis_desc,STREET)" in plan
    assert set(re.findall(r"ReadSchema: (struct<.*?>)", plan)) == {
        "struct<time_occ:string,premis_desc:string>"
    }


# Victims by income


def victims_by_hand(side, n=3, income=INCOME):
    zips = {}
    for lat, lon, code in REVGEO:
        if code is not None:
            zips[lat, lon] = min(code.strip(), zips.get((lat, lon), "~"))
    incomes = defaultdict(list)
    for code, _, money in income:
        digits = re.sub(r"[^0-9]", "", re.sub(r"\.[0-9]*$", "", money or ""))
        incomes[code].append(int(digits) if digits else None)
    joined = []
    for row in ROWS:
        code = zips.get((row["LAT"], row["LON"]))
        if row["Date Rptd"][6:10] == "2015" and row["Vict Descent"] is not None:
            joined += [(code, value, row["Vict Descent"]) for value in incomes.get(code, ())]
    values = sorted({v for _, v, _ in joined if v is not None}, reverse=side == "top")[:n]
    chosen = {code for code, v, _ in joined if v in values}
    labels = {"H": "Hispanic/Latin/Mexican", "B": "Black", "W": "White"}
    counts = Counter(labels.get(d, d) for code, _, d in joined if code in chosen)
    return sorted(counts.items(), key=lambda c: (-c[1], c[0]))


@pytest.mark.parametrize("side", ["top", "bottom"])
@pytest.mark.parametrize("strategy", STRATEGIES)
def test_victims(data, strategy, side):
    lookups = (data["revgeo"], data["income"])
    expected = victims_by_hand(side)
    assert len(expected) == 4
    for fmt in ("csv", "parquet"):
        got = victims_by_income(data[fmt], *lookups, side=side, strategy=strategy)
        assert in_order(got) == expected


def test_repeated_lookup_rows_multiply(spark, data):
    extra = [("90001", "again", "$70,000"), ("90009", "again", "$60,000")]
    more = [("90001", 70000), ("90009", 60000)]
    df = spark.createDataFrame(more, "zip string, median_income int")
    income = data["income"].unionByName(df)
    for side in ("top", "bottom"):
        expected = victims_by_hand(side, income=INCOME + extra)
        for strategy in ("auto", "merge"):
            got = victims_by_income(
                data["csv"], data["revgeo"], income, side=side, strategy=strategy
            )
            assert in_order(got) == expected


def test_both_sides_of_one_profile(data):
    profile = income_profile(data["csv"], data["revgeo"], data["income"]).persist()
    for side in ("top", "bottom"):
        for n in (1, 2, 3, 99):
            assert in_order(victims_of_side(profile, n, side)) == victims_by_hand(side, n)
    profile.unpersist()


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_incidents_are_read_once(data, strategy):
    got = victims_by_income(data["parquet"], data["revgeo"], data["income"], strategy=strategy)
    plan = executed_plan(got)
    assert plan.count("FileScan parquet") == 2  # one per era
    assert "ReusedExchange" in plan
    assert "EqualTo(rptd_year,2015)" in plan
    assert "CartesianProduct" not in plan and "Python" not in plan


def test_lookups_too_big_to_broadcast(data):
    for limit, join in ((0, "SortMergeJoin"), (10**9, "BroadcastHashJoin")):
        got = victims_by_income(
            data["csv"], data["revgeo"], data["income"], strategy="broadcast",
            max_broadcast_bytes=limit,
        )
        assert in_order(got) == victims_by_hand("top")
        assert join in executed_plan(got)


def test_both_sides_in_one_run(data):
    got = victims_by_income(data["parquet"], data["revgeo"], data["income"], side="both")
    expected = [(s, *row) for s in ("top", "bottom") for row in victims_by_hand(s)]
    assert in_order(got) == expected
    assert executed_plan(got).count("FileScan parquet") == 2  # one per era


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_incidents_are_counted_before_the_first_exchange(spark, data, strategy):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = victims_by_income(data["parquet"], data["revgeo"], data["income"], strategy=strategy)
        lines = got._jdf.queryExecution().executedPlan().toString().split("\n")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    scans = [i for i, line in enumerate(lines) if "FileScan" in line and "rptd_year" in line]
    assert scans
    for i in scans:
        above = [line for line in reversed(lines[:i]) if "Exchange" in line or "HashAggregate" in line]
        assert "HashAggregate" in above[0]


# Distance to the station


def km(lat1, lon1, lat2, lon2):
    """Distance by the angle between two vectors, another formula than the library's."""
    a, b, c, d = map(math.radians, (lat1, lon1, lat2, lon2))
    first = (math.cos(a) * math.cos(b), math.cos(a) * math.sin(b), math.sin(a))
    second = (math.cos(c) * math.cos(d), math.cos(c) * math.sin(d), math.sin(c))
    chord = math.dist(first, second)
    return 6371.0 * 2 * math.asin(min(1.0, chord / 2))


def distances_by_hand(stations=STATIONS):
    found = defaultdict(list)
    for row in ROWS:
        if not str(row["Weapon Used Cd"]).startswith("1") or not row["LAT"] or not row["LON"]:
            continue
        for x, y, _, division, _, prec in stations:
            if prec == row["AREA "] and None not in (prec, x, y):
                far = km(row["LAT"], row["LON"], y, x) if abs(y) <= 90 else None
                found[division].append((far, row["DR_NO"]))
    result = {}
    for division, pairs in found.items():
        known = [d for d, _ in pairs if d is not None]
        mean = sum(known) / len(known) if known else None
        result[division] = (mean, sum(n is not None for _, n in pairs))
    return result


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
@pytest.mark.parametrize("route", ["auto", "broadcast", "repartition"])
def test_station_distance(data, route, fmt):
    got = in_order(station_distance(data[fmt], data["stations"], route))
    expected = distances_by_hand()
    assert [(d, n) for d, _, n in got] == sorted(
        [(d, n) for d, (_, n) in expected.items()], key=lambda c: (-c[1], c[0])
    )
    assert len(got) == 3
    for division, mean, _ in got:
        assert mean == pytest.approx(expected[division][0], abs=0.0051)


@pytest.mark.parametrize("route", ["auto", "broadcast", "repartition"])
def test_two_stations_of_one_area_and_bad_degrees(spark, data, route):
    more = [(-118.25, 34.1, 6, "CENTRAL 2", "", 1), (-118.25, 134.1, 7, "LOST", "", 2)]
    extra = spark.createDataFrame(
        [(x, y, d, p) for x, y, _, d, _, p in more],
        "lon double, lat double, division string, prec int",
    ).withColumn("prec", F.col("prec").cast("string"))
    got = in_order(station_distance(data["csv"], data["stations"].unionByName(extra), route))
    expected = distances_by_hand(STATIONS + more)
    assert {d: n for d, _, n in got} == {d: n for d, (_, n) in expected.items()}
    assert next(mean for d, mean, _ in got if d == "LOST") is None


def test_routes_run_as_named(data):
    def plan_of(route):
        return executed_plan(station_distance(data["parquet"], data["stations"], route))

    assert "BroadcastHashJoin" in plan_of("broadcast")
    reduce_side = plan_of("repartition")
    assert "SortMergeJoin [area" in reduce_side and "salt" in reduce_side
    for plan in (plan_of("auto"), reduce_side):
        assert "Python" not in plan and "CartesianProduct" not in plan
    with pytest.raises(ValueError):
        station_distance(data["csv"], data["stations"], "by foot")


def test_too_many_stations_to_broadcast(data):
    every = [
        station_distance(data["csv"], data["stations"], route, max_broadcast_bytes=limit)
        for route, limit in (("broadcast", 0), ("broadcast", 10**9), ("auto", 0), ("repartition", 0))
    ]
    assert "SortMergeJoin" in executed_plan(every[0])
    rows = [in_order(df) for df in every]
    assert len(rows[0]) == 3 and all(r == rows[0] for r in rows)


def test_odd_codes_are_counted(spark):
    raw = spark.createDataFrame(
        [("1", "01", "101.0", "34.1", "-118.2"), ("A2", "1", "1A", "34.1", "-118.2"),
         ("3", "1.0", " 12 ", "34.1", "-118.2"), ("4", "1", "210", "34.1", "-118.2")],
        "`DR_NO` string, `AREA ` string, `Weapon Used Cd` string, LAT string, LON string",
    )
    columns = ["dr_no", "area", "weapon_cd", "lat", "lon"]
    incidents = canonicalize(raw, TABLES["incidents"], columns)
    station = spark.createDataFrame([(-118.2, 34.0, "C", "1")], "lon double, lat double, division string, prec string")
    assert [(d, n) for d, _, n in in_order(station_distance(incidents, station))] == [("C", 3)]


def test_code_prefix_is_pushed(data):
    plan = executed_plan(station_distance(data["parquet"], data["stations"]))
    assert "StringStartsWith(weapon_cd,1)" in plan


def test_reports_are_lazy(spark, data):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("lazy", "building must not run jobs")
    incidents = data["csv"]
    top_months(incidents)
    top_months_sql(spark, incidents)
    daypart_counts(incidents)
    victims_by_income(incidents, data["revgeo"], data["income"])
    victims_by_income(incidents, data["revgeo"], data["income"], strategy="merge")
    station_distance(incidents, data["stations"])
    station_distance(incidents, data["stations"], "repartition")
    assert list(tracker.getJobIdsForGroup("lazy")) == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert incidents.filter(F.lit(False)).count() == 0
