"""Input that grows, exact means, accounts of unreadable values, and layouts that let reads skip."""

from __future__ import annotations

import os
import re
from decimal import ROUND_HALF_UP, Decimal

import pyarrow.parquet as pq
import pytest
from helpers import INCIDENT_HEADER, executed_plan, incident, random_incidents, rows_of, write_file
from pyspark.sql import Observation
from pyspark.sql import functions as F

from incident_analytics.__main__ import run
from incident_analytics.functions import mean_of_units, sum_of_units, to_units
from incident_analytics.plans import station_distance, top_months, top_months_from_state, update_month_counts
from incident_analytics.operators import run_script
from incident_analytics.sources import (
    Conversion,
    convert,
    convert_new,
    in_box,
    read_converted,
    read_incidents,
    read_manifest,
    read_parquet,
    write_bucketed,
    write_zordered,
)
from incident_analytics.sources import increments
from incident_analytics.twins.queries import avg_exact, join_bucketed, pruned_by_selection

SF = "/root/testdata/sf0.001"


# Exact sums


def test_mean_is_the_same_for_any_partitions(spark):
    values = spark.range(20_000).select((F.col("id") % 7).alias("g"), (F.rand(3) * F.pow(F.lit(10.0), F.col("id") % 5) - 300).alias("x"))
    fixed = values.select("g", "x", to_units(F.col("x")).alias("u")).cache()
    seen = set()
    for parts in (1, 7, 200):
        dealt = fixed.repartition(parts, "x").groupBy("g").agg(mean_of_units(F.col("u")).alias("m"), sum_of_units(F.col("u")).alias("s"))
        seen.add(tuple(rows_of(dealt)))
    assert len(seen) == 1
    for g, mean, total in next(iter(seen)):
        units = [r["u"] for r in fixed.filter(F.col("g") == g).collect()]
        assert total == sum(units)
        exact = (Decimal(sum(units)) / len(units) / 10**9).quantize(Decimal("0.01"), ROUND_HALF_UP)
        assert mean == float(exact)
    fixed.unpersist()


def test_mean_rounds_half_up_and_keeps_nulls(spark):
    rows = [("a", 0.005), ("a", 0.005), ("b", -0.005), ("c", None), ("d", 2.0), ("d", None), ("e", 9e9)]
    df = spark.createDataFrame(rows, "g string, x double").select("g", to_units(F.col("x")).alias("u"))
    got = dict(rows_of(df.groupBy("g").agg(mean_of_units(F.col("u")).alias("m"))))
    assert got == {"a": 0.01, "b": -0.01, "c": None, "d": 2.0, "e": 9e9}
    assert df.filter("u is null").agg(mean_of_units(F.col("u")).alias("m")).first()["m"] is None
    with pytest.raises(ValueError):
        mean_of_units(F.col("u"), 9)


def test_sums_beyond_longs(spark):
    big = spark.range(4000).select(F.lit((1 << 63) - 1).alias("u"))
    assert big.agg(sum_of_units(F.col("u")).alias("s")).first()["s"] == 4000 * ((1 << 63) - 1)
    assert big.agg(sum_of_units(-F.col("u")).alias("s")).first()["s"] == -4000 * ((1 << 63) - 1)


def test_distance_is_joined_before_it_is_summed(spark, tmp_path):
    incidents = read_incidents(spark, write_file(tmp_path / "a.csv", INCIDENT_HEADER, random_incidents(400, 3)))
    stations = spark.createDataFrame([(-118.3, 34.0, "C", "1"), (-118.2, 34.1, "D", "2")], "lon double, lat double, division string, prec string")
    answers = set()
    for parts in (1, 7, 200):
        for route in ("auto", "broadcast", "repartition"):
            got = station_distance(incidents.repartition(parts), stations, route)
            answers.add(tuple(map(tuple, got.collect())))
    assert len(answers) == 1
    got = station_distance(incidents, stations, "broadcast")
    lines = executed_plan(got).split("\n")
    joined = next(i for i, line in enumerate(lines) if "BroadcastHashJoin" in line)
    # Between the scan of the incidents and the join nothing is shuffled.
    scan = next(i for i, line in enumerate(lines) if "FileScan csv" in line and i > joined)
    assert not any(re.search(r"\bExchange\b", line) for line in lines[joined:scan])


def test_plan_of_exact_mean_has_no_python(spark):
    assert "Python" not in executed_plan(avg_exact(spark, SF))


# Unreadable values


def test_unreadable_values_are_counted_in_the_same_pass(spark, tmp_path):
    odd = [incident(date_occ="2015-01-01", lat="north"), incident(date_rptd="", lat=None), incident(date_rptd="03/02/20x5", weapon_cd="1A"), incident(lat=" 34.1 ", lon="-118,2")]
    path = write_file(tmp_path / "a.csv", INCIDENT_HEADER, odd)
    account = Observation()
    incidents = read_incidents(spark, path, account=account)
    assert not [c for c in incidents.columns if c.startswith("_")]
    assert rows_of(incidents.select("lat")) == sorted([(None,), (None,), (34.05,), (34.1,)], key=repr)
    counts = account.get
    assert counts == {"rows": 4, "date_rptd": 1, "rptd_year": 1, "date_occ": 1, "lat": 1, "lon": 1}
    (written,) = convert(spark, [Conversion(path, str(tmp_path / "copy"), "incidents")])
    assert written == {k: v for k, v in counts.items()}
    typed = Observation()
    assert read_incidents(spark, str(tmp_path / "copy"), fmt="parquet", account=typed).count() == 4
    assert typed.get == {"rows": 4}


def test_account_of_two_eras_and_one_scan(spark, tmp_path):
    old = write_file(tmp_path / "old.csv", INCIDENT_HEADER, [incident(lat="x")] * 3)
    new = write_file(tmp_path / "new.csv", INCIDENT_HEADER, [incident(lat="y"), incident()])
    account = Observation()
    report = top_months(read_incidents(spark, old, new, account=account, columns=["date_occ", "lat"]))
    assert executed_plan(report).count("FileScan csv") == 2
    assert account.get == {"rows": 5, "date_occ": 0, "lat": 4}


def test_command_line_tells_unreadable_values(spark, tmp_path, capsys):
    rows = [incident(date_occ="2015-01-01"), incident(), incident(lat="north")]
    path = write_file(tmp_path / "a.csv", INCIDENT_HEADER, rows)
    run(spark, ["top-months", "--incidents", path, "--out", str(tmp_path / "out")])
    assert "incidents: 3 rows, 1 unreadable in date_occ" in capsys.readouterr().err
    run(spark, ["top-months", "--incidents", path, "-k", "0", "--show", "5", "--api", "script"])
    run(spark, ["convert", "--table", "incidents", path, str(tmp_path / "copy")])
    assert "3 rows, 1 unreadable in date_occ, 1 unreadable in lat" in capsys.readouterr().err


# Input that grows


def month_rows(spark, *paths):
    return [tuple(r) for r in top_months(read_incidents(spark, *paths)).collect()]


def test_second_run_reads_only_the_new_file(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    manifest, target, state = (str(tmp_path / n) for n in ("manifest", "copy", "state"))
    job = Conversion(str(source), target, "incidents", partition_by=("rptd_year",))
    first = write_file(source / "a.csv", INCIDENT_HEADER, random_incidents(200, 1))
    assert [p.rsplit("/", 1)[1] for p in convert_new(spark, job, manifest)] == ["a.csv"]
    assert update_month_counts(spark, job, manifest, state) == 1
    before = {p: os.path.getmtime(p) for p in _files(target)}
    second = write_file(source / "b.csv", INCIDENT_HEADER, random_incidents(300, 2))
    assert [p.rsplit("/", 1)[1] for p in convert_new(spark, job, manifest)] == ["b.csv"]
    assert update_month_counts(spark, job, manifest, state) == 1
    assert all(os.path.getmtime(p) == at for p, at in before.items())
    assert convert_new(spark, job, manifest) == [] and update_month_counts(spark, job, manifest, state) == 0
    whole = read_incidents(spark, first, second)
    columns = read_converted(spark, job, manifest).columns
    assert rows_of(read_converted(spark, job, manifest)) == rows_of(whole.select(*columns))
    got = top_months_from_state(spark, manifest, state)
    assert [tuple(r) for r in got.collect()] == month_rows(spark, first, second)
    # A changed file takes the place of its earlier version.
    os.utime(write_file(source / "a.csv", INCIDENT_HEADER, random_incidents(50, 3)), (2_000_000_000, 2_000_000_000))
    assert [p.rsplit("/", 1)[1] for p in convert_new(spark, job, manifest)] == ["a.csv"]
    assert update_month_counts(spark, job, manifest, state) == 1
    assert read_converted(spark, job, manifest).count() == 350
    assert [tuple(r) for r in top_months_from_state(spark, manifest, state).collect()] == month_rows(spark, first, second)


def _files(folder):
    return [os.path.join(d, f) for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet")]


def test_killed_run_can_be_repeated(spark, tmp_path, monkeypatch):
    source = tmp_path / "in"
    source.mkdir()
    job, manifest = Conversion(str(source), str(tmp_path / "copy")), str(tmp_path / "manifest")
    write_file(source / "a.csv", ("k", "v"), [(1, "x"), (2, "y")])
    monkeypatch.setattr(increments, "_MANIFEST", increments._MANIFEST)
    entries = spark.createDataFrame

    def killed(*args, **kwargs):
        if args[0]:
            raise KeyboardInterrupt
        return entries(*args, **kwargs)

    monkeypatch.setattr(spark, "createDataFrame", killed)
    with pytest.raises(KeyboardInterrupt):
        convert_new(spark, job, manifest)
    monkeypatch.undo()
    assert _files(str(tmp_path / "copy")) and read_manifest(spark, manifest).count() == 0
    write_file(source / "b.csv", ("k", "v"), [(3, "z")])
    assert len(convert_new(spark, job, manifest)) == 2
    assert rows_of(read_converted(spark, job, manifest).select("k", "v")) == [("1", "x"), ("2", "y"), ("3", "z")]


# Layouts


def test_zorder_reads_fewer_row_groups(spark, tmp_path):
    df = spark.range(40_000).select(F.col("id"), (F.rand(1) * 2 + 33).alias("lat"), (F.rand(2) * 2 - 119).alias("lon"), (F.col("id") % 500).cast("string").alias("code"))
    df = df.unionByName(df.limit(300).select("id", F.lit(None).cast("double").alias("lat"), F.lit(None).cast("double").alias("lon"), "code"))
    box = {"lat": (33.5, 33.7), "lon": (-118.3, -118.1)}

    def touched(path):
        groups = 0
        for file in _files(path):
            meta = pq.ParquetFile(file).metadata
            names = [meta.row_group(0).column(i).path_in_schema for i in range(meta.num_columns)]
            for g in range(meta.num_row_groups):
                stats = {n: meta.row_group(g).column(i).statistics for i, n in enumerate(names)}
                groups += all(stats[c].has_min_max and stats[c].min <= high and stats[c].max >= low for c, (low, high) in box.items())
        return groups

    plain, ordered = str(tmp_path / "plain"), str(tmp_path / "ordered")
    df.repartition(16).write.parquet(plain)
    write_zordered(df, ordered, ["lat", "lon"], 16, ["code"])
    assert touched(plain) == 16 and touched(ordered) <= 5
    read = read_parquet(spark, ordered)
    assert read.columns == df.columns and rows_of(read) == rows_of(df)
    assert rows_of(in_box(read, box)) == rows_of(in_box(df, box))
    assert "GreaterThanOrEqual(lat,33.5)" in executed_plan(in_box(read, box))
    assert any(pq.ParquetFile(f).metadata.row_group(0).column(3).path_in_schema == "code" for f in _files(ordered))
    # Rows at one place don't all go to one file.
    same = spark.range(20_000).select(F.lit(34.0).alias("lat"), F.lit(-118.0).alias("lon"), "id")
    write_zordered(same, str(tmp_path / "same"), ["lat", "lon"], 8)
    sizes = [pq.ParquetFile(f).metadata.num_rows for f in _files(str(tmp_path / "same"))]
    assert len(sizes) >= 4 and max(sizes) < 10_000


def test_bucketed_tables_join_without_a_shuffle(spark):
    lines = executed_plan(join_bucketed(spark, SF)).split("\n")
    at = next(i for i, line in enumerate(lines) if "SortMergeJoin" in line)
    assert not any(re.search(r"\bExchange\b", line) for line in lines[at:])
    assert any("Bucketed: true" in line for line in lines)
    small = write_bucketed(spark.range(5), "five_rows", ["id"], 2, spark.conf.get("spark.checkpoint.dir") + "/five")
    assert rows_of(small) == [(i,) for i in range(5)]


def test_selection_prunes_folders(spark):
    plan = executed_plan(pruned_by_selection(spark, SF))
    assert "dynamicpruning" in plan


def test_script_is_checked(spark):
    df = spark.range(9)
    text = "BEGIN DECLARE n INT DEFAULT 0; SET n = :low + 1; SELECT count(*) AS c FROM {t} WHERE id >= n; END"
    assert rows_of(run_script(spark, text, {"t": df}, {"low": 3})) == [(5,)]
    with pytest.raises(ValueError):
        run_script(spark, "SELECT 1; SELECT 2")
