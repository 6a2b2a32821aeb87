from __future__ import annotations

import datetime
from types import SimpleNamespace

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

from incident_analytics.functions import pad
from incident_analytics.operators import union_eras
from incident_analytics.sources import (
    Conversion,
    as_typed,
    convert,
    read_csv,
    read_incidents,
    read_income,
    read_parquet,
    read_revgeo,
    read_stations,
    read_table,
    write_csv,
    write_parquet,
)
from incident_analytics.sources.schemas import stored_columns
from incident_analytics.sources.scratch import scratch_path


def test_incidents_are_typed_by_name(spark, tmp_path):
    old = write_file(
        tmp_path / "old.csv",
        INCIDENT_HEADER,
        [incident(), incident(date_occ="2015-01-01", time_occ="0005", lat="x", weapon_cd=102)],
    )
    # The later era has another column order and no blank after AREA.
    later = [h.strip() for h in reversed(INCIDENT_HEADER)]
    new = write_file(tmp_path / "new.csv", later, [tuple(reversed(incident()))])
    df = read_incidents(spark, old, new)
    assert dict(df.dtypes) == {
        "dr_no": "string",
        "date_rptd": "timestamp",
        "rptd_year": "int",
        "date_occ": "timestamp",
        "date_occ_text": "string",
        "time_occ": "string",
        "area": "string",
        "premis_desc": "string",
        "vict_descent": "string",
        "weapon_cd": "string",
        "lat": "double",
        "lon": "double",
    }
    rows = df.collect()
    assert len(rows) == 3
    assert sum(r.time_occ == "0630" for r in rows) == 2  # leading zero kept
    good = [r for r in rows if r.date_occ is not None]
    assert len(good) == 2 and good[0] == good[1]  # a repeated row stays twice
    assert good[0].date_occ == datetime.datetime(2015, 3, 1)
    bad = next(r for r in rows if r.date_occ is None)
    assert (bad.lat, bad.weapon_cd, bad.rptd_year) == (None, "102", 2015)


def test_wrong_columns_are_errors(spark, tmp_path):
    path = write_file(tmp_path / "a.csv", INCIDENT_HEADER[:3], [incident()[:3]])
    with pytest.raises(ValueError, match="TIME OCC"):
        read_incidents(spark, path)
    assert read_incidents(spark, path, columns=["dr_no", "date_occ"]).columns == [
        "dr_no", "date_occ"
    ]
    with pytest.raises(ValueError, match="not columns"):
        read_incidents(spark, path, columns=["speed"])
    with pytest.raises(ValueError):
        read_incidents(spark)
    with pytest.raises(ValueError):
        read_incidents(spark, path, fmt="xml")


def test_lookup_tables(spark, tmp_path):
    income = read_income(spark, write_file(tmp_path / "i.csv", INCOME_HEADER, INCOME))
    assert ("90005", 30000) in rows_of(income) and ("90006", None) in rows_of(income)
    revgeo = read_revgeo(spark, write_file(tmp_path / "r.csv", REVGEO_HEADER, REVGEO))
    assert (34.03, -118.5, "90004") in rows_of(revgeo)
    stations = read_stations(spark, write_file(tmp_path / "s.csv", STATION_HEADER, STATIONS))
    assert stations.columns == ["lon", "lat", "division", "prec"]
    assert (-118.25, 34.04, "CENTRAL", "1") in rows_of(stations)


def test_header_is_checked_against_the_schema(spark, tmp_path):
    path = write_file(tmp_path / "a.csv", ("x", "y"), [(1, 2)])
    assert rows_of(read_csv(spark, path, "x int, y int")) == [(1, 2)]
    with pytest.raises(Exception, match="header"):
        read_csv(spark, path, "y int, x int").collect()


def test_files_with_different_headers_are_an_error(spark, tmp_path):
    write_file(tmp_path / "a.csv", ("x", "y"), [(1, 2)])
    write_file(tmp_path / "b.csv", ("y", "x"), [(2, 1)])
    with pytest.raises(Exception, match="header"):
        read_csv(spark, str(tmp_path)).collect()
    with pytest.raises(Exception, match="header"):
        read_csv(spark, str(tmp_path)).select("x").collect()


@pytest.mark.parametrize("sep", [",", "|"])
def test_csv_sink(spark, tmp_path, sep):
    df = spark.createDataFrame([(1, "a,b|c", 0.1), (2, None, None)], "i int, t string, d double")
    path = str(tmp_path / "out")
    write_csv(df.limit(1), path, sep)
    write_csv(df, path, sep)  # replaces
    assert rows_of(read_csv(spark, path, "i int, t string, d double", sep)) == rows_of(df)


def test_csv_sink_padding(spark, tmp_path):
    padded = pad(spark.createDataFrame([(7,)], "month int"), {"month": 5})
    write_csv(padded, str(tmp_path / "trimmed"), keep_blanks=False)
    write_csv(padded, str(tmp_path / "kept"))
    assert rows_of(read_csv(spark, str(tmp_path / "trimmed"))) == [("7",)]
    assert rows_of(read_csv(spark, str(tmp_path / "kept"))) == [("7    ",)]


def test_conversion_keeps_all_rows(spark, tmp_path):
    source = write_file(tmp_path / "a.csv", INCIDENT_HEADER, random_incidents(300, 1))
    plain, laid_out, text = (str(tmp_path / n) for n in ("plain", "laid_out", "text"))
    convert(
        spark,
        [
            Conversion(source, plain, "incidents"),
            Conversion(source, laid_out, "incidents", partition_by=("rptd_year",)),
            Conversion(source, text),
        ],
    )
    columns = stored_columns("incidents")
    direct = rows_of(read_incidents(spark, source, columns=columns))
    assert rows_of(read_incidents(spark, plain, fmt="parquet")) == direct
    assert rows_of(read_incidents(spark, laid_out, fmt="parquet")) == direct
    # A copy that is still text is parsed when read.
    assert rows_of(read_incidents(spark, text, fmt="parquet", columns=columns)) == direct
    mixed = read_incidents(spark, text, plain, fmt="parquet")
    assert rows_of(mixed) == sorted(direct * 2, key=repr)
    year = read_incidents(spark, laid_out, fmt="parquet").filter(F.col("rptd_year") == 2015)
    plan = executed_plan(year.select("dr_no"))
    assert "PartitionFilters: [isnotnull(rptd_year" in plan


def test_one_file_per_small_partition(spark, tmp_path):
    df = spark.range(1000).repartition(8).withColumn("k", F.col("id") % 3)
    path = tmp_path / "p"
    write_parquet(df, str(path), ["k"])
    assert len(list(path.glob("k=*/*.parquet"))) == 3
    assert read_parquet(spark, [str(path)]).count() == 1000


def test_eras_must_agree(spark):
    a = spark.createDataFrame([(1, "x")], "i int, t string")
    b = spark.createDataFrame([("x", 1)], "t string, i int")
    assert rows_of(union_eras(a, b)) == [(1, "x"), (1, "x")]
    with pytest.raises(ValueError, match="differ"):
        union_eras(a, spark.createDataFrame([("1", "x")], "i string, t string"))
    with pytest.raises(ValueError, match="differ"):
        union_eras(a, a.select("i"))


def test_as_typed(spark):
    df = spark.createDataFrame([("1", 2, 3.5)], "a string, b int, c double")
    assert as_typed(df, {"b": "bigint", "a": "int"}).dtypes == [("b", "bigint"), ("a", "int")]


def test_scratch_path(spark):
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first != second
    assert first.startswith(spark.conf.get("spark.checkpoint.dir"))


def test_scratch_path_without_the_setting():
    def session(folder):
        context = SimpleNamespace(getCheckpointDir=lambda: folder)
        return SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=context)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(session(None), "x")
    assert scratch_path(session("hdfs://shared/"), "x").startswith("hdfs://shared/x-")


ODD_TEXTS = ['PARK ""A"", EAST', '"', 'a"b', "x,|y", "  two  ", "", None, "\\", '\\"', "é"]


@pytest.mark.parametrize("sep", [",", "|"])
def test_csv_keeps_any_text(spark, tmp_path, sep):
    rows = [(t, i, i / 2) for i, t in enumerate(ODD_TEXTS)]
    shape = "t string, i int, d double"
    df = spark.createDataFrame(rows, shape)
    write_csv(df, str(tmp_path / "one"), sep)
    assert rows_of(read_csv(spark, str(tmp_path / "one"), shape, sep)) == rows_of(df)
    nulls = read_csv(spark, str(tmp_path / "one"), shape, sep, empty_as_null=True)
    assert nulls.filter("t is null").count() == 2
    lines = df.withColumn("t", F.concat("t", F.lit("\nnext\r\n")))
    with pytest.raises(Exception, match="line break in column t"):
        write_csv(lines, str(tmp_path / "broken"), sep)
    write_csv(lines, str(tmp_path / "lines"), sep, multi_line=True)
    back = read_csv(spark, str(tmp_path / "lines"), shape, sep, multi_line=True)
    # A reader of CSV takes each kind of line end for one line feed.
    assert rows_of(back.select(F.regexp_replace("t", "\r", ""), "i")) == rows_of(
        lines.select(F.regexp_replace("t", "\r", ""), "i")
    )


def test_doubled_quotes_of_a_real_file(spark, tmp_path):
    path = tmp_path / "q.csv"
    path.write_text('LAT,LON,ZIPcode\n34.1,-118.2,"9""0"",1"\n34.2,-118.3,""\n')
    got = rows_of(read_revgeo(spark, str(path)))
    assert sorted(got, key=repr) == [(34.1, -118.2, '9"0",1'), (34.2, -118.3, None)]


def test_partition_folders_keep_zeros(spark, tmp_path):
    source = write_file(tmp_path / "r.csv", REVGEO_HEADER, [("34.1", "-118.2", "01234"), ("34.2", "-118.2", "90001")])
    target = str(tmp_path / "copy")
    convert(spark, [Conversion(source, target, "revgeo", partition_by=("zip",))])
    got = read_revgeo(spark, target, fmt="parquet")
    assert sorted(r.zip for r in got.collect()) == ["01234", "90001"]


def test_read_table_of_other_name(spark, tmp_path):
    path = write_file(tmp_path / "i.csv", INCOME_HEADER, INCOME)
    assert read_table(spark, "income", path, columns=["zip"]).columns == ["zip"]
