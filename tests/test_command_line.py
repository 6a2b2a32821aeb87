from __future__ import annotations

import pytest
from helpers import (
    INCIDENT_HEADER,
    INCOME,
    INCOME_HEADER,
    REVGEO,
    REVGEO_HEADER,
    STATION_HEADER,
    STATIONS,
    random_incidents,
    rows_of,
    write_file,
)

from incident_analytics.__main__ import run
from incident_analytics.plans import (
    daypart_counts,
    station_distance,
    top_months,
    victims_by_income,
)
from incident_analytics.sources import (
    read_csv,
    read_incidents,
    read_income,
    read_parquet,
    read_revgeo,
    read_stations,
)


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    folder = tmp_path_factory.mktemp("files")
    rows = random_incidents(400, 3)
    return {
        "old": write_file(folder / "old.csv", INCIDENT_HEADER, rows[:200]),
        "new": write_file(folder / "new.csv", INCIDENT_HEADER, rows[200:]),
        "revgeo": write_file(folder / "r.csv", REVGEO_HEADER, REVGEO),
        "income": write_file(folder / "i.csv", INCOME_HEADER, INCOME),
        "stations": write_file(folder / "s.csv", STATION_HEADER, STATIONS),
    }


def text_rows(df):
    return rows_of(df.select(*[df[c].cast("string") for c in df.columns]))


def test_reports(spark, files, tmp_path):
    eras = [files["old"], files["new"]]
    incidents = read_incidents(spark, *eras)
    revgeo, income = read_revgeo(spark, files["revgeo"]), read_income(spark, files["income"])
    lookups = ["--revgeo", files["revgeo"], "--income", files["income"]]
    expected = {
        ("top-months",): top_months(incidents),
        ("top-months", "--api", "sql", "-k", "2"): top_months(incidents, 2),
        ("dayparts",): daypart_counts(incidents),
        ("dayparts", "--api", "sql", "--premise", "PARK"): daypart_counts(incidents, "PARK"),
        ("victims", *lookups, "--side", "bottom", "--strategy", "merge"): victims_by_income(
            incidents, revgeo, income, side="bottom"
        ),
        ("station-distance", "--stations", files["stations"], "--route", "repartition"): (
            station_distance(incidents, read_stations(spark, files["stations"]))
        ),
    }
    for i, (command, result) in enumerate(expected.items()):
        out = str(tmp_path / str(i))
        run(spark, [*command, "--incidents", *eras, "--out", out, "--sep", "|"])
        assert text_rows(read_csv(spark, out, sep="|")) == text_rows(result)


def test_convert_then_report(spark, files, tmp_path, capsys):
    target, out = str(tmp_path / "copy"), str(tmp_path / "out")
    layout = ["--table", "incidents", "--partition-by", "rptd_year"]
    run(spark, ["convert", *layout, files["old"], target])
    run(
        spark,
        ["top-months", "--incidents", target, "--format", "parquet", "--out", out]
        + ["--out-format", "parquet"],
    )
    expected = top_months(read_incidents(spark, files["old"]))
    assert rows_of(read_parquet(spark, out)) == rows_of(expected)
    run(spark, ["top-months", "--incidents", target, "--format", "parquet", "--pad", "--show", "5"])
    assert "crime_total" in capsys.readouterr().out
