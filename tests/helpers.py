"""Small fixtures in the shape of the raw files, and plan inspection."""

from __future__ import annotations

import csv
import random
from pathlib import Path

INCIDENT_HEADER = (
    "DR_NO",
    "Date Rptd",
    "DATE OCC",
    "TIME OCC",
    "AREA ",
    "Premis Desc",
    "Vict Descent",
    "Weapon Used Cd",
    "LAT",
    "LON",
    "Status",
)


def write_file(path: Path, header, rows) -> str:
    with path.open("w", newline="", encoding="utf-8") as out:
        writer = csv.writer(out)
        writer.writerow(header)
        writer.writerows(["" if v is None else v for v in row] for row in rows)
    return str(path)


def incident(**values) -> tuple:
    """One row of an incident file; keys are canonical names."""
    row = {
        "dr_no": 1,
        "date_rptd": "03/02/2015 12:00:00 AM",
        "date_occ": "03/01/2015 12:00:00 AM",
        "time_occ": "0630",
        "area": 1,
        "premis_desc": "STREET",
        "vict_descent": "H",
        "weapon_cd": None,
        "lat": 34.05,
        "lon": -118.24,
        "status": "IC",
    }
    row.update(values)
    return tuple(row.values())


def random_incidents(n: int, seed: int) -> list[tuple]:
    """Messy incidents; a third of them share one place, area, month and descent."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        hot = rng.random() < 1 / 3
        year, month = (2015, 7) if hot else (rng.choice([2013, 2014, 2015]), rng.randint(1, 12))
        day = rng.randint(1, 28)
        clock = rng.choice(["12:00:00 AM", "12:00:00 AM", "01:05:00 PM", "11:59:59 PM"])
        rows.append(
            incident(
                dr_no=rng.choice([i, i, i, None]),
                date_rptd=f"{month:02d}/{day:02d}/{year} 12:00:00 AM",
                date_occ=rng.choice([f"{month:02d}/{day:02d}/{year} {clock}"] * 9 + ["2015-01-01"]),
                time_occ=rng.choice([f"{rng.randint(0, 23):02d}{rng.randint(0, 59):02d}", None]),
                area=1 if hot else rng.choice([1, 2, 3, 4, 99, None]),
                premis_desc=rng.choice(["STREET", "STREET", "PARK", None]),
                vict_descent="H" if hot else rng.choice(["H", "B", "W", "-", None]),
                weapon_cd=rng.choice([1, 19, 100, 199, 102, 210, 400, None]),
                lat=34.01 if hot else rng.choice([34.01, 34.02, 34.03, 34.04, 34.05, 0, None]),
                lon=-118.5 if hot else rng.choice([-118.5, -118.4, 0, None]),
            )
        )
    return rows


REVGEO_HEADER = ("LAT", "LON", "ZIPcode")
REVGEO = [
    (34.01, -118.5, "90001"),
    (34.01, -118.5, "90002"),
    (34.02, -118.5, "90003"),
    (34.03, -118.5, "90004 "),
    (34.04, -118.5, "90005"),
    (34.05, -118.5, "90006"),
    (34.01, -118.4, "90007"),
    (34.02, -118.4, "90001-1"),
    (34.03, -118.4, "90008"),
    (34.04, -118.4, "90009"),
    (34.05, -118.4, None),
]
INCOME_HEADER = ("Zip Code", "Community", "Estimated Median Income")
INCOME = [
    ("90001", "a", "$12,345"),
    ("90003", "b", "$20,000"),
    ("90004", "c", "$20,000"),
    ("90005", "d", "$30,000.50"),
    ("90006", "e", "n/a"),
    ("90007", "f", "$40,000"),
    ("90008", "g", "$50,000"),
    ("90009", "h", "$60,000"),
    ("90009", "h2", None),
    ("90010", "i", "$99,999"),
]
STATION_HEADER = ("X", "Y", "FID", "DIVISION", "LOCATION", "PREC")
STATIONS = [
    (-118.25, 34.04, 1, "CENTRAL", "somewhere", 1),
    (-118.4, 34.1, 2, "RAMPART", "elsewhere", 2),
    (-118.3, 33.9, 3, "SOUTH", "there", 3),
    (None, 33.9, 4, "NOWHERE", "no position", 4),
    (-118.3, 33.9, 5, "NO AREA", "no number", None),
]


def executed_plan(df) -> str:
    """The final plan, after running the query."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


def rows_of(df) -> list[tuple]:
    return sorted((tuple(row) for row in df.collect()), key=repr)
