from __future__ import annotations

import datetime
import math

import pytest
from pyspark.sql import functions as F

from incident_analytics.functions import (
    DAYPARTS_GREEK,
    DESCENT_LABELS,
    currency_to_int,
    daypart,
    decode,
    has_prefix,
    haversine_km,
    is_located,
    pad,
    text_year,
    us_timestamp,
)


def values(spark, inputs, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


def test_us_timestamp(spark):
    texts = ["03/01/2015 01:05:00 PM", "12/31/2010 12:00:00 AM", "2015-01-01", "", None,
             "02/30/2015 01:00:00 AM"]
    assert values(spark, texts, us_timestamp) == [
        datetime.datetime(2015, 3, 1, 13, 5),
        datetime.datetime(2010, 12, 31),
        None,
        None,
        None,
        None,
    ]


def test_text_year(spark):
    assert values(spark, ["03/01/2015 01:05:00 PM", "x", None], text_year) == ["2015", "", None]


TIMES = {
    "0630": "Morning",
    "0005": "Night",
    "0459": "Night",
    "0500": "Morning",
    "1159": "Morning",
    "1200": "Afternoon",
    "1659": "Afternoon",
    "1700": "Evening",
    "2059": "Evening",
    "2100": "Night",
    "2359": "Night",
    " 0630 ": "Morning",
    "": "Unknown",
    "noon": "Unknown",
    None: "Unknown",
}


def test_daypart(spark):
    assert values(spark, list(TIMES), daypart) == list(TIMES.values())


def test_daypart_of_numbers(spark):
    assert values(spark, [630, 5, 1700, None], daypart, "int") == [
        "Morning", "Night", "Evening", "Unknown"
    ]


def test_daypart_prefix2(spark):
    texts = ["0630", "0005", "1159", "1200", "1700", "2100", None, "noon"]
    got = values(spark, texts, lambda c: daypart(c, compat="prefix2"))
    assert got == [
        "Night", "Morning", "Morning", "Afternoon", "Evening", "Night", "Night", "Night"
    ]
    with pytest.raises(ValueError):
        daypart(F.lit("0630"), compat="prefix3")


def test_daypart_labels(spark):
    got = values(spark, ["0630", "1200", "1700", "2100"], lambda c: daypart(c, DAYPARTS_GREEK))
    assert got == list(DAYPARTS_GREEK)


def test_currency(spark):
    texts = ["$12,345", "$12,345.67", "12345", "$1,000. ", "n/a", "", None, "$99,999,999,999"]
    assert values(spark, texts, currency_to_int) == [
        12345, 12345, 12345, 1000, None, None, None, 99999999999
    ]
    odd = ["$12,345.67 USD", "-$5", "12.5k", "$3,000,000,000", "1,23", "9" * 30, "+7.9"]
    assert values(spark, odd, currency_to_int) == [None, -5, None, 3000000000, None, None, 7]


def test_prefix(spark):
    got = values(spark, [1, 19, 100, 199, 210, 21, None], lambda c: has_prefix(c, "1"), "int")
    assert got == [True, True, True, True, False, False, None]


def test_decode(spark):
    codes = ["A", "Z", "H", "-", "", None]
    assert values(spark, codes, lambda c: decode(c, DESCENT_LABELS)) == [
        "Other Asian", "Asian Indian", "Hispanic/Latin/Mexican", "-", "", None
    ]
    assert len(DESCENT_LABELS) == 19
    assert values(spark, codes, lambda c: decode(c, {})) == codes


def test_is_located(spark):
    df = spark.createDataFrame(
        [(34.0, -118.0), (0.0, 0.0), (0.0, -118.0), (34.0, 0.0), (None, -118.0), (34.0, None)],
        "lat double, lon double",
    )
    assert df.filter(is_located(F.col("lat"), F.col("lon"))).collect() == [(34.0, -118.0)]


def test_haversine(spark):
    points = [
        (34.05, -118.24, 34.2, -118.5),
        (0.0, 0.0, 0.0, 180.0),
        (90.0, 0.0, -90.0, 0.0),
        (34.05, -118.24, 34.05, -118.24),
        (91.0, 0.0, 0.0, 0.0),
        (0.0, 0.0, 0.0, 180.5),
        (None, 0.0, 0.0, 0.0),
    ]
    df = spark.createDataFrame(points, "a double, b double, c double, d double")
    got = [r[0] for r in df.select(haversine_km(*map(F.col, "abcd"))).collect()]
    half = math.pi * 6371.0
    assert got[0] == pytest.approx(29.17140218086713, abs=1e-9)
    assert got[1:3] == pytest.approx([half, half])
    assert got[3:] == [0.0, None, None, None]


def test_pad(spark):
    df = spark.createDataFrame([(2015, 7), (None, 12)], "year int, month int")
    assert [tuple(r) for r in pad(df, {"year": 4, "month": 5}).collect()] == [
        ("2015", "7    "), ("null", "12   ")
    ]
