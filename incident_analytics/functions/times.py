"""Timestamps, years and parts of the day. Column in, Column out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text layout of dates, first hour of each part of the day, and labels.
US_TIMESTAMP = "MM/dd/yyyy hh:mm:ss a"
MORNING, AFTERNOON, EVENING, NIGHT = 5, 12, 17, 21
DAYPARTS = ("Morning", "Afternoon", "Evening", "Night")
DAYPARTS_GREEK = ("Πρωί", "Απόγευμα", "Βράδυ", "Νύχτα")


def us_timestamp(text: Column) -> Column:
    """Timestamp from US text such as ``03/01/2015 01:05:00 PM``; null if unreadable."""
    return F.try_to_timestamp(text, F.lit(US_TIMESTAMP))


def text_year(text: Column) -> Column:
    """The four year digits of a US date text, as text."""
    return F.substring(text, 7, 4)


def hour_of_hhmm(hhmm: Column) -> Column:
    """Hour of a time written as HHMM text or number; null if unreadable."""
    return F.floor(F.trim(hhmm.cast("string")).try_cast("int") / 100).cast("int")


def leading_two_digits(hhmm: Column) -> Column:
    """First two digits of the time as a number without leading zeros.

    This is not the hour for times before 10:00 (630 gives 63, 5 gives 5); kept for results
    that must equal those of files whose times were read as numbers.
    """
    digits = F.trim(hhmm.cast("string")).try_cast("int").cast("string")
    return F.substring(digits, 1, 2).try_cast("int")


def daypart_hour(hhmm: Column, compat: str | None = None) -> Column:
    """The hour that decides on the part of the day, see `daypart`."""
    if compat not in (None, "prefix2"):
        raise ValueError(f"unknown compat mode {compat!r}")
    return hour_of_hhmm(hhmm) if compat is None else leading_two_digits(hhmm)


def daypart_of_hour(
    hour: Column,
    labels: tuple[str, str, str, str] = DAYPARTS,
    unknown: str = "Unknown",
    compat: str | None = None,
) -> Column:
    """Label of the part of day of an hour, see `daypart`."""
    morning, afternoon, evening, night = labels
    label = (
        F.when((hour >= MORNING) & (hour < AFTERNOON), morning)
        .when((hour >= AFTERNOON) & (hour < EVENING), afternoon)
        .when((hour >= EVENING) & (hour < NIGHT), evening)
    )
    if compat is None:
        label = label.when(hour.isNull(), unknown)
    return label.otherwise(night)


def daypart(
    hhmm: Column,
    labels: tuple[str, str, str, str] = DAYPARTS,
    unknown: str = "Unknown",
    compat: str | None = None,
) -> Column:
    """Label of the part of day of an HHMM time.

    ``labels`` are those of morning (5-11), afternoon (12-16), evening (17-20) and night.
    Times that cannot be read are ``unknown``. ``compat="prefix2"`` takes
    `leading_two_digits` for the hour and calls everything else, also null, night.
    """
    return daypart_of_hour(daypart_hour(hhmm, compat), labels, unknown, compat)
