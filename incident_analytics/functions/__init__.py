"""Column expressions: Column in, Column out, no Python code per row."""

from incident_analytics.functions.geo import haversine_km, is_degrees, is_located
from incident_analytics.functions.money import currency_to_int
from incident_analytics.functions.sums import mean_of_units, sum_of_units, to_units
from incident_analytics.functions.text import DESCENT_LABELS, decode, has_prefix, pad
from incident_analytics.functions.times import (
    DAYPARTS,
    DAYPARTS_GREEK,
    daypart,
    daypart_hour,
    daypart_of_hour,
    hour_of_hhmm,
    text_year,
    us_timestamp,
)

__all__ = [
    "DAYPARTS",
    "DAYPARTS_GREEK",
    "DESCENT_LABELS",
    "currency_to_int",
    "daypart",
    "daypart_hour",
    "daypart_of_hour",
    "decode",
    "has_prefix",
    "haversine_km",
    "hour_of_hhmm",
    "is_degrees",
    "is_located",
    "mean_of_units",
    "pad",
    "sum_of_units",
    "text_year",
    "to_units",
    "us_timestamp",
]
