"""The four reports."""

from incident_analytics.plans.dayparts import daypart_counts, daypart_counts_sql
from incident_analytics.plans.month_state import top_months_from_state, update_month_counts
from incident_analytics.plans.station_distance import station_distance
from incident_analytics.plans.top_months import (
    month_counts,
    top_months,
    top_months_report,
    top_months_script,
    top_months_sql,
)
from incident_analytics.plans.victims import income_profile, victims_by_income, victims_of_side

__all__ = [
    "daypart_counts",
    "daypart_counts_sql",
    "income_profile",
    "month_counts",
    "station_distance",
    "top_months",
    "top_months_from_state",
    "top_months_report",
    "top_months_script",
    "top_months_sql",
    "update_month_counts",
    "victims_by_income",
    "victims_of_side",
]
