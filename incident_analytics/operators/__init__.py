"""Joins, lookups, ranking, unions and SQL views. DataFrame in, DataFrame out."""

from incident_analytics.operators.heavy import heavy_keys, join_heavy_keys
from incident_analytics.operators.joins import (
    STRATEGIES,
    fits_broadcast,
    join_with,
    measured_bytes,
    salted_join,
)
from incident_analytics.operators.lookups import (
    assert_unique,
    decode_by_table,
    keep_matching,
    one_per_key,
    repeated_keys,
)
from incident_analytics.operators.nearest import join_nearest
from incident_analytics.operators.ranking import extreme_values, rank_in_group, top_k_per_group
from incident_analytics.operators.sets import union_eras
from incident_analytics.operators.views import register, register_labels, run_script, run_sql

__all__ = [
    "STRATEGIES",
    "assert_unique",
    "decode_by_table",
    "extreme_values",
    "fits_broadcast",
    "heavy_keys",
    "join_heavy_keys",
    "join_nearest",
    "join_with",
    "keep_matching",
    "measured_bytes",
    "one_per_key",
    "rank_in_group",
    "register",
    "register_labels",
    "repeated_keys",
    "run_script",
    "run_sql",
    "salted_join",
    "top_k_per_group",
    "union_eras",
]
