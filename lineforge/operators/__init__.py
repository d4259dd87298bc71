"""Reusable operators, each a function from DataFrames to a DataFrame."""

from lineforge.operators.bitmaps import code_bitmaps, distinct_codes
from lineforge.operators.calendar import build_date_dimension, date_bounds, date_spine
from lineforge.operators.dedup import first_per_key, latest_per_key
from lineforge.operators.dimension import build_dimension, natural_rows
from lineforge.operators.history import (
    current_versions,
    former_versions,
    scd2_simulated,
    scd2_versions,
)
from lineforge.operators.joins import Spread, lookup_join, temporal_join
from lineforge.operators.keys import dense_key, extend_keys, key_report, stable_key
from lineforge.operators.profile import profile_constant_columns, profile_distinct
from lineforge.operators.snapshots import day_observations, merge_snapshots, scd2_from_snapshots
from lineforge.operators.sweep import sweep_join

__all__ = [
    "Spread",
    "build_date_dimension",
    "build_dimension",
    "code_bitmaps",
    "current_versions",
    "date_bounds",
    "date_spine",
    "day_observations",
    "dense_key",
    "distinct_codes",
    "extend_keys",
    "first_per_key",
    "former_versions",
    "key_report",
    "latest_per_key",
    "lookup_join",
    "merge_snapshots",
    "natural_rows",
    "profile_constant_columns",
    "profile_distinct",
    "scd2_from_snapshots",
    "scd2_simulated",
    "scd2_versions",
    "stable_key",
    "sweep_join",
    "temporal_join",
]
