"""Slowly changing dimension, type 2, with a simulated past.

The source is a snapshot, so a past is made up: customers marked as changed held the base
value until the day before the cutoff and hold their present one since. Everybody else has
had one version from the floor date on. Validity is a closed interval of days.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lineforge.operators.keys import dense_key
from lineforge.settings import History


def mark_changed(df: DataFrame, key: str, tracked: str, history: History) -> DataFrame:
    """Add ``is_changed``; unknown (null) counts as not changed further on."""
    chosen = F.col(key) % history.modulus == 0
    return df.withColumn("is_changed", chosen & (F.col(tracked) != history.base_value))


def _present(tracked: str, history: History) -> list[Column]:
    start = F.when(F.col("is_changed"), F.lit(history.cutoff)).otherwise(F.lit(history.floor))
    return [
        F.col(tracked),
        F.to_date(start).alias("start_date"),
        F.to_date(F.lit(history.far)).alias("end_date"),
        F.lit(True).alias("is_current"),
    ]


def _past(tracked: str, history: History) -> list[Column]:
    return [
        F.lit(history.base_value).alias(tracked),
        F.to_date(F.lit(history.floor)).alias("start_date"),
        F.date_sub(F.to_date(F.lit(history.cutoff)), 1).alias("end_date"),
        F.lit(False).alias("is_current"),
    ]


def _version_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c != "is_changed"] + ["start_date", "end_date", "is_current"]


def current_versions(marked: DataFrame, tracked: str, history: History) -> DataFrame:
    """The version valid today, for every entity."""
    rest = [c for c in marked.columns if c != tracked]
    return marked.select(*rest, *_present(tracked, history)).select(*_version_columns(marked))


def former_versions(marked: DataFrame, tracked: str, history: History) -> DataFrame:
    """The version before the cutoff, for changed entities only."""
    rest = [c for c in marked.columns if c != tracked]
    changed = marked.filter("is_changed")
    return changed.select(*rest, *_past(tracked, history)).select(*_version_columns(marked))


def scd2_versions(marked: DataFrame, tracked: str, history: History) -> DataFrame:
    """All versions: the union of both, in one pass.

    Each row unfolds into its one or two versions, so what leads to ``marked`` is computed
    once, not once per branch of a union.
    """
    present, past = F.struct(*_present(tracked, history)), F.struct(*_past(tracked, history))
    versions = F.when(F.col("is_changed"), F.array(past, present)).otherwise(F.array(present))
    rest = [c for c in marked.columns if c != tracked]
    return marked.select(*rest, F.inline(versions)).select(*_version_columns(marked))


def scd2_simulated(
    df: DataFrame,
    key: str,
    tracked: str,
    history: History,
    key_name: str,
    number: Callable[[DataFrame, Sequence[str], str], DataFrame] = dense_key,
) -> DataFrame:
    """Versioned dimension from one row per entity, with one surrogate key per version."""
    versions = scd2_versions(mark_changed(df, key, tracked, history), tracked, history)
    return number(versions, [key, "start_date"], key_name)
