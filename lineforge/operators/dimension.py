"""Dimension tables: distinct natural key, attributes, surrogate key."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame

from lineforge.operators.dedup import first_per_key
from lineforge.operators.keys import dense_key


def natural_rows(
    df: DataFrame, attributes: Sequence[str], natural_key: Sequence[str], tie_break: str | None = None
) -> DataFrame:
    """One row per natural key; the attributes come from the row with the smallest tie-break.

    ``df`` is a stored table or some of its rows.
    """
    if set(attributes) <= set(natural_key):
        return df.select(*attributes).distinct()
    order = [] if tie_break is None else [tie_break]
    return first_per_key(df.select(*attributes, *order), natural_key, order, stored=True).select(*attributes)


def build_dimension(
    df: DataFrame,
    attributes: Sequence[str],
    natural_key: Sequence[str],
    key_name: str,
    tie_break: str | None = None,
    number: Callable[[DataFrame, Sequence[str], str], DataFrame] = dense_key,
) -> DataFrame:
    """``number`` adds the key: 1..N by the natural key, or ``stable_key`` over the keys known before."""
    return number(natural_rows(df, attributes, natural_key, tie_break), natural_key, key_name)
