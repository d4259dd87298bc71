"""Ratios over sums that were added up in steps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def mean(total: str | Column, count: str | Column) -> Column:
    """Average from partial sums and counts, as a double; null over no rows."""
    return F.try_divide(F.sum(total).cast("double"), F.sum(count).cast("double"))


def share(part: Column, whole: Column) -> Column:
    """Ratio of two exact sums, as a double; null for an empty whole."""
    return F.try_divide(part.cast("double"), whole.cast("double"))
