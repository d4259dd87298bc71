"""The calendar that the data spans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lineforge.functions import date_key

# What Spark's dayofweek gives for Sunday and Saturday.
WEEKEND = (1, 7)


def date_bounds(df: DataFrame, start_columns: Sequence[str], end_columns: Sequence[str]) -> DataFrame:
    """One row: the first date of the start columns and the last date of the end columns."""
    first = [F.min(c) for c in start_columns]
    last = [F.max(c) for c in end_columns]
    return df.agg(
        (F.least(*first) if len(first) > 1 else first[0]).alias("d_min"),
        (F.greatest(*last) if len(last) > 1 else last[0]).alias("d_max"),
    )


def date_spine(bounds: DataFrame) -> DataFrame:
    """Every day between the bounds, ends included; no day for null bounds."""
    days = F.sequence("d_min", "d_max", F.expr("interval 1 day"))
    return bounds.select(F.explode(days).alias("full_date"))


def build_date_dimension(
    df: DataFrame, start_columns: Sequence[str], end_columns: Sequence[str]
) -> DataFrame:
    """The calendar with its key and parts. The bounds stay in the plan, nothing is fetched."""
    day = F.col("full_date")
    return date_spine(date_bounds(df, start_columns, end_columns)).select(
        day,
        date_key(day).alias("date_key"),
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "EEEE").alias("day_of_week"),
        F.dayofweek(day).isin(*WEEKEND).alias("is_weekend"),
    )
