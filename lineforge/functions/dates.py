"""Date text and date keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_timestamp(text: Column, date_format: str) -> Column:
    """Text to a zone-free timestamp; null where the text does not fit the format.

    ``try_to_date`` only tests the text. Going through a zoned timestamp instead would move
    local times that a daylight-saving change of the session zone skips.
    """
    fits = F.try_to_date(text, date_format).isNotNull()
    return F.when(fits, F.to_timestamp_ntz(text, F.lit(date_format)))


def date_key(day: Column) -> Column:
    """``yyyyMMdd`` as an int."""
    return F.date_format(day, "yyyyMMdd").cast("int")
