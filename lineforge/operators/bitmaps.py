"""Exact distinct counts of dense codes, kept as bitmaps that can be merged.

A code is one bit of the bitmap of its bucket, so equal codes vanish where they are read and a
group's bitmaps are bounded by its largest code, not by its rows. Bitmaps of months give those of years by
an *or*, which distinct counts themselves cannot do. Each counted column is read by tasks of its own, so a
task sorts as many narrow rows as its part of the table has, however many columns are counted; give a
stored table, of which each such task reads only its column.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def code_bitmaps(df: DataFrame, codes: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by..., column_name, bucket, bits) of the integer columns ``codes``; null is no code."""
    each = [df.select(*by, F.lit(c).alias("column_name"), F.col(c).cast("long").alias("_code")) for c in codes]
    narrow = reduce(DataFrame.unionAll, each).where("_code is not null")
    bucket = F.bitmap_bucket_number("_code").alias("bucket")
    return narrow.groupBy(*by, "column_name", bucket).agg(F.bitmap_construct_agg(F.bitmap_bit_position("_code")).alias("bits"))


def distinct_codes(bitmaps: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by..., column_name, n_distinct) of bitmaps, merged over all that ``by`` leaves out."""
    merged = bitmaps.groupBy(*by, "column_name", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return merged.groupBy(*by, "column_name").agg(F.sum(F.bitmap_count("bits")).alias("n_distinct"))
