"""Surrogate keys: dense ones 1..N in the order of the natural key, without one task seeing all rows, and
ones that stay from build to build."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lineforge.storage import materialise

# Fixed value: monotonically_increasing_id() puts the partition above this many bits.
ROW_BITS = 33

# Fixed value: the largest int.
LARGEST_KEY = (1 << 31) - 1


def dense_key(df: DataFrame, order_columns: Sequence[str], key_name: str) -> DataFrame:
    """Add ``key_name`` = position of the row by ``order_columns``, nulls first, from 1.

    A global sort cuts the rows into ranges of about equal size whatever their values are,
    since the full natural key is the sort key and hardly repeats. Each row keeps its range
    and its place there; the sorted rows are written out, because the range bounds come from
    a sample and must not be drawn twice. What is left is to add the sizes of the ranges
    before: a table with one row per written partition. The sort and the writing run when this
    is called. More rows than an int can number are an error.
    """
    ordered = df.orderBy(*order_columns).withColumn("_seq", F.monotonically_increasing_id())
    placed = materialise(ordered, f"order-{key_name}")
    placed = placed.withColumns(
        {
            "_range": F.shiftright("_seq", ROW_BITS),
            "_place": F.col("_seq").bitwiseAND((1 << ROW_BITS) - 1),
        }
    )
    before = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_range")
        .agg(F.count("*").alias("_rows"))
        .select("_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    position = F.col("_offset") + F.col("_place") + 1
    too_many = F.raise_error(F.lit(f"{key_name}: more rows than an int can number")).cast("int")
    key = F.when(position <= LARGEST_KEY, position.cast("int")).otherwise(too_many)
    return placed.join(F.broadcast(offsets), "_range").select(*df.columns, key.alias(key_name))


def stable_key(
    df: DataFrame, known: DataFrame, natural_key: Sequence[str], key_name: str
) -> DataFrame:
    """Add ``key_name``: the number that ``known`` has for the natural key, else the next free one.

    ``known`` holds every natural key that was ever numbered, with its number. New keys are numbered
    as by ``dense_key``, after the largest number known, by jobs that run when this is called. Null
    parts of a natural key are equal.
    """
    named = known.select(*[F.col(c).alias(f"_known_{i}") for i, c in enumerate(natural_key)], F.col(key_name).alias(key_name))
    pairs = [F.col(c).eqNullSafe(F.col(f"_known_{i}")) for i, c in enumerate(natural_key)]
    same = reduce(Column.__and__, pairs)
    largest = known.agg(F.coalesce(F.max(key_name), F.lit(0))).first()[0]
    new = dense_key(df.join(named, same, "left_anti"), natural_key, "_place")
    too_many = F.raise_error(F.lit(f"{key_name}: more rows than an int can number")).cast("int")
    number = F.col("_place").cast("long") + largest
    numbered = new.select(*df.columns, F.when(number <= LARGEST_KEY, number.cast("int")).otherwise(too_many).alias(key_name))
    return df.join(named, same).select(*df.columns, key_name).unionByName(numbered)


def extend_keys(known: DataFrame, keyed: DataFrame, natural_key: Sequence[str], key_name: str) -> DataFrame:
    """``known`` with the natural keys of ``keyed`` that it lacks: what the next ``stable_key`` is to know."""
    columns = [*natural_key, key_name]
    have = known.select(*[F.col(c).alias(f"_known_{i}") for i, c in enumerate(natural_key)])
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_known_{i}")) for i, c in enumerate(natural_key)])
    return known.select(*columns).unionByName(keyed.select(*columns).join(have, same, "left_anti"))


def key_report(df: DataFrame, order_columns: Sequence[str], key_name: str) -> DataFrame:
    """One row: how many rows there are and how many do not hold the position they should.

    The keys are the positions of a global sort exactly if each of 1..N occurs once and every
    row but the first comes strictly after its predecessor. Both are checked by equi-joining
    each row to the one before it, which needs no global sort.
    """
    position = F.struct(*order_columns)
    rows = df.select(F.col(key_name).alias("_key"), position.alias("_position"))
    before = rows.select((F.col("_key") + 1).alias("_key"), F.col("_position").alias("_before"))
    in_place = (F.col("_key") == 1) | (F.col("_before") < F.col("_position"))
    checked = rows.join(before, "_key", "left").agg(
        F.count("*").alias("_checked"),
        F.count(F.when(in_place, 1)).alias("_right"),
        F.coalesce(F.min("_key"), F.lit(1)).alias("_least"),
    )
    return checked.select(
        F.col("_checked").alias("total_rows"),
        (F.col("_checked") - F.col("_right") + F.col("_least") - 1).alias("difference_rows"),
    )
