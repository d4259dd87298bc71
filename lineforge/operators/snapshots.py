"""Slowly changing dimension, type 2, from what was really seen on several days.

An observation says what an entity's attributes were on a day. A version lasts from the day on which its
values were first seen to the day before other ones were; the last one goes on. Observations of one
day are reduced to one before anything meets, so an entity has at most as many rows as there are days,
whatever share of the lines is its own.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lineforge.operators.dedup import latest_per_key

# Fixed value: the end of a version that goes on.
FAR = "9999-12-31"

VALIDITY = ("start_date", "end_date", "is_current", "last_seen")


def day_observations(
    lines: DataFrame, key: str, at: str, tracked: Sequence[str], tie_break: str, stored: bool = False
) -> DataFrame:
    """(key, at, tracked...): what the line with the largest ``tie_break`` of each entity and day says.

    Lines without a day say nothing; a null key is an entity like any other. ``stored`` as for ``first_per_key``.
    """
    dated = lines.where(F.col(at).isNotNull()).select(key, at, *tracked, tie_break)
    return latest_per_key(dated, [key, at], tie_break, tie_break, stored).drop(tie_break)


def scd2_from_snapshots(observations: DataFrame, key: str, at: str, tracked: Sequence[str]) -> DataFrame:
    """Versions (key, tracked..., validity) of entities with at most one observation a day.

    Validity is a closed interval of days; ``last_seen`` is the last day on which the values were
    observed. Null is a value like any other.
    """
    by_day = W.partitionBy(key).orderBy(at)
    values = F.struct(*tracked)
    # Without a day before there are no values before, which differ from null ones.
    changed = F.lag(at).over(by_day).isNull() | ~values.eqNullSafe(F.lag(values).over(by_day))
    runs = observations.withColumn("_changed", changed.cast("int"))
    runs = runs.withColumn("_run", F.sum("_changed").over(by_day.rowsBetween(W.unboundedPreceding, W.currentRow)))
    versions = runs.groupBy(key, "_run", *tracked).agg(F.min(at).alias("start_date"), F.max(at).alias("last_seen"))
    following = F.lead("start_date").over(W.partitionBy(key).orderBy("start_date"))
    return versions.withColumn("_next", following).select(
        key,
        *tracked,
        "start_date",
        F.coalesce(F.date_sub("_next", 1), F.to_date(F.lit(FAR))).alias("end_date"),
        F.col("_next").isNull().alias("is_current"),
        "last_seen",
    )


def merge_snapshots(
    stored: DataFrame, observations: DataFrame, key: str, at: str, tracked: Sequence[str]
) -> DataFrame:
    """Stored versions brought up to date by later observations; untouched entities pass through.

    A stored version counts as observed on its first and last seen day, and a new observation takes the
    place of a stored one of the same day. So merging in the order of days gives what all observations
    at once would; one that comes late splits the version that holds its day.
    """
    new = observations.select(key, at, *tracked).where(F.col(at).isNotNull())
    touched = new.select(F.col(key).alias("_touched")).distinct()
    same = F.col(key).eqNullSafe(F.col("_touched"))
    kept = stored.join(touched, same, "left_anti")
    days = F.explode(F.array_distinct(F.array("start_date", "last_seen"))).alias(at)
    seen = stored.join(touched, same, "left_semi").select(key, days, *tracked)
    replaced = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_new_{i}")) for i, c in enumerate((key, at))])
    seen = seen.join(new.select(F.col(key).alias("_new_0"), F.col(at).alias("_new_1")), replaced, "left_anti")
    rebuilt = scd2_from_snapshots(seen.unionByName(new), key, at, tracked)
    return kept.select(*rebuilt.columns).unionByName(rebuilt)
