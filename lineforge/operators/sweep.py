"""Temporal join for entities with many versions: each line meets one version, not all of its entity's.

Versions and lines are sorted together by entity and day, a version before the lines of its first
day; the last version above a line is the only one that can hold its day, since the versions of
an entity don't overlap. The sort cuts the rows into ranges of about equal size, an entity with very
many lines into several; what a range's first lines lack is the last version of the ranges before, one row
per range. The work is that of one sort, whatever the number of versions.

Entities that no task is too small for need no ranges: given the others, their lines and versions move once, by entity, and
are swept as they arrive.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lineforge.operators.keys import ROW_BITS
from lineforge.storage import materialise

# Fixed value: parts that the lines of one entity and day are dealt into, for ranges to be cut between.
DEALT = 1 << 12


def sweep_join(
    lines: DataFrame,
    versions: DataFrame,
    key: str,
    at: str,
    start: str,
    end: str,
    take: Mapping[str, str] | Sequence[str],
    how: str = "left",
    hot: DataFrame | None = None,
) -> DataFrame:
    """Lines plus the columns ``take`` (or source to result name) of the version valid on the day ``at``.

    As ``temporal_join`` for versions that don't overlap: both ends count, null keys and days find
    nothing, and ``how`` is left or inner. The sort and the writing of the sorted rows run when
    this is called. ``hot`` has one column, the entities with too many lines for one task, which are few: only these
    are sorted and written then.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"how must be left or inner, not {how}")
    if hot is not None:
        hot = hot.toDF("_hot")
        parts = [[df.join(F.broadcast(hot), F.col(key).eqNullSafe(F.col("_hot")), side) for df in (lines, versions)] for side in ("left_anti", "left_semi")]
        cold = _swept(*parts[0], key, at, start, end, take, how, by_key=True)
        return cold if hot.isEmpty() else cold.unionAll(_swept(*parts[1], key, at, start, end, take, how))
    return _swept(lines, versions, key, at, start, end, take, how)


def _swept(
    lines: DataFrame,
    versions: DataFrame,
    key: str,
    at: str,
    start: str,
    end: str,
    take: Mapping[str, str] | Sequence[str],
    how: str,
    by_key: bool = False,
) -> DataFrame:
    """All entities by ranges of the sorted rows, or ``by_key`` each by one task."""
    taken = dict(take) if isinstance(take, Mapping) else {name: name for name in take}
    version = F.struct(
        F.col(key).alias("key"),
        F.col(end).alias("end"),
        *[F.col(source).alias(f"take_{i}") for i, source in enumerate(taken)],
    )
    known = versions.where(F.col(key).isNotNull() & F.col(start).isNotNull()).select(
        F.col(key).alias("_key"), F.col(start).alias("_day"), F.lit(0).alias("_kind"), F.lit(0).cast("long").alias("_deal"), version.alias("_version")
    )
    asked = lines.select(
        F.col(key).alias("_key"),
        F.col(at).alias("_day"),
        F.lit(1).alias("_kind"),
        # Parts the lines of one entity and day, so that they can lie in several ranges.
        F.pmod(F.xxhash64(*lines.columns), F.lit(DEALT)).alias("_deal"),
        F.struct(*lines.columns).alias("_line"),
    )
    both = asked.unionByName(known, allowMissingColumns=True)
    holds = (F.col("_valid.key") == F.col("_key")) & (F.col("_valid.end") >= F.col("_day"))
    values = [F.when(holds, F.col(f"_valid.take_{i}")).alias(name) for i, name in enumerate(taken.values())]

    def shown(swept: DataFrame) -> DataFrame:
        kept = swept.where(holds) if how == "inner" else swept
        return kept.select(*[F.col("_line").getField(c).alias(c) for c in lines.columns], *values)

    if by_key:
        so_far = W.partitionBy("_key").orderBy("_day", "_kind").rowsBetween(W.unboundedPreceding, W.currentRow)
        return shown(both.drop("_deal").withColumn("_valid", F.last("_version", ignorenulls=True).over(so_far)).where("_kind = 1"))
    ordered = both.orderBy("_key", "_day", "_kind", "_deal").drop("_deal").withColumn("_seq", F.monotonically_increasing_id())
    placed = materialise(ordered, "sweep").withColumn("_range", F.shiftright("_seq", ROW_BITS))

    last_of_range = placed.groupBy("_range").agg(F.max(F.when(F.col("_version").isNotNull(), F.col("_seq"))).alias("_last"))
    before = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    carried = last_of_range.select("_range", F.max("_last").over(before).alias("_last"))
    known_at = placed.where("_kind = 0").select(F.col("_seq").alias("_last"), F.col("_version").alias("_carried"))
    carried = known_at.join(F.broadcast(carried), "_last")
    above = W.partitionBy("_range").orderBy("_seq").rowsBetween(W.unboundedPreceding, W.currentRow)
    swept = placed.withColumn("_own", F.last("_version", ignorenulls=True).over(above))
    swept = swept.join(F.broadcast(carried.select("_range", "_carried")), "_range", "left")
    swept = swept.where("_kind = 1").withColumn("_valid", F.coalesce("_own", "_carried"))
    return shown(swept)
