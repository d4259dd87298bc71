"""Joins from a fact-sized table to tables that are unique on their key.

A table whose counted rows fit is broadcast and the fact stays where it is. A larger one
meets the fact in a shuffle, and there a key with too many fact rows is cut into slices.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lineforge.operators.sweep import sweep_join
from lineforge.storage import ROWS_PER_TASK, materialise, shuffle_tasks

# Up to this many counted rows, and this many bytes of their columns, go to every executor.
BROADCAST_ROWS = 2_000_000
BROADCAST_BYTES = 128 << 20

# What a value of fixed size takes in a row, and a text beside its letters.
VALUE_BYTES = 8

# More versions of one entity than this are swept by day rather than all met by each line.
MANY_VERSIONS = 64

# Fewer rows of one key than this are no burden, whatever the other tasks hold.
LEAST_HOT_ROWS = 100_000

# A hot key is cut finer than a task's share, so that slices which meet in a task add little.
SLICES_PER_TASK = 4

# Hot keys are found in a sample that holds about this many rows of the smallest of them.
SAMPLED_PER_KEY = 2_000


@dataclass(frozen=True)
class Spread:
    """How hot keys of a fact are found and cut.

    ``counted`` is a stored table of ``rows`` rows with the fact's key columns, to be scanned
    once more. ``by`` are fact columns that tell rows of one key apart: they deal the rows
    out to slices, in the same way when a lost task runs again. Unless ``hot_rows`` is given,
    a key is hot if it alone exceeds what a shuffle task would hold on average.
    """

    counted: DataFrame
    by: Sequence[str]
    rows: int
    hot_rows: int | None = None

    def hot_from(self) -> int:
        if self.hot_rows is not None:
            return self.hot_rows
        average = math.ceil(self.rows / shuffle_tasks(self.counted.sparkSession))
        return max(average, LEAST_HOT_ROWS)


def lookup_join(
    fact: DataFrame,
    dim: DataFrame,
    on: Mapping[str, str],
    take: Mapping[str, str] | Sequence[str],
    null_safe: bool = False,
    dim_rows: int | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
    broadcast_bytes: int = BROADCAST_BYTES,
    spread: Spread | None = None,
    during: tuple[str, str, str] | None = None,
    how: str = "left",
) -> DataFrame:
    """Fact plus the dimension columns ``take`` (or source to result name), matched by ``on``.

    ``on`` maps fact to dimension columns. Null keys match only if ``null_safe``. ``during``
    names a fact date and the dimension's two ends of validity, both included. With
    ``dim_rows`` unknown, Spark chooses the join by file size. With it known, a dimension within
    ``broadcast_rows`` and ``broadcast_bytes`` is broadcast, unless the session's threshold
    forbids it; the lengths of its texts are added up for that, and hot keys looked for, by jobs
    that run when this is called.
    """
    taken = dict(take) if isinstance(take, Mapping) else {name: name for name in take}
    side = {column: f"_dim_{column}" for column in on.values()}
    if during is not None:
        side |= {column: f"_dim_{column}" for column in during[1:]}
    right = dim.select(
        *[F.col(column).alias(alias) for column, alias in side.items()],
        *[F.col(column).alias(alias) for column, alias in taken.items()],
    )
    pairs = [(left, side[column]) for left, column in on.items()]
    matches = [_equal(F.col(a), F.col(b), null_safe) for a, b in pairs]
    if during is not None:
        at, start, end = during
        matches += [F.col(at) >= F.col(side[start]), F.col(at) <= F.col(side[end])]

    columns = fact.columns
    small = dim_rows is not None and dim_rows <= broadcast_rows
    if small and may_broadcast(right, dim_rows, broadcast_bytes):
        right = F.broadcast(right)
    elif spread is not None:
        hot = hot_keys(spread, [left for left, _ in pairs])
        if not hot.isEmpty():
            fact, right = _cut(fact, right, pairs, hot, spread.by)
            matches.append(F.col("_slice") == F.col("_dim_slice"))
    joined = fact.join(right, reduce(Column.__and__, matches), how)
    return joined.select(*columns, *taken.values())


def temporal_join(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    at: str,
    start: str,
    end: str,
    take: Mapping[str, str] | Sequence[str],
    how: str = "left",
    many_versions: int = MANY_VERSIONS,
    **options,
) -> DataFrame:
    """Fact plus the version of its entity that was valid on the day ``at``; null if none was.

    A join by entity alone lets a line meet all versions of its entity. With an entity of more than
    ``many_versions``, counted by a job that runs when this is called, lines and versions are swept
    in the order of days instead; versions of an entity must not overlap then. Of more lines than one task
    takes, those of entities which one task can take move by entity alone.
    """
    versions = dim.groupBy(key).count().where(F.col(key).isNotNull()).agg(F.max("count")).first()[0]
    if versions and versions > many_versions:
        rows, hot = fact.count(), None
        if rows > ROWS_PER_TASK and may_broadcast(fact.select(), 0, BROADCAST_BYTES):
            found = hot_keys(options.get("spread") or Spread(fact, by=[at], rows=rows), [key])
            hot = found.select(f"_hot_{key}")
        return sweep_join(fact, dim, key, at, start, end, take, how, hot)
    return lookup_join(fact, dim, {key: key}, take, during=(at, start, end), how=how, **options)


def hot_keys(spread: Spread, keys: list[str]) -> DataFrame:
    """Keys with too many rows for one task, and into how many slices each is cut.

    A sample of the key columns finds them: only the balance of the join depends on it, the
    result does not. There are about as many as shuffle tasks at most, since that many shares
    hold all rows, so they can be broadcast. They are written out, because both sides of the
    join must cut the same keys.
    """
    hot_from = spread.hot_from()
    fraction = min(1.0, SAMPLED_PER_KEY / hot_from)
    seen = spread.counted.select(*[F.col(key).alias(f"_hot_{key}") for key in keys])
    if fraction < 1:
        seen = seen.sample(fraction, seed=1)
    counts = seen.groupBy(*seen.columns).agg((F.count("*") / fraction).alias("_rows"))
    slices = F.ceil(F.col("_rows") * SLICES_PER_TASK / hot_from).cast("int").alias("_slices")
    hot = counts.filter(F.col("_rows") > hot_from).select(*seen.columns, slices)
    return materialise(hot, "hot-keys")


def may_broadcast(df: DataFrame, rows: int, most_bytes: int) -> bool:
    """Whether ``rows`` counted rows fit, by the lengths of their texts, and broadcasts are on."""
    threshold = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold")
    if threshold.startswith("-"):
        return False
    fixed = rows * len(df.columns) * VALUE_BYTES
    texts = [F.octet_length(name) for name, kind in df.dtypes if kind in ("string", "binary")]
    if fixed > most_bytes or not texts:
        return fixed <= most_bytes
    lengths = [F.coalesce(F.sum(text.cast("long")), F.lit(0)) for text in texts]
    return fixed + df.agg(reduce(Column.__add__, lengths)).first()[0] <= most_bytes


def _equal(a: Column, b: Column, null_safe: bool) -> Column:
    return a.eqNullSafe(b) if null_safe else a == b


def _cut(
    fact: DataFrame,
    right: DataFrame,
    pairs: list[tuple[str, str]],
    hot: DataFrame,
    by: Sequence[str],
) -> tuple[DataFrame, DataFrame]:
    """Give each fact row a slice of its key, and each dimension row one copy per slice."""

    def with_slices(df: DataFrame, columns: list[str]) -> DataFrame:
        same = [
            F.col(column).eqNullSafe(F.col(f"_hot_{left}"))
            for column, (left, _) in zip(columns, pairs)
        ]
        return df.join(F.broadcast(hot), reduce(Column.__and__, same), "left")

    slices = F.coalesce(F.col("_slices"), F.lit(1))
    left_side = with_slices(fact, [left for left, _ in pairs])
    dealt = F.pmod(F.xxhash64(*by), slices).cast("int")
    left_side = left_side.select(*fact.columns, dealt.alias("_slice"))
    right_side = with_slices(right, [column for _, column in pairs])
    copies = F.explode(F.sequence(F.lit(0), slices - 1)).alias("_dim_slice")
    return left_side, right_side.select(*right.columns, copies)
