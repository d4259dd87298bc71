"""One row per key, the same one on every run.

No form sorts all rows. Where one column of fixed size orders the rows of a key, its extreme is a hash
aggregate, and the few rows that hold it are found again by a join. Otherwise the key alone is counted:
rows of a key that occurs once pass through as they are, and only repeated keys are settled by whole
rows; where the repeated keys are too many to broadcast, all rows move once, by key. Either way each map task already reduces a key to one narrow row, so that a key which holds a
third of the table is no different from any other.

Rows of stored Parquet files need not move at all for many keys (``stored``): what moves is the key, its order columns
and the row's place, and one bit per row then says which rows stay where they are read again. Only keys
whose best rows agree on the whole order are settled by whole rows.

The table is read twice or three times, the first time only its key and order columns; give one that
is stored. The jobs that find the extremes or the repeated keys run when these are called.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lineforge.operators.joins import BROADCAST_BYTES, BROADCAST_ROWS, LEAST_HOT_ROWS, VALUE_BYTES, may_broadcast
from lineforge.storage import materialise, shuffle_tasks

# Types whose values an aggregate can update in place, in a hash table.
FIXED_SIZE = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)

# Repeated keys of up to this many bytes go to every executor, keys alone.
KEY_BYTES = 64 << 20

# Fixed value: rows of one file that a place has room for, as a power of two.
FILE_BITS = 33

# Fixed value: rows whose bits lie together in one row of the table of places. A multiple of 8, part of a bitmap's 32,768.
PIECE = 512


def first_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str] = (), stored: bool = False) -> DataFrame:
    """The row of each key that is smallest by ``order`` (nulls first), then by its other columns.

    ``stored`` says that the rows are those of stored files, each at most once: a table or a selection of its rows
    and columns, not what an explode or a join made of them.
    """
    rows, keys = _size(df, key) if stored and order else (0, 0)
    # So many surplus rows that their keys can't be broadcast; the estimate is good to a few percent.
    if (rows - keys) * len(key) * VALUE_BYTES > 2 * KEY_BYTES or (len(order) == 1 and keys > BROADCAST_ROWS):
        placed = _by_place(df, rows, key, order, [F.col(c) for c in order])
        if placed is not None:
            return placed
    if len(order) == 1 and isinstance(df.schema[order[0]].dataType, FIXED_SIZE):
        return _smallest_per_key(df, key, order[0])
    counts = df.groupBy(*key).agg(F.count("*").alias("_rows")).where("_rows > 1")
    repeated = materialise(counts, "repeated-keys")
    rows = repeated.count()
    if not rows:
        return df
    if rows * len(key) * VALUE_BYTES <= KEY_BYTES and may_broadcast(repeated.select(*key), rows, KEY_BYTES):
        once, again = _split(df, repeated, key)
        return once.unionAll(_settled(again, key, order))
    # Keys that would fill a task by themselves go apart; there are no more of them than such tasks.
    total = repeated.agg(F.sum("_rows")).first()[0]
    hot_from = max(math.ceil(total / shuffle_tasks(df.sparkSession)), LEAST_HOT_ROWS)
    heavy = repeated.where(F.col("_rows") > hot_from)
    if heavy.isEmpty():
        return _settled(df.repartition(*key), key, order)
    rest, hot = _split(df, heavy, key)
    return _settled(rest.repartition(*key), key, order).unionAll(_settled(hot, key, order))


def latest_per_key(
    df: DataFrame, key: Sequence[str], order_column: str, tie_break: str, stored: bool = False
) -> DataFrame:
    """The row of each key with the largest ``order_column`` (nulls last), then the smallest tie-break.

    ``stored`` as for ``first_per_key``.
    """
    if not isinstance(df.schema[tie_break].dataType, T.NumericType):
        raise TypeError(f"the tie-break column {tie_break} must be numeric")
    at, tie = F.col(order_column), F.col(tie_break)
    rows, keys = _size(df, key) if stored else (0, 0)
    if keys > BROADCAST_ROWS:
        whole = isinstance(df.schema[tie_break].dataType, T.IntegralType)
        ranked = [at] if order_column == tie_break else [at, F.bitwise_not(tie) if whole else -tie]
        placed = _by_place(df, rows, key, (), ranked, F.max, (at, -tie))
        if placed is not None:
            return placed
    if not isinstance(df.schema[order_column].dataType, FIXED_SIZE):
        return _settled(df, key, (), F.max, (at, -tie))
    if order_column == tie_break:
        largest = df.groupBy(*key).agg(F.max(at).alias("_at"))
        return _settled(_holders(df, largest, key, {order_column: "_at"}), key, (), F.max, (at, -tie))
    # Once a key has one row per value of the order column, the largest one has one tie-break.
    per_value = df.groupBy(*key, order_column).agg(F.min(tie).alias("_tie"))
    without = F.min(F.when(at.isNull(), F.col("_tie")))
    best = per_value.groupBy(*key).agg(
        F.max(at).alias("_at"), F.when(F.max(at).isNull(), without).otherwise(F.max_by("_tie", at)).alias("_tie")
    )
    return _settled(_holders(df, best, key, {order_column: "_at", tie_break: "_tie"}), key, (), F.max, (at, -tie))


def _size(df: DataFrame, key: Sequence[str]) -> tuple[int, int]:
    """Rows, and about how many keys they have, which is not asked of few rows."""
    rows = df.count()
    if rows <= min(BROADCAST_ROWS, KEY_BYTES // VALUE_BYTES):
        return rows, rows
    return rows, df.agg(F.approx_count_distinct(F.xxhash64(*key), 0.02)).first()[0]


def _placed(df: DataFrame) -> DataFrame | None:
    """``df`` with ``_place``, which no two rows of stored files share; None if they can't be told apart by place."""
    try:
        named = df.select("*", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.row_index").alias("_row"))
    except AnalysisException:
        return None
    numbers = F.row_number().over(W.orderBy("_path")).cast("long").alias("_number")
    files = materialise(named.select("_path").distinct().select("_path", numbers), "files")
    place = F.shiftleft("_number", FILE_BITS) + F.col("_row")
    return named.join(F.broadcast(files), "_path").select(*df.columns, place.alias("_place"))


def _by_place(
    df: DataFrame,
    rows: int,
    key: Sequence[str],
    order: Sequence[str],
    ranked: Sequence[Column],
    extreme: Callable[[Column], Column] = F.min,
    before: Sequence[Column] = (),
) -> DataFrame | None:
    """One row per key by its place in stored files; None where that can't be, or too many keys are left open.

    ``ranked`` decides; keys whose best rows are alike in it are settled by ``order`` and ``before``, with whole rows.
    """
    # A piece takes about as much again for its number and its entry in the hash table.
    if rows // 8 * 2 > BROADCAST_BYTES or not may_broadcast(df.select(), 0, BROADCAST_BYTES):
        return None
    placed = _placed(df)
    if placed is None:
        return None
    named = [column.alias(f"_by_{i}") for i, column in enumerate(ranked)]
    # The two are the same row, unless several are alike in what decides.
    ends = [extreme(F.struct(*named, place.alias("_at"))) for place in (F.col("_place"), -F.col("_place"))]
    best = placed.groupBy(*key).agg(ends[0].alias("_one"), ends[1].alias("_other"))
    alone = F.col("_one._at") == -F.col("_other._at")
    left_open = Observation()
    seen = best.observe(left_open, F.count_if(~alone).alias("n")).where(alone).select(F.col("_one._at").alias("_place"))
    # The bitmap functions count from 1, so a place is one bit before its number.
    bits = F.bitmap_construct_agg(F.bitmap_bit_position(F.col("_place") + 1)).alias("_bits")
    bitmaps = seen.groupBy(F.bitmap_bucket_number(F.col("_place") + 1).alias("_bucket")).agg(bits)
    per_bitmap = 32768 // PIECE
    pieces = bitmaps.select("_bucket", "_bits", F.explode(F.sequence(F.lit(0), F.lit(per_bitmap - 1))).alias("_i")).select(
        ((F.col("_bucket") - 1) * per_bitmap + F.col("_i")).alias("_piece"),
        F.substring("_bits", F.col("_i") * (PIECE // 8) + 1, F.lit(PIECE // 8)).alias("_bits"),
    )
    pieces = materialise(pieces, "places")
    bit = F.expr(f"(cast(conv(hex(substring(_bits, int(_place % {PIECE} div 8) + 1, 1)), 16, 10) as int) >> int(_place % 8)) & 1")
    piece = F.expr(f"_place div {PIECE}").alias("_piece")
    kept = placed.select("*", piece).join(F.broadcast(pieces), "_piece").where(bit == 1).select(*df.columns)
    if not left_open.get["n"]:
        return kept
    again = materialise(best.where(~alone).select(*key), "open-keys")
    n = again.count()
    if n * len(key) * VALUE_BYTES > KEY_BYTES or not may_broadcast(again, n, KEY_BYTES):
        return None
    return kept.unionAll(_settled(_split(df, again, key)[1], key, order, extreme, before))


def _smallest_per_key(df: DataFrame, key: Sequence[str], order: str) -> DataFrame:
    """As ``first_per_key``, by one column of fixed size."""
    least = F.when(F.count(order) == F.count("*"), F.min(order))
    return _settled(_holders(df, df.groupBy(*key).agg(least.alias("_least")), key, {order: "_least"}), key, [order])


def _holders(df: DataFrame, best: DataFrame, key: Sequence[str], values: dict[str, str]) -> DataFrame:
    """The rows of ``df`` that hold their key's best values."""
    best = materialise(best.select(*[F.col(k).alias(f"_key_{i}") for i, k in enumerate(key)], *values.values()), "best")
    rows = best.count()
    if rows <= BROADCAST_ROWS and may_broadcast(best, rows, BROADCAST_BYTES):
        best = F.broadcast(best)
    same = [F.col(k).eqNullSafe(F.col(f"_key_{i}")) for i, k in enumerate(key)]
    same += [F.col(column).eqNullSafe(F.col(value)) for column, value in values.items()]
    return df.join(best, reduce(Column.__and__, same), "left_semi")


def _split(df: DataFrame, keys: DataFrame, key: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows whose key is not among ``keys``, which are broadcast, and rows whose key is."""
    named = F.broadcast(keys.select(*[F.col(k).alias(f"_key_{i}") for i, k in enumerate(key)]))
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_key_{i}")) for i, k in enumerate(key)])
    return df.join(named, same, "left_anti"), df.join(named, same, "left_semi")


def _settled(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    extreme: Callable[[Column], Column] = F.min,
    before: Sequence[Column] = (),
) -> DataFrame:
    """One row per key by comparing whole rows: for the few that other means leave open."""
    rest = [c for c in df.columns if c not in key and c not in order]
    placed = [F.struct(*before).alias("_before")] if before else []
    best = extreme(F.struct(*placed, *order, *rest)).alias("_best")
    return df.groupBy(*key).agg(best).select(*[F.col(c) if c in key else F.col(f"_best.{c}").alias(c) for c in df.columns])
