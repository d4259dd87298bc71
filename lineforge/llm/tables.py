"""Tables in the shared folder between the steps of an operation, and joins by their sizes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lineforge.storage import materialise

# A join side is broadcast only if its counted rows, at their width, stay below this.
BROADCAST_BYTES = 32 << 20


def written(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage: write to the cluster's shared folder, read back."""
    return materialise(df, label)


def if_small(df: DataFrame, row_bytes: int) -> DataFrame:
    """A written table with a broadcast hint if its counted rows are few; else left to a shuffle join."""
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df
