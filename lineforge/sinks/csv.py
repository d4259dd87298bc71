"""CSV export: one folder per table."""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Text leaves as it is; by default Spark would trim it on the way out. A quote inside is doubled.
CSV_OPTIONS = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}

# The level of gzip: texts are written once and read once, and the next levels cost more than they save.
FAST = {"zlib.compress.level": "BEST_SPEED"}


def export_csv(
    tables: Mapping[str, DataFrame],
    folder: str,
    single_file: Collection[str] = (),
    largest_first: Mapping[str, str] | None = None,
    compression: str = "none",
) -> None:
    """Write every table to ``folder/<name>`` with a header, all tasks writing in parallel.

    Tables named in ``single_file`` come as one file, which sends them through one task: for
    reports of a few rows only. ``largest_first`` orders the files of a table by a column. Null is
    written empty, an empty string as ``""``. ``compression``, such as ``gzip``, is that of the files.
    """
    for name, df in tables.items():
        rows = df.coalesce(1) if name in single_file else df
        if largest_first and name in largest_first:
            rows = rows.sortWithinPartitions(F.desc(largest_first[name]))
        rows.write.mode("overwrite").options(**CSV_OPTIONS, **FAST).csv(f"{folder}/{name}", compression=compression)
