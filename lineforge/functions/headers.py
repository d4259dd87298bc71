"""Header normaliser: free text to snake case. Works on schema metadata, never on rows."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame


def clean_name(header: str) -> str:
    """The ASCII letter and digit runs of a header, lower-cased and joined by ``_``."""
    return "_".join(re.findall("[0-9a-z]+", header.lower()))


def clean_names(headers: Sequence[str]) -> list[str]:
    """Normalise a whole header line; no two may meet in one name and none may vanish."""
    taken: dict[str, str] = {}
    for header in headers:
        name = clean_name(header)
        if not name:
            raise ValueError(f"header {header!r} has no ASCII letter or digit")
        if name in taken:
            raise ValueError(f"headers {taken[name]!r} and {header!r} both become {name!r}")
        taken[name] = header
    return list(taken)


def normalise_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*clean_names(df.columns))
