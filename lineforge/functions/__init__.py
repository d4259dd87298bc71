"""Column and header helpers."""

from lineforge.functions.dates import date_key, parse_timestamp
from lineforge.functions.headers import clean_name, clean_names, normalise_headers
from lineforge.functions.numbers import mean, share

__all__ = [
    "clean_name",
    "clean_names",
    "date_key",
    "mean",
    "normalise_headers",
    "parse_timestamp",
    "share",
]
