"""Raw lines to one clean row per order line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lineforge.functions import parse_timestamp
from lineforge.functions.casts import typed_columns, unfit
from lineforge.operators.dedup import first_per_key
from lineforge.settings import Settings
from lineforge.sources.csv import MALFORMED

# The two date texts and what is made of them.
DATE_COLUMNS = {
    "order_date_dateorders": ("order_ts", "order_date"),
    "shipping_date_dateorders": ("ship_ts", "ship_date"),
}


def parse_dates(df: DataFrame, settings: Settings) -> DataFrame:
    """Replace the date texts by a timestamp and a date each; unreadable text becomes null."""
    stamps = {
        ts: parse_timestamp(F.col(text), settings.date_format)
        for text, (ts, _) in DATE_COLUMNS.items()
    }
    days = {day: F.to_date(ts) for ts, day in DATE_COLUMNS.values()}
    return df.withColumns(stamps).withColumns(days).drop(*DATE_COLUMNS)


def clean_orders(df: DataFrame, settings: Settings, stored: bool = False) -> tuple[DataFrame, DataFrame]:
    """The clean rows, and the raw rows with a fault.

    Clean rows have a known grain and are unique by it. A row with an unreadable date stays
    among them with a null date and is listed as a fault as well, and so is one with a text that
    its column's type in ``settings.schema`` cannot hold; a row without the grain, or from a
    record with too many or too few fields, is only listed. ``stored`` as for ``first_per_key``.
    """
    whole = df.filter(F.col(MALFORMED).isNull()) if MALFORMED in df.columns else df
    lines = typed_columns(whole, settings.schema) if settings.schema else whole
    known = lines.filter(F.col(settings.grain).isNotNull())
    parsed = parse_dates(known.drop(*settings.drop), settings)
    clean = first_per_key(parsed, [settings.grain], settings.tie_break, stored).drop(*settings.helpers)
    return clean, rejected_orders(df, settings)


OUTCOME = "_outcome"

# What becomes of a raw row: only clean, clean and listed, only listed.
CLEAN, BOTH, LISTED = "clean", "both", "listed"


def sort_orders(df: DataFrame, settings: Settings) -> DataFrame:
    """Every raw row with its outcome, read, cast and parsed once: ``_row`` as it came where it is listed.

    To be stored partitioned by the outcome; ``sorted_clean`` and ``sorted_rejected`` then each
    read what is theirs.
    """
    given = F.struct(*df.columns).alias("_row")
    marked = df.select("*", given, _faults(df, settings).alias("_faults"))
    lines = typed_columns(marked, settings.schema) if settings.schema else marked
    parsed = parse_dates(lines.drop(*settings.drop), settings)
    whole = F.col(f"_row.{MALFORMED}").isNull() if MALFORMED in df.columns else F.lit(True)
    known = whole & F.col(settings.grain).isNotNull()
    listed = F.col("_faults").isNotNull()
    outcome = F.when(~listed, CLEAN).when(known, BOTH).otherwise(LISTED)
    return parsed.withColumns({"_row": F.when(listed, F.col("_row")), OUTCOME: outcome}).where(listed | known)


def sorted_clean(stored: DataFrame, settings: Settings) -> DataFrame:
    """The clean rows of a stored ``sort_orders``, one per grain."""
    lines = stored.where(F.col(OUTCOME) != LISTED).drop("_row", "_faults", OUTCOME)
    return first_per_key(lines, [settings.grain], settings.tie_break, stored=True).drop(*settings.helpers)


def sorted_rejected(stored: DataFrame) -> DataFrame:
    """The listed rows of a stored ``sort_orders``, as ``rejected_orders`` gives them."""
    return stored.where(F.col(OUTCOME) != CLEAN).select("_row.*", "_faults")


def rejected_orders(df: DataFrame, settings: Settings) -> DataFrame:
    """Raw rows with a fault, texts as they were, and the columns at fault as ``_faults``.

    The one text of names unfolds into a row, so that finding the rows and naming their faults is one evaluation.
    """
    return df.select("*", F.explode(_fault_names(df, settings)).alias("_faults"))


def _faults(df: DataFrame, settings: Settings) -> Column:
    """The raw columns at fault, by name; null without any."""
    return F.get(_fault_names(df, settings), F.lit(0))


def _fault_names(df: DataFrame, settings: Settings) -> Column:
    """One text, the raw columns at fault by name; empty without any."""

    def unreadable(text: str) -> Column:
        given = F.trim(F.coalesce(F.col(text), F.lit(""))) != ""
        return given & F.try_to_date(F.col(text), settings.date_format).isNull()

    kinds = {field.name: field.dataType for field in settings.schema or ()}
    grain = F.col(settings.grain)
    kind = kinds.pop(settings.grain, None)
    no_grain = grain.isNull() if kind is None else grain.try_cast(kind).isNull() | unfit(grain, kind)
    faults = [(MALFORMED, F.col(MALFORMED).isNotNull())] if MALFORMED in df.columns else []
    faults += [(settings.grain, no_grain)]
    faults += [
        (name, unfit(F.col(name), kind))
        for name, kind in kinds.items()
        if not isinstance(kind, T.StringType)
    ]
    faults += [(text, unreadable(text)) for text in DATE_COLUMNS]
    named = F.concat_ws(",", *[F.when(fault, F.lit(column)) for column, fault in faults])
    # The names are made once a row; a row without any has the empty text.
    return F.filter(F.array(named), lambda names: names != "")
