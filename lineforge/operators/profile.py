"""Column profiles that tell carried information from junk."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

def profile_distinct(df: DataFrame, columns: Sequence[str], approx: bool = False) -> DataFrame:
    """One row with the number of distinct non-null values per column.

    ``approx`` trades the exact count, whose shuffle grows with the distinct values, for a
    sketch of fixed size per column.
    """
    counted = F.approx_count_distinct if approx else F.countDistinct
    return df.agg(*[counted(c).alias(c) for c in columns])


def profile_constant_columns(df: DataFrame) -> DataFrame:
    """One row per column: values present, and whether there is at most one distinct value.

    One scan turns every value into a fingerprint under its column's number and keeps the smallest
    and the largest per column: two different ones prove the column varied, and no value is
    shuffled, where distinct counts would multiply the shuffled rows by the number of columns. Fingerprints of
    values of up to eight bytes are one to one; the few wider columns with a single fingerprint are
    then settled by their values. What is fetched in between is one row per column.
    """
    columns = df.columns
    values = [F.struct(F.lit(i).alias("number"), _fingerprint(F.col(c)).alias("print")) for i, c in enumerate(columns)]
    prints = df.select(F.inline(F.array(*values)))
    seen = prints.groupBy("number").agg(F.count("print").alias("n"), F.min("print").eqNullSafe(F.max("print")).alias("same"))
    found = {r["number"]: (r["n"], r["same"]) for r in seen.collect()}
    rows = [(c, *found.get(i, (0, True))) for i, c in enumerate(columns)]
    open_columns = [c for c, _, same in rows if same and _is_wide(df, c)]
    settled = [row for row in rows if row[0] not in open_columns]
    result = df.sparkSession.createDataFrame(settled, "column_name string, non_null_rows long, is_constant boolean")
    return result.unionAll(_extremes(df, open_columns)) if open_columns else result


def _extremes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    entries = [
        F.struct(
            F.lit(column).alias("column_name"),
            F.count(column).alias("non_null_rows"),
            F.min(column).eqNullSafe(F.max(column)).alias("is_constant"),
        )
        for column in columns
    ]
    return df.agg(F.array(*entries).alias("_columns")).select(F.inline("_columns"))


def _is_wide(df: DataFrame, column: str) -> bool:
    """Whether a value may take more than eight bytes."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.DecimalType):
        return kind.precision > 18
    fixed = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
    return not isinstance(kind, fixed)


def _fingerprint(value: Column) -> Column:
    return F.when(value.isNotNull(), F.xxhash64(value))
