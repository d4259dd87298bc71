"""Catalog tables in layers."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# How stored tables are written.
FILES = {"compression": "zstd", "parquet.writer.version": "PARQUET_2_0"}


def create_layers(spark: SparkSession, schemas: Iterable[str], location: str | None = None) -> None:
    """One schema per layer; below ``location`` their tables lie in the shared folder."""
    for schema in schemas:
        place = "" if location is None else " LOCATION :place"
        args = {} if location is None else {"place": f"{location}/{schema}"}
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS IDENTIFIER(:schema){place}", {"schema": schema, **args})


def write_table(df: DataFrame, name: str) -> DataFrame:
    """Full refresh of a managed table, data and schema; returns the table as read back."""
    write_counted(df, name)
    return df.sparkSession.table(name)


def write_counted(
    df: DataFrame, name: str, partition_by: Sequence[str] = (), buckets: int = 0, bucket_by: str | None = None
) -> int:
    """As ``write_table``; the number of rows, counted by the tasks that write them.

    ``buckets`` and ``bucket_by`` store the table dealt by a key, one file per bucket, so that
    tables dealt alike join on that key without a shuffle. Files are compressed by zstd, which takes
    clearly fewer bytes than the default for texts and amounts, and hold ids and amounts as differences.
    """
    written = Observation()
    if buckets:
        df = df.repartition(buckets, bucket_by)
    counted = df.observe(written, F.count(F.lit(1)).alias("n"))
    writer = counted.write.mode("overwrite").options(**FILES).partitionBy(*partition_by)
    if buckets:
        writer = writer.bucketBy(buckets, bucket_by).sortBy(bucket_by)
    writer.saveAsTable(name)
    return written.get["n"]
