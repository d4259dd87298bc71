"""Delimited files to bronze rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lineforge.functions import clean_names
from lineforge.functions.casts import typed_columns

# The whole record, where it has more or fewer fields than the header; else null.
MALFORMED = "_malformed"


def ingest_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    encoding: str = "ISO-8859-1",
    infer: bool = False,
    multiline: bool = False,
) -> DataFrame:
    """Bronze rows of the files at ``path``: clean names, the text of every value, audit columns.

    Every value stays the text that the file has, so ``00725`` keeps its zeros, and a record with
    too many or too few fields is kept whole in ``_malformed``. ``schema`` casts columns by
    normalised name, in any order; a text that does not fit its type becomes null then, so leave
    it out where such texts are to be listed (silver does both). Every file's header is checked
    against the first one's. ``infer`` lets Spark guess the types instead, at the price of one
    more pass and without ``_malformed`` ever being set. Quotes inside a quoted value are doubled.
    ``multiline`` allows line breaks inside quoted values; each file is then read by one task.
    Without it a record cut by a line break is malformed.
    """
    reader = spark.read.option("header", True).option("encoding", encoding)
    reader = reader.option("escape", '"').option("multiLine", multiline)
    headers = reader.csv(path).columns
    names = clean_names(headers)
    if infer:
        lines = reader.option("inferSchema", True).csv(path).withColumn(MALFORMED, F.lit(None).cast("string"))
    else:
        fields = [T.StructField(header, T.StringType()) for header in [*headers, MALFORMED]]
        reader = reader.option("enforceSchema", False).option("columnNameOfCorruptRecord", MALFORMED)
        lines = reader.schema(T.StructType(fields)).csv(path)
    bronze = (
        lines.select("*", "_metadata.file_path")
        .toDF(*names, MALFORMED, "_source_file")
        .withColumn("_ingested_at", F.current_timestamp())
        .select(*names, MALFORMED, "_ingested_at", "_source_file")
    )
    return typed_columns(bronze, schema) if schema and not infer else bronze
