"""The corpus pipeline: documents to packed training sequences in five stages.

Each stage works on all that its predecessor kept, and its result is written and read again before
the next one. All but the last return the columns of ``documents``; texts that a stage changes have
their ``n_chars`` changed along.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lineforge.llm import lines, minhash, packing, quality, secrets
from lineforge.llm.shipping import ship_package
from lineforge.llm.tables import written


def _counted(docs: DataFrame, columns: list[str]) -> DataFrame:
    """The given columns, with ``n_chars`` as the length of a text that is not null."""
    if "n_chars" in columns:
        docs = docs.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))
    return docs.select(*columns)


def keep_good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the classifier rejects; it learns from labelled rows of this input."""
    ship_package(spark)
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove lines that occur before, also with few edits; every document stays."""
    ship_package(spark)
    return _counted(lines.drop_repeated_lines(docs, lines.EVERY_LINE), docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each group of near copies."""
    ship_package(spark)
    return minhash.drop_near_copies(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace found secrets by a mark."""
    ship_package(spark)
    return _counted(secrets.masked(docs), docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokenise and pack all documents into sequences; one row per piece."""
    ship_package(spark)
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", keep_good_quality),
    ("line dedup", drop_repeated_lines),
    ("near-duplicates", drop_near_copies),
    ("secret scan", mask_secrets),
    ("packing", pack),
]

# Scores of a trained model, edit distances, similarity links and token ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
