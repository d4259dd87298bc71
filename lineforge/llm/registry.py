"""Registered queries: each runs one operation, with production parameters, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lineforge.llm import (
    alignment,
    bpe,
    chat,
    collocations,
    lines,
    minhash,
    naming,
    ngram_join,
    packing,
    quality,
    secrets,
    topk,
    warc,
)
from lineforge.llm.oracle import oracle_sql
from lineforge.llm.shipping import ship_package
from lineforge.llm.tables import written

__all__ = ["oracle_sql", "queries"]

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archive_pages(table(spark, folder, "pages"))


def op2_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    weights = quality.fit_quality(quality.training_rows(docs, labels))
    scored = quality.score_quality(docs.select("doc_id", "text"), weights)
    return scored.select(
        "doc_id",
        quality.held_out().alias("held_out"),
        "score",
        (F.col("score") >= quality.QualitySettings().threshold).cast("int").alias("predicted"),
    )


def op3_chat(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    more = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(said).alias("text"),
    )
    windows = chat.format_chats(turns.unionByName(more), public_tokenizers.path("byte_bpe_50k.json"))
    return chat.read_chats(written(windows, "chats"))


def op4_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.secret_digest(table(spark, folder, "documents"))


def op5_lines(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = lines.drop_repeated_lines(table(spark, folder, "documents").select("doc_id", "text"), lines.EVERY_LINE)
    digest = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("text_sha256")
    return cleaned.select("doc_id", "n_lines", "n_removed", "n_links", "classes", digest)


def op6_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op7_minhash(spark: SparkSession, folder: str) -> DataFrame:
    settings = minhash.NearSettings(width=3, percent=85)
    marked = minhash.mark_near_copies(table(spark, folder, "documents"), settings)
    return marked.select("doc_id", "n_shingles", "component_id", "kept")


def op8_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.round_trip(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def op9_naming(spark: SparkSession, folder: str) -> DataFrame:
    return naming.mark_exact_copies(table(spark, folder, "documents"))


def op10_topk(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


def op11_alignment(spark: SparkSession, folder: str) -> DataFrame:
    paths = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.score_alignment(table(spark, folder, "documents"), *paths)


def op12_ngrams(spark: SparkSession, folder: str) -> DataFrame:
    settings = ngram_join.JoinSettings(width=3, percent=90)
    return ngram_join.similar_documents(table(spark, folder, "documents"), settings)


def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(table(spark, folder, "documents"))


def queries() -> dict[str, Query]:
    return {
        f.__name__: f
        for f in (
            op1_warc,
            op2_quality,
            op3_chat,
            op4_secrets,
            op5_lines,
            op6_packing,
            op7_minhash,
            op8_bpe,
            op9_naming,
            op10_topk,
            op11_alignment,
            op12_ngrams,
            op13_collocations,
        )
    }
