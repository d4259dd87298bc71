"""A block that a third of all rows share doesn't load the part that names it."""

from __future__ import annotations

from statistics import median

from pyspark.sql import functions as F

from lineforge.llm import naming


def test_parts_of_a_hot_block_are_even(spark, monkeypatch):
    seen = {}

    def kept(df, label, write=naming.written):
        seen[label] = write(df, label)
        return seen[label]

    monkeypatch.setattr(naming, "written", kept)
    text = F.when(F.col("id") % 3 == 0, F.lit("the same text")).otherwise(F.concat(F.lit("text "), F.col("id")))
    docs = spark.range(30_000, numPartitions=6).select(F.col("id").alias("doc_id"), text.alias("text"))
    marked = naming.mark_exact_copies(docs)
    assert marked.where("group_size = 10000 and keep_id = 0").count() == 10_000
    assert marked.where("kept").count() == 20_001
    # What a part names: a row per batch of the hot block, and all places are found again by number.
    numbered = seen["numbered"].groupBy(F.input_file_name()).count().collect()
    sizes = [r["count"] for r in numbered]
    assert max(sizes) < 1.2 * median(sizes)
    assert seen["names"].count() == 30_000
