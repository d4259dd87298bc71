"""Exact duplicates by deterministic block naming.

A normalised text is cut into blocks of a fixed number of bytes. All blocks are dealt into parts and
sorted there, and equal ones get one integer, their *name*: part and rank in it. Then neighbouring names are
paired, the pairs sorted and named in the same way, until each document is down to one name. Texts
are equal exactly if they took the same number of rounds and ended with the same name: contents
are compared by sorting, no hash decides.

Scale: before the sort every task gathers the equal blocks of its batch into one row, and these rows are
written. Only the block itself travels to its part, once per batch, with the row's number; the places where
it occurs stay in the written table and meet the name by that unique number. So a block that a third of
all rows share loads its part with one copy per batch and nothing of its documents. A hash only chooses
the part, which needs no sample of contents at the driver; there are as many parts as the bytes ask for,
and each sorted part is named in one streaming pass, so nothing needs a global count. Later rounds carry
integers only, and only of documents with more than one block left. Blocks are cut by byte positions,
linear in the text.

Defined results: null counts as empty; the empty text is one empty block and all empty texts are
equal; of rows with equal text the smallest ``doc_id`` stays, null last; rows that share that
``doc_id`` too all stay; extra columns are ignored. A group with no other id has a null ``keep_id``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lineforge.llm.tables import written
from lineforge.storage import shuffle_tasks

BLOCK_BYTES = 8192

# Bytes of blocks that one task sorts.
PART_BYTES = 128 << 20


def normalised(text: F.Column) -> F.Column:
    """Each run of white space becomes one space; null becomes empty."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per batch one numbered row for each distinct block, with the list of its places."""
    number = TaskContext.get().partitionId() << 40
    for batch in batches:
        blocks = batch.column(0).dictionary_encode()
        which, n = blocks.indices.to_numpy(zero_copy_only=False), len(blocks.dictionary)
        order = np.argsort(which, kind="stable")
        ends = np.cumsum(np.bincount(which, minlength=n))
        lists = pa.ListArray.from_arrays(
            pa.array(np.concatenate([[0], ends]), pa.int32()), batch.column(1).take(pa.array(order))
        )
        numbers = pa.array(np.arange(number, number + n))
        number += n
        yield pa.RecordBatch.from_arrays([numbers, blocks.dictionary, lists], names=["number", "block", "at"])


def _name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One name per run of equal blocks in a sorted part; all that is held is the last block."""
    name, last = (TaskContext.get().partitionId() << 40) - 1, None
    for batch in batches:
        if not batch.num_rows:
            continue
        # Rows are sorted, so numbers by first appearance follow the order.
        blocks = batch.column(0).dictionary_encode()
        names = blocks.indices.to_numpy(zero_copy_only=False).astype(np.int64) + name + (blocks.dictionary[0].as_py() != last)
        name, last = int(names[-1]), blocks.dictionary[-1].as_py()
        yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(names)], names=["number", "name"])


def name_blocks(blocks: DataFrame) -> DataFrame:
    """Rows (block, at) as the fields of ``at`` and a ``name``, equal for equal blocks. Runs jobs."""
    kind = blocks.schema["at"].dataType
    listed = [T.StructField("number", T.LongType()), blocks.schema["block"], T.StructField("at", T.ArrayType(kind))]
    gathered = written(blocks.mapInArrow(_gather, T.StructType(listed)), "blocks")
    size = gathered.agg(F.coalesce(F.sum(F.octet_length("block").cast("long")), F.lit(0))).first()[0]
    tasks = max(shuffle_tasks(blocks.sparkSession), math.ceil(size / PART_BYTES))
    parts = gathered.select("block", "number").repartition(tasks, "block").sortWithinPartitions("block")
    names = written(parts.mapInArrow(_name, "number long, name long"), "numbered")
    placed = gathered.select("number", "at").join(names, "number").select(F.explode("at").alias("at"), "name")
    return written(placed.select("at.*", "name"), "names")


def identities(rows: DataFrame) -> DataFrame:
    """Rows (bytes, key) as (key, level, name): one identity each, the same for equal bytes only.

    The running number ``row`` is drawn in the same job that cuts the blocks and is stored with
    their names, so it never has to be drawn again.
    """
    n_blocks = F.greatest(F.lit(1), F.ceil(F.octet_length("bytes") / F.lit(BLOCK_BYTES)).cast("int"))
    blocks = (
        rows.select("bytes", "key", n_blocks.alias("n"), F.monotonically_increasing_id().alias("row"))
        .select("bytes", "key", "n", "row", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("place"))
        .select(
            F.substring("bytes", F.col("place") * BLOCK_BYTES + 1, F.lit(BLOCK_BYTES)).alias("block"),
            F.struct("row", "place", "n", F.when(F.col("place") == 0, F.col("key")).alias("key")).alias("at"),
        )
    )
    names, level, ended = name_blocks(blocks), 0, []
    most = names.agg(F.max("n")).first()[0] or 1
    while True:
        ended.append(names.where("n = 1").select("key", F.lit(level).alias("level"), "name"))
        if most == 1:
            return reduce(DataFrame.unionAll, ended)
        even = F.col("place") % 2 == 0
        pairs = (
            names.where("n > 1")
            .groupBy("row", F.expr("place div 2").cast("int").alias("place"), "n")
            .agg(
                F.max(F.when(even, F.col("name"))).alias("left"),
                F.max(F.when(~even, F.col("name"))).alias("right"),
                F.first("key", ignorenulls=True).alias("key"),
            )
            .select(
                F.encode(F.concat_ws(":", "left", F.coalesce("right", F.lit(-1))), "utf-8").alias("block"),
                F.struct("row", "place", F.ceil(F.col("n") / 2).cast("int").alias("n"), "key").alias("at"),
            )
        )
        names, level, most = name_blocks(pairs), level + 1, -(-most // 2)


def mark_exact_copies(docs: DataFrame) -> DataFrame:
    """One row per document: which one stays, how many are equal, and a digest of the text compared."""
    rows = docs.select("doc_id", normalised(F.col("text")).cast("binary").alias("bytes"))
    keyed = rows.select("bytes", F.struct("doc_id", F.sha2("bytes", 256).alias("text_sha256")).alias("key"))
    ids = identities(keyed).select("key.*", "level", "name")
    groups = ids.groupBy("level", "name").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n")).where("n > 1")
    # Written, so that the join can split a group that holds a large share of all rows.
    joined = ids.join(written(groups, "groups"), ["level", "name"], "left")
    keep = F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("first_id"))
    return joined.select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("n", F.lit(1)).alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        "text_sha256",
    )
