"""Where intermediate tables live, and how a plan is cut by writing one.

Everything goes below the folder that ``spark.checkpoint.dir`` names, which every executor
can read, so a lost executor never costs more than its running tasks.
"""

from __future__ import annotations

import math
import re
import tempfile
import threading
from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

# Rows of an order line that one shuffle task handles without effort, and the number of
# tasks beyond which the bookkeeping of a shuffle costs more than larger tasks do.
ROWS_PER_TASK = 2_000_000
MAX_SHUFFLE_TASKS = 40_000

# Masters whose executors are threads of the driver.
ONE_PROCESS = re.compile(r"local(\[[^\]]*\])?")

_own_folders: dict[str, str] = {}
_scratch = threading.local()


def application_id(spark: SparkSession) -> str:
    return spark.conf.get("spark.app.id")


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder; a temporary one only for an unset local session."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not ONE_PROCESS.fullmatch(spark.conf.get("spark.master")):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = application_id(spark)
    if app not in _own_folders:
        _own_folders[app] = tempfile.mkdtemp(prefix="lineforge-")
    return _own_folders[app]


def work_folder(spark: SparkSession) -> str:
    """This application's own part of the shared folder."""
    return f"{shared_folder(spark)}/lineforge-{application_id(spark)}"


def new_path(spark: SparkSession, label: str) -> str:
    return f"{work_folder(spark)}/{label}-{uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, fixes its rows."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    if getattr(_scratch, "paths", None) is not None:
        _scratch.paths.append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What ``materialise`` writes inside, called by this thread, is deleted at the end.

    For a block that also stores the result for which it was written.
    """
    outer = getattr(_scratch, "paths", None)
    _scratch.paths = []
    try:
        yield
    finally:
        paths, _scratch.paths = _scratch.paths, outer
        for name in paths:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


_START_KEY = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def shuffle_tasks(spark: SparkSession) -> int:
    """Number of partitions a shuffle starts with."""
    return int(spark.conf.get(_START_KEY, None) or spark.conf.get("spark.sql.shuffle.partitions"))


def fit_shuffle(spark: SparkSession, rows: int) -> None:
    """Let shuffles start with enough partitions for ``rows``; never with fewer than now.

    Adaptive execution merges partitions that turn out small, but cannot cut a large one
    outside of joins: 200 of them would be hopeless for 100 TB.
    """
    wanted = min(math.ceil(rows / ROWS_PER_TASK), MAX_SHUFFLE_TASKS)
    if wanted > shuffle_tasks(spark):
        spark.conf.set(_START_KEY, str(wanted))
