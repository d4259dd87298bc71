"""The package's own code on executors that don't have it installed."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

import lineforge

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Let Spark hand this package's source to its Python workers, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(lineforge.__file__).parent
    target = Path(tempfile.mkdtemp(prefix="lineforge-code-")) / "lineforge-code.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, file.relative_to(root.parent))
    context.addPyFile(str(target))
    _shipped.add(context.applicationId)
