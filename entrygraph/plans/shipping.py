"""Sending the package to the executors, which need not have it installed."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, once a Spark context."""
    context = spark.sparkContext
    if getattr(context, "_entrygraph_sent", False):
        return
    root = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="entrygraph-code-")) / "entrygraph.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for source in sorted(root.rglob("*.py")):
            z.write(source, source.relative_to(root.parent).as_posix())
    context.addPyFile(str(archive))
    context._entrygraph_sent = True
