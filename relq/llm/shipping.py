"""Sends this package's source to the executors of a session, and keeps the
batches of whole texts that tasks receive small."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
_sent: set[str] = set()
_folders: list[tempfile.TemporaryDirectory] = []


def ship(spark: SparkSession) -> None:
    """Make the package importable in the session's Python workers, once."""
    context = spark.sparkContext
    if _BATCH not in spark.conf.getAll:  # else the launcher's or user's choice stays
        spark.conf.set(_BATCH, "2000")
    if context.applicationId in _sent:
        return
    top = Path(__file__).resolve().parents[1]
    folder = tempfile.TemporaryDirectory(prefix="relq-ship-")
    target = Path(folder.name) / f"{top.name}.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for source in sorted(top.rglob("*.py")):
            archive.write(source, source.relative_to(top.parent))
    context.addPyFile(str(target))
    _folders.append(folder)  # Spark serves the file from there; gone at exit
    _sent.add(context.applicationId)
