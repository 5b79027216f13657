"""Gives the executors this package, wherever the driver found it."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

import tarmac

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Once per application: the package's modules as one file that Spark copies to each executor."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(tarmac.__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="tarmac-ship-")) / "tarmac-modules.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, path.relative_to(root.parent))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)
