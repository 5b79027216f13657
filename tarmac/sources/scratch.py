"""Where a job may put intermediate files."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

from tarmac.sources import files

_MADE: list[str] = []  # paths that this process has given out


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder of the cluster (``spark.checkpoint.dir``).

    A session without that setting gets a local folder only if it runs in local mode,
    where there is no other machine to share it with.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tarmac-")
        spark.sparkContext.setCheckpointDir(root)
    path = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _MADE.append(path)
    return path


def remove_scratch(spark: SparkSession) -> int:
    """Deletes what this process has written to scratch paths; returns how many there were.

    For the end of a job: results that were not read or written elsewhere by then are gone with them.
    """
    made = 0
    while _MADE:
        path = _MADE.pop()
        for written in (path, f"{path}.csv", f"{path}.json"):
            if files.exists(spark, written):
                files.delete(spark, written)
                made += 1
    return made
