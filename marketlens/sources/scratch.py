"""A folder for tables that a job writes and reads again."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import SparkSession

_MADE: list[tuple[SparkSession, str]] = []


def scratch_folder(spark: SparkSession) -> str:
    """A new folder below the one that ``spark.checkpoint.dir`` names, which all executors reach; it goes when Python ends.

    Only a local session that names none gets a temporary folder.
    """
    shared = spark.sparkContext.getCheckpointDir() or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if shared is None:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir names no folder that all executors share")
        shared = tempfile.mkdtemp(prefix="marketlens-scratch-")
    path = f"{shared.rstrip('/')}/marketlens-{uuid.uuid4().hex}"
    _MADE.append((spark, path))
    return path


@atexit.register
def _delete() -> None:
    for spark, path in _MADE:
        with contextlib.suppress(Exception):  # the session may have ended before
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
