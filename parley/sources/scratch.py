"""Folders for files that a query writes and reads again."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import SparkSession


def folder(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder of ``spark.checkpoint.dir``, which a cluster shares; a temporary one only in a local session without that setting."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="parley-files-")
    path = f"{root.rstrip('/')}/parley-{name}-{uuid.uuid4().hex}"
    atexit.register(remove, spark, path)
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a path, and what was written beside it under its name; nothing where the session has ended already."""
    if spark.sparkContext._jsc is None:
        return
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for found in fs.globStatus(target.suffix("*")) or []:
        fs.delete(found.getPath(), True)
