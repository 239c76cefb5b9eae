"""The folder that driver and executors share."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    Where the session names none, in local mode a temporary one is made and set,
    so that later calls find it. On a cluster that is an error: executors would
    each write to a disk of their own.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if found:
        return found
    if not re.match(r"local(\[[^,]*(,\s*\d+)?\])?$", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and the executors share")
    made = tempfile.mkdtemp(prefix="weftline-")
    atexit.register(shutil.rmtree, made, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(f"file://{made}")
    return f"file://{made}"


def path_of(spark: SparkSession, where: str):
    """A folder's Hadoop path and file system."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(where)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
