"""Folders that driver and executors share, for tables between two steps."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which executors and driver share.

    Where a session on one machine names none (tests), a temporary folder is set as the checkpoint
    folder; on a cluster that would lie on the driver alone, so there it is an error.
    """
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="checkpoint-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def new_folder(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nobody uses yet."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and its class of paths."""
    kind = spark._jvm.org.apache.hadoop.fs.Path
    return kind(path).getFileSystem(spark._jsc.hadoopConfiguration()), kind


def until_end(spark: SparkSession, path: str) -> str:
    """``path``, which exists, to be deleted when the driver ends; results may be read from it until then."""
    system, kind = file_system(spark, path)
    system.deleteOnExit(kind(path))
    return path
