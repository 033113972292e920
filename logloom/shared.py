"""The shared folder for checkpoints and intermediate tables, and folders in general."""

from __future__ import annotations

import atexit
import functools
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


@functools.cache
def _local_root() -> str:
    """A temporary folder that goes with this process."""
    root = tempfile.mkdtemp(prefix="logloom-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    return root


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name under the one the cluster names for checkpoints.

    Only a local session may fall back to a temporary folder: other machines
    would not see it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = _local_root()
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def list_folders(spark: SparkSession, pattern: str) -> list[str]:
    """Folders that match a glob pattern, on whatever storage it names."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return [s.getPath().toString() for s in found or () if s.isDirectory()]


def delete_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
