"""Directories, and where scratch data may live."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

from splitweave.functions.text import join_path


def shared_scratch(spark: SparkSession, name: str) -> str:
    """A new directory under the cluster's shared folder ``spark.checkpoint.dir``.

    Only a local master may do without that setting: its tasks all see this machine's disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
        root = tempfile.mkdtemp(prefix="splitweave-")
    return join_path(root, f"{name}-{uuid.uuid4().hex}")


def _directory(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def qualified(spark: SparkSession, path: str) -> str:
    """The directory, created if missing, with the scheme of the file system that holds it: mounts (``viewfs``) are followed."""
    fs, target = _directory(spark, path)
    fs.mkdirs(target)
    return str(fs.resolvePath(target).toString())


def child_names(spark: SparkSession, path: str, directories: bool = True) -> list[str]:
    """Names of the direct child directories (or files), sorted. One listing call; file contents are not read."""
    fs, target = _directory(spark, path)
    if not fs.exists(target):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(target) if s.isDirectory() == directories)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a directory this library wrote itself."""
    fs, target = _directory(spark, path)
    fs.delete(target, True)
