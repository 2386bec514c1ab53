"""Shared place for intermediate tables.

Intermediate tables are ordinary Parquet in the folder named by
``spark.checkpoint.dir``, where every executor can read them again after others
are lost. Only a local session without that setting falls back to a temporary
folder.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    configured = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="skylattice-"))
    return spark.sparkContext.getCheckpointDir()


def new_path(spark: SparkSession, purpose: str) -> str:
    """A path in the shared folder that nothing else uses; nothing is created."""
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


@contextmanager
def scratch_table(spark: SparkSession, purpose: str) -> Iterator[str]:
    """A path for one intermediate table, removed at the end of the block."""
    path = new_path(spark, purpose)
    try:
        yield path
    finally:
        delete(spark, path)


def delete(spark: SparkSession, path: str) -> None:
    target, store = _located(spark, path)
    store.delete(target, True)


def list_folders(spark: SparkSession, path: str, prefix: str = "") -> list[str]:
    """Names of the folders in a folder that begin so, in order; none if it is not there."""
    return [name for name in _names(spark, path, folders=True) if name.startswith(prefix)]


def list_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the files in a folder, in order; none if it is not there."""
    return _names(spark, path, folders=False)


def _names(spark: SparkSession, path: str, folders: bool) -> list[str]:
    target, store = _located(spark, path)
    if not store.exists(target):
        return []
    found = [entry for entry in store.listStatus(target) if entry.isDirectory() == folders]
    return sorted(entry.getPath().getName() for entry in found)


def _located(spark: SparkSession, path: str):
    """A path and the file system that holds it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())
