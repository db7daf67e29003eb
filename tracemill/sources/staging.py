"""Intermediate tables in the cluster's shared scratch folder.

A written table cuts the lineage, survives lost executors, and unlike an RDD
checkpoint keeps column pruning, filter pushdown and size statistics.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_local_folders: dict[str, str] = {}
_watched: list[list[str]] = []


def staging_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Where it is unset, only a local session gets a temporary folder: on a cluster
    the executors would not share it.
    """
    folder = spark.conf.get(CHECKPOINT_SETTING, None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder all executors share")
    app = spark.conf.get("spark.app.id", "local")
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="tracemill-")
    return _local_folders[app]


def staging_path(spark: SparkSession, label: str) -> str:
    """A path that nothing has been written to yet."""
    return f"{staging_folder(spark)}/tracemill/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet and return the table read back."""
    path = staging_path(df.sparkSession, label)
    for paths in _watched:
        paths.append(path)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Inside, the shuffle files of a query are deleted as soon as it has ended."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)


@contextmanager
def stored_tables() -> Iterator[list[str]]:
    """The paths of all tables stored inside, by whatever is called there."""
    paths: list[str] = []
    _watched.append(paths)
    try:
        yield paths
    finally:
        # By identity: two lists of the same paths are not one.
        _watched[:] = [other for other in _watched if other is not paths]


def release_paths(spark: SparkSession, paths: list[str]) -> None:
    """Delete stored tables by their paths, once nothing reads them any more."""
    for path in paths:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def release(df: DataFrame) -> None:
    """Delete the stored table that ``df`` reads, once nothing else needs it.

    Only tables under the folder of intermediate tables are ever deleted.
    """
    spark = df.sparkSession
    ours = re.compile(re.escape(staging_folder(spark).split(":")[-1].lstrip("/")) + r"/tracemill/[\w-]+")
    for file in df.inputFiles():
        found = ours.search(file)
        if found:
            folder = spark._jvm.org.apache.hadoop.fs.Path(file[: found.end()])
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
            return
