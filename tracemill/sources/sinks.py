"""Writers. Each writes a folder of part files, one per task."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracemill.sources.records import text_schema


def _json(df: DataFrame, mode: str, path: str) -> None:
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def append_json_lines(df: DataFrame, path: str) -> None:
    """Add rows to a folder of JSON lines; null fields stay visible."""
    _json(df, "append", path)


def create_json_lines(df: DataFrame, path: str, overwrite: bool = False) -> None:
    """Write a new folder; refuse one that exists unless told to replace it."""
    _json(df, "overwrite" if overwrite else "errorifexists", path)


def replace_json_lines(df: DataFrame, path: str) -> None:
    """Write cleaned traces, replacing what was there."""
    _json(df, "overwrite", path)


def write_training_text(df: DataFrame, path: str, overwrite: bool = False) -> None:
    """Write the ``text`` column alone, as Parquet. A row without text stops the write."""
    missing = F.raise_error(F.lit("a training row has no text"))
    whole = F.when(F.col("text").isNull(), missing).otherwise(F.col("text"))
    df.select(whole.alias("text")).write.mode("overwrite" if overwrite else "errorifexists").parquet(path)


COMMITS = "_commits"


def _file_system(spark: SparkSession, path: str):
    """Hadoop's file system for a path, and its path type."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path
    return hadoop_path(path).getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def append_once(df: DataFrame, path: str, name: str) -> bool:
    """Add the rows of a writing called ``name`` to a folder of JSON lines, once.

    Rows go to a folder of their own, and a record that it is whole is written last, by
    renaming. Until then :func:`read_committed` does not see them, and a repeated writing
    replaces what a failed one left. If the record is there already, nothing is done and the
    answer is False.
    """
    if not name or not all(c.isalnum() or c in "-_." for c in name) or name[0] in "_.":
        raise ValueError(f"not a name for a writing: {name!r}")
    spark = df.sparkSession
    files, hadoop_path = _file_system(spark, path)
    record = hadoop_path(f"{path}/{COMMITS}/{name}")
    if files.exists(record):
        return False
    replace_json_lines(df, f"{path}/write={name}")
    unfinished = hadoop_path(f"{path}/{COMMITS}/.{name}-{uuid.uuid4().hex}")
    files.create(unfinished, True).close()
    # Another attempt may have been faster; its rows are the same.
    if not files.rename(unfinished, record):
        files.delete(unfinished, False)
    return True


def committed_writings(spark: SparkSession, path: str) -> list[str]:
    """Names of the writings that are whole."""
    files, hadoop_path = _file_system(spark, path)
    folder = hadoop_path(f"{path}/{COMMITS}")
    if not files.exists(folder):
        return []
    names = (status.getPath().getName() for status in files.listStatus(folder))
    return sorted(name for name in names if not name.startswith("."))


def read_committed(spark: SparkSession, path: str, fields: Sequence[str]) -> DataFrame:
    """The rows of all writings that are whole, as text."""
    names = committed_writings(spark, path)
    if not names:
        return spark.createDataFrame([], text_schema(fields))
    folders = [f"{path}/write={name}" for name in names]
    return spark.read.schema(text_schema(fields)).option("mode", "FAILFAST").json(folders)
