"""Record readers. Every field is text; nothing is inferred from the values."""

from __future__ import annotations

from collections.abc import Sequence
from pathlib import PurePosixPath

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PROBLEM_FIELDS = ("id", "prompt", "answer")
TRACE_FIELDS = ("id", "prompt", "answer", "reasoning")
ACCEPTED_FIELDS = ("id", "prompt", "answer", "reasoning", "boxed_answer", "source_model")
REJECTED_FIELDS = ("id", "expected", "predicted", "reject_reason", "preview")
COMPLETION_FIELDS = ("id", "completion", "source_model")


def text_schema(fields: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in fields])


def lines_are_records(spark: SparkSession, path: str) -> bool:
    """Whether it is certain that no field of the CSV files spans lines.

    Certain it is if on each line every quote belongs to a field that is quoted from its
    start to its end: then no line begins inside of one. A quoted part, from one quote to the
    next, becomes a mark; what a quote in a field doubles makes two parts side by side. A mark
    beside anything but a comma, a mark or an end, or a quote left over, leaves doubt, and
    so do lone carriage returns and lines of blanks only, which the two ways of
    reading take differently. One pass over the lines, by many tasks.
    """
    lines = spark.read.option("lineSep", "\n").text(path)
    line = F.rtrim(F.col("value"), F.lit("\r"))
    marked = F.regexp_replace(line, '"[^"]*"', "\x00")
    doubt = marked.rlike('["\r]|[^,\x00]\x00|\x00[^,\x00]') | line.contains("\x00")
    doubt = doubt | ((F.trim(line) == "") & (line != ""))
    return lines.filter(doubt).isEmpty()


def read_csv(spark: SparkSession, path: str, multi_line: bool | None = None) -> DataFrame:
    """CSV with a header; quoted fields may span lines and double their quotes.

    Columns are those of the header, all text. An empty field is an empty text:
    CSV cannot tell it from a missing one. A file with multi-line fields cannot
    be split and is read by one task, so give Spark many files, or Parquet, where there is
    much of that. Unless ``multi_line`` says so, a pass over the lines finds out whether
    fields may span them (:func:`lines_are_records`). All files of a folder must have the same
    header; one with other columns, or another order of them, stops the read.
    """
    if multi_line is None:
        multi_line = not lines_are_records(spark, path)
    reader = spark.read.option("header", True).option("inferSchema", False)
    reader = reader.option("multiLine", multi_line).option("escape", '"')
    reader = reader.option("mode", "FAILFAST").option("enforceSchema", False)
    return reader.csv(path).na.fill("")


def read_json_lines(
    spark: SparkSession, path: str, fields: Sequence[str] | None = None
) -> DataFrame:
    """JSON lines with all their fields as text, or the given ones; blank lines are skipped.

    Without ``fields`` a first pass collects the names. Objects and arrays come as
    their JSON. A line that is no JSON stops the read. Numbers keep their spelling.
    """
    if fields is None:
        names = spark.read.option("primitivesAsString", True).option("mode", "FAILFAST").json(path)
        fields = names.columns
    return spark.read.schema(text_schema(fields)).option("mode", "FAILFAST").json(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    table = spark.read.parquet(path)
    return table.select([F.col(name).cast("string").alias(name) for name in table.columns])


def load_records(
    spark: SparkSession,
    path: str,
    fields: Sequence[str] | None = None,
    multi_line: bool | None = None,
) -> DataFrame:
    """Read by suffix: ``.csv``, ``.jsonl``, ``.ndjson`` or ``.parquet``.

    ``fields`` names what to take from JSON lines, where that is not everything; the
    other formats carry their own column names. ``multi_line`` is for CSV, see
    :func:`read_csv`.
    """
    suffix = PurePosixPath(path.rstrip("/")).suffix
    try:
        match suffix.lower():
            case ".csv":
                return read_csv(spark, path, multi_line)
            case ".jsonl" | ".ndjson":
                return read_json_lines(spark, path, fields)
            case ".parquet":
                return read_parquet(spark, path)
        spark.read.text(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no records at {path}") from error
        raise
    raise ValueError(f"unsupported record format: {suffix or path}")


def with_id(
    df: DataFrame, prompt: str = "prompt", answer: str = "answer", by: str = "id"
) -> DataFrame:
    """Give records without an id, or with an empty one, one derived from their content."""
    content = F.to_json(
        F.struct(F.col(prompt).alias("prompt"), F.col(answer).alias("answer")),
        {"ignoreNullFields": "false"},
    )
    derived = F.md5(content)
    if by not in df.columns:
        return df.withColumn(by, derived)
    given = F.col(by).cast("string")
    return df.withColumn(by, F.when(given.isNull() | (given == ""), derived).otherwise(given))
