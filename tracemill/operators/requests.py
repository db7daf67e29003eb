"""Request rows for a batch-inference service. Sending them is left to others."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracemill.functions.chat import message
from tracemill.operators.running import running_start
from tracemill.sources.staging import release_paths, shuffles_deleted, stage, staging_path, stored_tables

# The texts and defaults of a generation request.
SYSTEM_PROMPT = r"""You are generating supervised fine-tuning data for a reasoning model.
Given a puzzle-like prompt, infer the transformation rule from the examples, reason clearly, and end with the final answer inside \boxed{}.
Do not mention that you know the ground-truth answer.
Keep the reasoning concise but useful for training."""
TASK_PREAMBLE = r"""Solve the following reasoning task.
Infer the rule from the examples, explain the reasoning clearly, and end with the final answer inside \boxed{}.

"""
REASONING_MODEL = re.compile(r"o\d")
REASONING_TOKENS = "max_completion_tokens"
PLAIN_TOKENS = "max_tokens"
DEFAULT_MODEL = "gpt-4.1-mini"
DEFAULT_TEMPERATURE = 0.2
DEFAULT_MAX_TOKENS = 1200

# What one file of a batch may hold.
FILE_ROWS = 50_000
FILE_BYTES = 200_000_000


def load_system_prompt(spark: SparkSession, path: str) -> str:
    """The stripped text of a prompt file, or the default where there is none."""
    try:
        file = spark.read.text(path, wholetext=True).first()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return SYSTEM_PROMPT
        raise
    return file["value"].strip() if file else ""


def request_rows(
    problems: DataFrame,
    model: str = DEFAULT_MODEL,
    temperature: float = DEFAULT_TEMPERATURE,
    max_tokens: int = DEFAULT_MAX_TOKENS,
    system_prompt: str = SYSTEM_PROMPT,
    id_field: str = "id",
    prompt_field: str = "prompt",
) -> DataFrame:
    """One request per problem: its parts as columns and the JSON ``body``.

    Models of the o series take another token key and no temperature.
    """
    reasons = REASONING_MODEL.match(model) is not None
    token_key = REASONING_TOKENS if reasons else PLAIN_TOKENS
    user = F.concat(F.lit(TASK_PREAMBLE), F.col(prompt_field))
    settings = {"model": model, token_key: max_tokens}
    turns = F.array(message("system", F.lit(system_prompt)), message("user", user))
    parts = [F.lit(value).alias(name) for name, value in settings.items()] + [turns.alias("messages")]
    if not reasons:
        parts.append(F.lit(float(temperature)).alias("temperature"))
    return problems.select(
        F.col(id_field).alias("id"),
        F.lit(model).alias("model"),
        F.lit(token_key).alias("token_key"),
        F.lit(system_prompt).alias("system_message"),
        user.alias("user_message"),
        F.to_json(F.struct(*parts)).alias("body"),
    )


def request_lines(requests: DataFrame) -> DataFrame:
    """``id, line``: each request as the JSON line that is written."""
    line = F.to_json(F.struct("id", "body"), {"ignoreNullFields": "false"})
    return requests.select("id", line.alias("line"))


def file_numbers(
    lines: DataFrame, max_rows: int = FILE_ROWS, max_bytes: int = FILE_BYTES, large_alone: bool = False
) -> DataFrame:
    """``lines`` with the ``file`` that each goes to, in the order of their MD5.

    A line weighs its share of a file, by rows or by bytes, whichever is more; lines whose
    total weight fits into one file keep both bounds. Files are cut where the running weight
    passes the next multiple of what a file can hold besides the heaviest line, so no line
    needs to know where the file before it ended.

    A line larger than a file is an error, or with ``large_alone`` has a file of its own, the
    only kind to pass ``max_bytes``. Where there is one, lines of more than half a file are
    alone too, in files numbered after the others: besides the heaviest of the rest there is
    half a file of room, so a line that just fits does not make all files small.
    """
    if max_rows < 1 or max_bytes < 1:
        raise ValueError("a file needs room for a row and a byte")
    size = (F.octet_length("line") + 1).cast("decimal(20,0)")
    weight = F.greatest(size * max_rows, F.lit(max_bytes).cast("decimal(20,0)")).cast("decimal(38,0)")
    rows = lines.select(
        "*", F.monotonically_increasing_id().alias("_row"), F.md5("line").alias("_digest"), weight.alias("_weight")
    )
    rows = stage(rows, "request-lines", "zstd")
    room = max_rows * max_bytes
    small = F.when(F.col("_weight") <= room // 2, F.col("_weight"))
    heaviest, heaviest_small, total_small = (
        int(found or 0) for found in rows.agg(F.max("_weight"), F.max(small), F.sum(small)).first()
    )
    alone, first_alone = F.lit(False), 0
    if heaviest > room:
        if not large_alone:
            raise ValueError(f"a request of {heaviest // max_rows} bytes is larger than a file of {max_bytes}")
        alone, heaviest = F.col("_weight") > room // 2, heaviest_small
        first_alone = -(-total_small // (room - heaviest))
    step = F.lit(max(room - heaviest, 1)).cast("decimal(38,0)")
    amount = F.when(alone, F.lit(1).cast("decimal(38,0)")).otherwise(F.col("_weight"))
    light = rows.select("_digest", "_row", alone.alias("_alone"), amount.alias("_amount"))
    started = running_start(light, ["_alone"], ["_digest", "_row"], "_amount", "_start")
    shared = F.call_function("div", F.col("_start"), step)
    file = F.when(F.col("_alone"), F.col("_start").cast("bigint") + first_alone).otherwise(shared)
    numbered = started.select("_row", file.alias("file"))
    return rows.join(numbered, "_row").drop("_row", "_digest", "_weight")


def write_request_files(
    requests: DataFrame,
    path: str,
    max_rows: int = FILE_ROWS,
    max_bytes: int = FILE_BYTES,
    overwrite: bool = False,
    large_alone: bool = False,
) -> None:
    """JSON lines of ``id`` and ``body`` in files ``file=<number>/part-*`` within both bounds.

    Every request is in exactly one file, copies too. A request larger than a file stops the
    write, or with ``large_alone`` is the only one of its file.
    """
    spark = requests.sparkSession
    placed = staging_path(spark, "request-files")
    with shuffles_deleted(spark):
        with stored_tables() as earlier:
            numbered = file_numbers(request_lines(requests), max_rows, max_bytes, large_alone)
        # JSON has no tabs or line ends but escaped ones. No setting of the session may cut the files.
        placing = F.concat_ws("\t", F.col("file").cast("string"), "line")
        whole = numbered.select("file", "line").repartition("file").select(placing)
        whole.write.option("maxRecordsPerFile", 0).text(placed, "gzip", "\n")
        release_paths(spark, earlier)
        # A gzip file is never split, so one task has all lines of a file, without another shuffle.
        parts = F.split("value", "\t", 2)
        lines = spark.read.text(placed, lineSep="\n")
        lines = lines.select(parts[0].cast("bigint").alias("file"), parts[1].alias("line"))
        writer = lines.write.partitionBy("file").mode("overwrite" if overwrite else "errorifexists")
        writer.option("maxRecordsPerFile", 0).text(path)
    release_paths(spark, [placed])
