"""Verification of completions as they arrive, with Structured Streaming.

Stateless: every completion is judged on its own, so what becomes of it does not depend on
the files that happen to be read together. The checkpoint remembers which
files were read, and each micro-batch writes its own folder, replacing what a
failed attempt left there. So a rerun adds nothing, and a retry nothing twice. The
folder carries the id that the checkpoint gave the stream, so that streams with other
checkpoints may write beside it.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tracemill.operators.verification import (
    Fields,
    accepted_fields,
    expected,
    read_boxes,
    rejected_fields,
)
from tracemill.sources.records import (
    ACCEPTED_FIELDS,
    REJECTED_FIELDS,
    text_schema,
)
from tracemill.sources.sinks import replace_json_lines
from tracemill.sources.staging import release, stage

ACCEPTED_FOLDER = "accepted"
REJECTED_FOLDER = "rejected"
AMBIGUOUS = "ambiguous_id"


def watch_json_lines(
    spark: SparkSession, folder: str, names: tuple[str, ...], files_per_batch: int = 1000
) -> DataFrame:
    """Text fields of JSON lines, from files that keep appearing in ``folder``."""
    reader = spark.readStream.schema(text_schema(names))
    reader = reader.option("mode", "FAILFAST").option("maxFilesPerTrigger", files_per_batch)
    return reader.json(folder)


def watch_completions(
    spark: SparkSession, folder: str, files_per_batch: int = 1000, fields: Fields = Fields()
) -> DataFrame:
    """Arriving completions."""
    names = (fields.id, fields.completion, fields.source_model)
    return watch_json_lines(spark, folder, names, files_per_batch)


def asked_once(problems: DataFrame) -> DataFrame:
    """One row for each id: its problem, and whether the id names several different ones.

    Grouped by the id together with its hash: the join above then brings an exchange of its
    own, whose skewed partitions adaptive execution can split.
    """
    problem = F.struct("prompt", "answer")
    grouped = problems.groupBy("id", F.crc32(F.col("id").cast("binary")).alias("id_hash"))
    ends = grouped.agg(F.min(problem).alias("problem"), F.max(problem).alias("other"))
    several = ~F.col("problem").eqNullSafe(F.col("other"))
    return ends.select("id", "problem.*", several.alias("ambiguous"))


def verify_arrivals(
    problems: DataFrame,
    arrivals: DataFrame,
    output: str,
    checkpoint: str,
    fields: Fields = Fields(),
) -> StreamingQuery:
    """Judge all completions that are there and not yet judged, then stop.

    Copies of a problem are one problem here, and each completion gives one verdict. An id
    of several different problems does not tell which of them was answered; its
    completions are rejected as ``ambiguous_id``. Completions of no problem have no outcome,
    nor have problems without a completion, as more may arrive.

    The batch is stored first: its size is then known, so that a small batch is broadcast
    to the problems instead of shuffling them all. Its pairs are stored too, so
    that problems are read and joined once for both outcomes. Both tables are deleted
    afterwards.
    """
    asked = expected(problems, fields)

    def judge(batch: DataFrame, batch_id: int) -> None:
        answered = stage(read_boxes(batch, fields), "arrivals")
        wanted = asked_once(asked.join(answered.select("id").distinct(), "id", "left_semi"))
        pairs = stage(wanted.join(answered, "id"), "arrival-pairs")
        told = pairs.filter(~F.col("ambiguous"))
        unclear = pairs.filter("ambiguous").select(
            "id",
            F.lit(None).cast("string").alias("expected"),
            F.col("boxed_answer").alias("predicted"),
            F.lit(AMBIGUOUS).alias("reject_reason"),
            "preview",
        )
        part = f"stream={stream_id(batch.sparkSession, checkpoint)}/batch={batch_id}"
        replace_json_lines(accepted_fields(told), f"{output}/{ACCEPTED_FOLDER}/{part}")
        rejected = rejected_fields(told).unionByName(unclear)
        replace_json_lines(rejected, f"{output}/{REJECTED_FOLDER}/{part}")
        release(pairs)
        release(answered)

    writer = arrivals.writeStream.foreachBatch(judge).trigger(availableNow=True)
    return writer.option("checkpointLocation", checkpoint).start()


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark keeps with the checkpoint from the first start on."""
    return spark.read.text(f"{checkpoint}/metadata").select(
        F.get_json_object("value", "$.id")
    ).first()[0]


def _read(spark: SparkSession, folder: str, fields: tuple[str, ...]) -> DataFrame:
    """All batches of all streams; no rows where nothing was written yet."""
    schema = text_schema(fields)
    try:
        return spark.read.schema(schema).json(f"{folder}/*/*")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def read_accepted(spark: SparkSession, output: str) -> DataFrame:
    return _read(spark, f"{output}/{ACCEPTED_FOLDER}", ACCEPTED_FIELDS)


def read_rejected(spark: SparkSession, output: str) -> DataFrame:
    return _read(spark, f"{output}/{REJECTED_FOLDER}", REJECTED_FIELDS)
