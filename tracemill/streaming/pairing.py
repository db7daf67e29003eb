"""Problems and completions that both arrive as streams, paired with keyed state.

Either may come first. What Spark keeps for an id is its problem, the completions that wait
for one, and digests of the judged ones; a timer ends the wait. Boxes are found and answers
brought to their normal form before the state, by built-in expressions; only the pairing
runs in Python.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tracemill.functions.answers import normalize
from tracemill.operators.verification import MISMATCH, NO_BOX, NO_COMPLETION, Fields, expected, read_boxes
from tracemill.sources.records import ACCEPTED_FIELDS, REJECTED_FIELDS
from tracemill.sources.sinks import replace_json_lines
from tracemill.sources.staging import release, stage
from tracemill.streaming.arrivals import ACCEPTED_FOLDER, REJECTED_FOLDER, stream_id

PATIENCE_SECONDS = 24 * 3600
REPEATED_ID = "repeated_id"
NO_PROBLEM = "no_problem"

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
# Fixed value: the store that keeps timers and several values for a key.
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

PROBLEM = "prompt string, answer string, truth string"
COMPLETION = "reasoning string, boxed_answer string, box string, preview string, source_model string"
VERDICT = (
    "id string, prompt string, answer string, reasoning string, boxed_answer string, "
    "source_model string, preview string, reject_reason string"
)


def _fields(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(",")]


class Pairing(StatefulProcessor):
    """Judges each completion of an id once, against the id's first problem."""

    def __init__(self, patience_ms: int) -> None:
        self.patience_ms = patience_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.problem = handle.getValueState("problem", PROBLEM)
        self.waiting = handle.getMapState("waiting", "digest string", COMPLETION)
        self.judged = handle.getMapState("judged", "digest string", "judged boolean")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        (id_,) = key
        rows = list(rows)
        problem = self.problem.get() if self.problem.exists() else None
        for row in sorted((r for r in rows if r.is_problem), key=lambda r: r.digest):
            given = tuple(row[name] for name in _fields(PROBLEM))
            if problem is None:
                self.problem.update(given)
                problem = given
            elif tuple(problem) != given:
                yield self._verdict(id_, given, None, REPEATED_ID)
        arrived = [(r.digest, tuple(r[name] for name in _fields(COMPLETION))) for r in rows if not r.is_problem]
        if problem is not None:
            arrived += [(digest, tuple(held)) for (digest,), held in self.waiting.iterator()]
            self.waiting.clear()
            for digest, completion in dict(arrived).items():
                if not self.judged.containsKey((digest,)):
                    self.judged.updateValue((digest,), (True,))
                    yield self._judge(id_, problem, completion)
        else:
            for digest, completion in arrived:
                self.waiting.updateValue((digest,), completion)
        # The wait begins anew with whatever arrives.
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.patience_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        (id_,) = key
        if self.problem.exists():
            if not any(True for _ in self.judged.keys()):
                yield self._verdict(id_, tuple(self.problem.get()), None, NO_COMPLETION)
        else:
            for _, held in self.waiting.iterator():
                yield self._verdict(id_, None, tuple(held), NO_PROBLEM)
        for state in (self.problem, self.waiting, self.judged):
            state.clear()

    def close(self) -> None:
        pass

    def _judge(self, id_, problem: tuple, completion: tuple) -> Row:
        truth, box = problem[2], completion[2]
        if completion[1] is None:
            return self._verdict(id_, problem, completion, NO_BOX)
        right = truth is not None and truth == box
        return self._verdict(id_, problem, completion, None if right else MISMATCH)

    @staticmethod
    def _verdict(id_, problem: tuple | None, completion: tuple | None, reason: str | None) -> Row:
        prompt, answer, _ = problem or (None,) * 3
        reasoning, boxed_answer, _, preview, source_model = completion or (None,) * 5
        return Row(
            id=id_, prompt=prompt, answer=answer, reasoning=reasoning, boxed_answer=boxed_answer,
            source_model=source_model, preview=preview, reject_reason=reason,
        )


def _digest(*names: str):
    return F.md5(F.concat_ws(":", *(F.coalesce(F.md5(name), F.lit("")) for name in names)))


def pair_arrivals(
    problems: DataFrame,
    completions: DataFrame,
    patience_seconds: float = PATIENCE_SECONDS,
    fields: Fields = Fields(),
) -> DataFrame:
    """A stream of verdicts on two streams; ``reject_reason`` is null for right completions.

    A completion is judged once, however often it arrives, and waits for its problem if that
    is late. Each arrival for an id renews its patience. Once that is over, a problem that
    nothing answered is rejected as ``no_completion`` and completions without a problem as
    ``no_problem``; the id is then forgotten, so state is bounded by what arrives within the
    patience. Of several different problems under one id the first counts, the others are
    rejected as ``repeated_id``. A problem without an id cannot be answered and is rejected
    at once; a completion without one belongs to nothing and has no verdict.
    """
    asked, read = expected(problems, fields), read_boxes(completions, fields)
    nothing = {name: F.lit(None).cast("string") for name in (*_fields(PROBLEM), *_fields(COMPLETION))}
    asked = asked.select(
        "id",
        F.lit(True).alias("is_problem"),
        _digest("prompt", "answer").alias("digest"),
        "prompt",
        "answer",
        normalize(F.col("answer"), "latex_strict").alias("truth"),
        *(nothing[name].alias(name) for name in _fields(COMPLETION)),
    )
    read = read.select(
        "id",
        F.lit(False).alias("is_problem"),
        _digest("reasoning", "source_model").alias("digest"),
        *(nothing[name].alias(name) for name in _fields(PROBLEM)),
        "reasoning",
        "boxed_answer",
        normalize(F.col("boxed_answer"), "latex_strict").alias("box"),
        "preview",
        "source_model",
    )
    usable = F.col("id").isNotNull() & (F.col("id") != "")
    both = asked.unionByName(read).filter(usable)
    verdicts = both.groupBy("id").transformWithState(
        Pairing(round(1000 * patience_seconds)), VERDICT, "Append", "ProcessingTime"
    )
    hopeless = asked.filter(~F.coalesce(usable, F.lit(False)))
    hopeless = hopeless.withColumn("reject_reason", F.lit(NO_COMPLETION)).select(*_fields(VERDICT))
    return verdicts.unionByName(hopeless)


@contextmanager
def _keyed_state(spark: SparkSession) -> Iterator[None]:
    """A query takes the state store that is set when it starts."""
    before = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, ROCKS_DB)
    try:
        yield
    finally:
        spark.conf.unset(STATE_STORE) if before is None else spark.conf.set(STATE_STORE, before)


def verify_pairs(
    problems: DataFrame,
    completions: DataFrame,
    output: str,
    checkpoint: str,
    patience_seconds: float = PATIENCE_SECONDS,
    fields: Fields = Fields(),
    trigger: dict | None = None,
) -> StreamingQuery:
    """Write the verdicts of :func:`pair_arrivals` as accepted and rejected rows.

    Without a ``trigger`` one batch judges all that is there, ends the waits that are over,
    and the query stops. ``{"processingTime": "1 minute"}`` keeps it running; a query with
    timers never has nothing to do, so ``availableNow`` would not stop. Folders are as those
    of :func:`tracemill.streaming.arrivals.verify_arrivals`.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        verdicts = stage(batch, "verdicts")
        part = f"stream={stream_id(batch.sparkSession, checkpoint)}/batch={batch_id}"
        right = verdicts.filter("reject_reason is null").select(*ACCEPTED_FIELDS)
        wrong = verdicts.filter("reject_reason is not null")
        wrong = wrong.withColumnsRenamed({"answer": "expected", "boxed_answer": "predicted"})
        replace_json_lines(right, f"{output}/{ACCEPTED_FOLDER}/{part}")
        replace_json_lines(wrong.select(*REJECTED_FIELDS), f"{output}/{REJECTED_FOLDER}/{part}")
        release(verdicts)

    verdicts = pair_arrivals(problems, completions, patience_seconds, fields)
    writer = verdicts.writeStream.foreachBatch(write).outputMode("append")
    writer = writer.option("checkpointLocation", checkpoint).trigger(**(trigger or {"once": True}))
    with _keyed_state(problems.sparkSession):
        return writer.start()
