"""Cleaning of reasoning traces: judge every row, keep the sound ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracemill.functions.answers import (
    cut_last_box,
    ends_in_box,
    has_box,
    has_latex_blank,
    last_boxed,
    normalize,
)
from tracemill.functions.text import strip_long
from tracemill.operators.projection import computed_once

CLEAN_FIELDS = ("id", "prompt", "answer", "reasoning", "boxed_answer")

EMPTY_FIELD = "empty_field"
BOX_DIFFERS = "box_differs"
NOTHING_LEFT = "nothing_left"


def _text(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def judge_traces(traces: DataFrame) -> DataFrame:
    """Every trace with its cleaned fields, ``reject_reason`` (null if sound) and flags.

    The trace's own answer is the truth here. Traces without an ``id`` column have an
    empty one. The steps are separate projections
    so that each text is processed once per step.
    """
    own = F.col("id") if "id" in traces.columns else F.lit("")
    prepared = traces.select(
        own.alias("id"),
        strip_long(_text("prompt")).alias("prompt"),
        normalize(_text("answer"), "latex_space").alias("answer"),
        strip_long(_text("reasoning")).alias("raw_reasoning"),
    )
    extracted = prepared.select(
        "*",
        last_boxed(F.col("raw_reasoning"), "latex_space").alias("boxed_answer"),
        cut_last_box(F.col("raw_reasoning")).alias("reasoning"),
    )
    empty = (F.col("prompt") == "") | (F.col("answer") == "") | (F.col("raw_reasoning") == "")
    agrees = F.col("boxed_answer").eqNullSafe(F.col("answer"))
    reason = F.when(empty, EMPTY_FIELD).when(~agrees, BOX_DIFFERS)
    reason = reason.when(F.col("reasoning") == "", NOTHING_LEFT)
    return computed_once(extracted.select("*", reason.alias("reject_reason")))


def sound_traces(judged: DataFrame) -> DataFrame:
    return judged.filter(F.col("reject_reason").isNull()).select(*CLEAN_FIELDS)


def clean_traces(traces: DataFrame) -> DataFrame:
    """The sound traces with normalized answer and the last box cut off."""
    return sound_traces(judge_traces(traces))


def rejected_traces(traces: DataFrame) -> DataFrame:
    """The other traces, with the reason."""
    judged = judge_traces(traces).filter(F.col("reject_reason").isNotNull())
    return judged.select("id", "answer", "boxed_answer", "reject_reason")


def trace_flags(traces: DataFrame, text: str = "reasoning") -> DataFrame:
    """Per trace: any box, a box at the end, a LaTeX blank."""
    reasoning = strip_long(_text(text))
    return traces.select(
        "id",
        has_box(reasoning).alias("has_box"),
        ends_in_box(reasoning).alias("ends_in_box"),
        has_latex_blank(reasoning).alias("has_latex_blank"),
    )


def cleaning_counters() -> list[Column]:
    """Aggregates over judged traces: a report, or metrics to observe."""
    reasoning = F.col("raw_reasoning")
    sound = F.col("reject_reason").isNull()
    return [
        F.count(F.lit(1)).alias("raw_rows"),
        F.count_if(has_box(reasoning)).alias("boxed_any"),
        F.count_if(ends_in_box(reasoning)).alias("boxed_at_end"),
        F.count_if(has_latex_blank(reasoning)).alias("latex_blank"),
        F.count_if(sound).alias("clean_rows"),
        F.count_if(~sound).alias("rejected_rows"),
    ]


def clean_report(traces: DataFrame) -> DataFrame:
    """One row of counters over all traces."""
    return judge_traces(traces).agg(*cleaning_counters())
