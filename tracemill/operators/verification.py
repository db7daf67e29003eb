"""Accepting model-written reasoning only where its answer is right."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracemill.functions.answers import last_boxed, same_answer
from tracemill.functions.text import preview, strip
from tracemill.operators.combine import (
    attach_completions,
    exclude_ids,
    pair_occurrences,
    repeated_ids,
    repeated_on_both,
    unknown_completions,
)
from tracemill.operators.projection import computed_once
from tracemill.sources.records import ACCEPTED_FIELDS
from tracemill.sources.staging import release, stage

PREVIEW_LENGTH = 300

NO_COMPLETION = "no_completion"
NO_BOX = "no_box"
MISMATCH = "mismatch"


@dataclass(frozen=True)
class Fields:
    """What the columns of problems and completions are called."""

    id: str = "id"
    prompt: str = "prompt"
    answer: str = "answer"
    completion: str = "completion"
    source_model: str = "source_model"


def read_boxes(completions: DataFrame, fields: Fields = Fields()) -> DataFrame:
    """Completions as ``reasoning``, with their last boxed answer and a preview.

    Done ahead of the join: what is only rejected then need not be shuffled whole.
    """
    text = F.coalesce(F.col(fields.completion), F.lit(""))
    read = completions.select(
        F.col(fields.id).alias("id"),
        text.alias("reasoning"),
        last_boxed(text).alias("boxed_answer"),
        preview(text, PREVIEW_LENGTH, one_line=True).alias("preview"),
        F.col(fields.source_model).alias("source_model"),
    )
    return computed_once(read)


def expected(problems: DataFrame, fields: Fields = Fields()) -> DataFrame:
    return problems.select(
        F.col(fields.id).alias("id"),
        F.col(fields.prompt).alias("prompt"),
        strip(F.col(fields.answer)).alias("answer"),
    )


def is_right() -> Column:
    return same_answer(F.col("answer"), F.col("boxed_answer"), "latex_strict")


def accepted_fields(pairs: DataFrame) -> DataFrame:
    return pairs.filter(is_right()).select(*ACCEPTED_FIELDS)


def rejected_fields(pairs: DataFrame) -> DataFrame:
    reason = F.when(F.col("boxed_answer").isNull(), NO_BOX).otherwise(MISMATCH)
    return pairs.filter(~is_right()).select(
        "id",
        F.col("answer").alias("expected"),
        F.col("boxed_answer").alias("predicted"),
        reason.alias("reject_reason"),
        "preview",
    )


@dataclass(frozen=True)
class Verified:
    """Judged completions and the problems without any.

    Nothing runs before an outcome is asked for. The first one looks for ids that are
    repeated on both sides, and pairs the rows of these one by one.
    """

    problems: DataFrame
    completions: DataFrame
    read: DataFrame
    stored: DataFrame | None = None

    @cached_property
    def _repeated(self) -> DataFrame | None:
        """Ids repeated on both sides, stored; None if there are none."""
        found = repeated_on_both(self.problems, self.completions)
        return None if found.isEmpty() else stage(found, "repeated-ids")

    @cached_property
    def pairs(self) -> DataFrame:
        """Every completion with its problem."""
        if self._repeated is None:
            return attach_completions(self.problems, self.read)[0]
        asked, given = (exclude_ids(df, self._repeated) for df in (self.problems, self.read))
        order = ("prompt", "answer"), ("reasoning", "source_model")
        numbered = pair_occurrences(self.problems, self.read, self._repeated, order=order)
        return attach_completions(asked, given)[0].unionByName(numbered)

    @property
    def silent(self) -> DataFrame:
        """Problems without a completion."""
        return attach_completions(self.problems, self.read, answered=self.completions)[1]

    @property
    def accepted(self) -> DataFrame:
        """Right completions, whole, with the problem they belong to."""
        return accepted_fields(self.pairs)

    @property
    def rejected(self) -> DataFrame:
        """Wrong completions and unanswered problems, with the reason."""
        nothing = F.lit(None).cast("string")
        unanswered = self.silent.select(
            "id",
            F.col("answer").alias("expected"),
            nothing.alias("predicted"),
            F.lit(NO_COMPLETION).alias("reject_reason"),
            nothing.alias("preview"),
        )
        return rejected_fields(self.pairs).unionByName(unanswered)

    def summary(self) -> DataFrame:
        """One row: accepted and rejected rows. Unanswered problems are rejected."""
        judged = self.pairs.select(is_right().alias("right"))
        return judged.unionByName(self.silent.select(F.lit(False).alias("right"))).agg(
            F.count_if("right").alias("accepted_rows"),
            F.count_if(~F.col("right")).alias("rejected_rows"),
        )

    def audit(self) -> DataFrame:
        """One row: ids repeated among the problems, and completions of no problem.

        Neither is in the outcomes: repeated problems are judged row by row, and
        completions of an unknown id, or of none, have nothing to be judged by.
        """
        repeated = repeated_ids(self.problems, "id").select(F.lit("repeated").alias("kind"))
        unknown = unknown_completions(self.problems.select("id"), self.completions.select("id"))
        both = repeated.unionByName(unknown.select(F.lit("unknown").alias("kind")))
        return both.agg(
            F.count_if(F.col("kind") == "repeated").alias("repeated_problem_ids"),
            F.count_if(F.col("kind") == "unknown").alias("unknown_completions"),
        )

    def release(self) -> None:
        """Delete what was stored; the outcomes cannot be read after that."""
        for table in (self.stored, self.__dict__.get("_repeated")):
            if table is not None:
                release(table)


def verify(
    problems: DataFrame,
    completions: DataFrame,
    store: bool = False,
    fields: Fields = Fields(),
) -> Verified:
    """Judge completions of problems, row by row.

    A problem without any completion counts as a failed request. Several rows of an id on
    one side are all judged against the other side's row; several on both sides are paired
    one by one (:func:`pair_occurrences`). ``store`` keeps what was read from the
    completions as a table, which pays where more than one outcome is used: the completions
    are searched for boxes once, and each outcome reads only the columns it needs.
    Without it no job runs here.
    """
    asked = expected(problems, fields)
    given = completions.select(F.col(fields.id).alias("id"))
    read = read_boxes(completions, fields)
    if not store:
        return Verified(asked, given, read)
    stored = stage(read, "boxes")
    return Verified(asked, stored.select("id"), stored, stored)
