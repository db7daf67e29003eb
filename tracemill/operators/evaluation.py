"""Accuracy of predictions against the truth, with sample misses."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracemill.functions.answers import (
    check_tolerance,
    is_close,
    last_boxed,
    normalize,
    to_number,
)
from tracemill.functions.text import strip, strip_long
from tracemill.operators.projection import computed_once
from tracemill.operators.ranking import first_rows, order_key
from tracemill.sources.records import with_id

DEFAULT_MISSES = 5


def judge_predictions(
    predictions: DataFrame,
    answer: str = "answer",
    prediction: str = "prediction",
    tolerance: float | None = None,
) -> DataFrame:
    """All rows with ``expected``, ``boxed``, ``predicted`` and ``matched`` added.

    Same rule as ``answers_match``, in separate projections so that each
    intermediate text is computed once.
    """
    check_tolerance(tolerance)
    read = predictions.select(
        "*",
        strip(F.col(answer)).alias("expected"),
        last_boxed(F.col(prediction)).alias("boxed"),
    )
    filled = read.select(
        "*", F.coalesce(F.col("boxed"), strip_long(F.col(prediction))).alias("predicted")
    )
    compared = filled.select(
        "*", normalize(F.col("expected")).alias("_left"), normalize(F.col("predicted")).alias("_right")
    )
    matched = F.coalesce(F.col("_left") == F.col("_right"), F.lit(False))
    if tolerance is not None:
        close = is_close(to_number(F.col("_left")), to_number(F.col("_right")), tolerance)
        matched = matched | close
    judged = compared.select("*", matched.alias("matched")).drop("_left", "_right")
    return computed_once(judged)


def summarize(judged: DataFrame) -> DataFrame:
    """One row: rows evaluated, rows matched, and their ratio (0 without rows)."""
    counts = judged.agg(
        F.count("*").alias("evaluated"), F.count_if("matched").alias("matched")
    )
    ratio = F.try_divide(F.col("matched"), F.col("evaluated"))
    return counts.select("*", F.coalesce(ratio, F.lit(0.0)).alias("accuracy"))


def summarize_by(judged: DataFrame, *breakdowns: str | Sequence[str]) -> DataFrame:
    """The summary in total and by each breakdown, a column or several, in one pass.

    ``breakdown`` names the columns that a row is about, joined by commas, and is empty for
    the total. The other columns are null there; a null in a column that the row is about is a
    group of its own. Without any row there is none here either.
    """
    sets = [[], *([b] if isinstance(b, str) else list(b) for b in breakdowns)]
    names = list(dict.fromkeys(name for columns in sets for name in columns))
    if not names:
        raise ValueError("name a column to break the summary down by")
    about = F.concat_ws(",", *(F.when(F.grouping(name) == 0, F.lit(name)) for name in names))
    counts = judged.groupingSets(sets, *names).agg(
        about.alias("breakdown"), F.count("*").alias("evaluated"), F.count_if("matched").alias("matched")
    )
    ratio = F.try_divide(F.col("matched"), F.col("evaluated"))
    accuracy = F.coalesce(ratio, F.lit(0.0)).alias("accuracy")
    return counts.select("breakdown", *names, "evaluated", "matched", accuracy)


def sample_misses(judged: DataFrame, count: int = DEFAULT_MISSES, by: str = "id") -> DataFrame:
    """The first misses by ``by``."""
    misses = judged.filter(~F.col("matched")).select(by, "expected", "predicted", "boxed")
    return first_rows(misses, count, order_key(misses, by))


@dataclass(frozen=True)
class Evaluation:
    """Outcomes of an evaluation. Nothing runs, and nothing is read, before it is used.

    The barrier around the judged columns keeps Spark from pruning what is in it, so
    each outcome puts only the columns it needs there.
    """

    predictions: DataFrame
    answer: str
    prediction: str
    tolerance: float | None
    count: int
    by: str

    @cached_property
    def summary(self) -> DataFrame:
        texts = self.predictions.select(self.answer, self.prediction)
        return summarize(judge_predictions(texts, self.answer, self.prediction, self.tolerance))

    def by_group(self, *breakdowns: str | Sequence[str]) -> DataFrame:
        """The summary in total and by columns of the predictions (:func:`summarize_by`)."""
        names = [n for b in breakdowns for n in ([b] if isinstance(b, str) else b)]
        needed = dict.fromkeys((*names, self.answer, self.prediction))
        texts = self.predictions.select(*needed)
        return summarize_by(judge_predictions(texts, self.answer, self.prediction, self.tolerance), *breakdowns)

    @cached_property
    def misses(self) -> DataFrame:
        """The first misses by ``by``, or by a hash of the texts where there is none."""
        named = self.predictions
        if self.by not in named.columns:
            named = with_id(named, self.prediction, self.answer, self.by)
        texts = named.select(*dict.fromkeys((self.by, self.answer, self.prediction)))
        judged = judge_predictions(texts, self.answer, self.prediction, self.tolerance)
        return sample_misses(judged, self.count, self.by)


def evaluate(
    predictions: DataFrame,
    answer: str = "answer",
    prediction: str = "prediction",
    tolerance: float | None = None,
    misses: int = DEFAULT_MISSES,
    by: str = "id",
) -> Evaluation:
    """Score predictions: boxed answer if there is one, else the whole text."""
    check_tolerance(tolerance)
    return Evaluation(predictions, answer, prediction, tolerance, misses, by)
