"""Whole training sets out of problems and traces."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import cached_property
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tracemill.functions import chat
from tracemill.operators.checks import (
    DIRECT,
    TRACE,
    mix_checks,
    mix_report,
    require_checks,
)
from tracemill.operators.cleaning import cleaning_counters, judge_traces, sound_traces
from tracemill.operators.combine import exclude_ids, oversample, union_texts
from tracemill.operators.sampling import (
    DEFAULT_SEED,
    sample_counted,
    sample_exact,
    sample_strict,
    shuffle_rows,
    split_train_test,
)
from tracemill.sources.records import load_records, with_id
from tracemill.sources.staging import release, stage

BASELINE_SAMPLES = 600
DIRECT_SAMPLES = 5000
TRACE_COPIES = 2
DRY_RUN_SAMPLES = 8


def training_text(
    df: DataFrame,
    prompt: str = "prompt",
    answer: str = "answer",
    reasoning: str | None = None,
    suffix: str | None = chat.INSTRUCTION_SUFFIX,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Chat text of every record; only ``text`` and the columns to keep remain."""
    user = chat.user_message(F.col(prompt), suffix)
    reply = chat.direct_reply(F.col(answer))
    if reasoning is not None and reasoning in df.columns:
        reply = chat.reasoned_reply(F.col(reasoning), F.col(answer))
    return df.select(*keep, chat.chat_text(user, reply).alias("text"))


def without_text(texts: DataFrame) -> DataFrame:
    """Rows of a training set that a null field left without text."""
    return texts.filter(F.col("text").isNull())


def baseline_recipe(
    problems: DataFrame,
    samples: int = BASELINE_SAMPLES,
    seed: int = DEFAULT_SEED,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """A sample of problems with nothing but the boxed answer as reply.

    Asking for more problems than there are is an error.
    """
    named = problems if "id" in problems.columns else with_id(problems)
    return training_text(sample_strict(named, samples, seed), keep=keep)


def trace_recipe(traces: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """All traces, not cleaned, as reasoned replies."""
    return training_text(traces, reasoning="reasoning", keep=keep)


def direct_texts(problems: DataFrame) -> DataFrame:
    """The mix rows of sampled problems."""
    user = chat.user_message(F.col("prompt"))
    reply = chat.normalized_reply(F.col("answer"))
    return problems.select(
        F.lit(DIRECT).alias("origin"),
        "id",
        F.lit(0).alias("copy"),
        chat.chat_text(user, reply).alias("text"),
    )


def trace_texts(clean: DataFrame, copies: int = TRACE_COPIES) -> DataFrame:
    """The mix rows of cleaned traces, each as often as asked."""
    user = chat.user_message(F.col("prompt"))
    reply = chat.trace_reply(F.col("reasoning"), F.col("answer"))
    rendered = clean.select(
        F.lit(TRACE).alias("origin"), "id", chat.chat_text(user, reply).alias("text")
    )
    return oversample(rendered, copies).select("origin", "id", "copy", "text")


@dataclass(frozen=True)
class Mix:
    """A training mix and the tables it was made from.

    ``rows`` (``origin, id, copy, text``) renders two stored tables, the sampled
    direct replies and the cleaned traces. ``cleaning`` holds the counters of the
    pass that cleaned the traces, ``pool_rows`` what the sample counted.
    """

    cleaning: dict[str, int]
    problems: DataFrame
    pool: DataFrame
    clean: DataFrame
    rows: DataFrame
    pool_rows: int
    direct_samples: int
    seed: int
    stored: tuple[DataFrame, ...] = ()

    @cached_property
    def ordered(self) -> DataFrame:
        """The rows in their seeded random order."""
        return shuffle_rows(self.rows, self.seed, ("origin", "id", "copy"), stored=True)

    def text(self) -> DataFrame:
        """The training set proper: shuffled, text only."""
        return self.ordered.select("text")

    def report(self) -> DataFrame:
        return mix_report(self.problems, self.pool_rows, self.cleaning["clean_rows"], self.rows)

    def checks(self) -> DataFrame:
        return mix_checks(self.report(), self.direct_samples)

    def release(self) -> None:
        """Delete the stored tables; the mix cannot be read after that."""
        for table in self.stored:
            release(table)

    def require(self) -> None:
        require_checks(self.checks())


def mixed_recipe(
    problems: DataFrame,
    traces: DataFrame,
    direct_samples: int = DIRECT_SAMPLES,
    copies: int = TRACE_COPIES,
    seed: int = DEFAULT_SEED,
) -> Mix:
    """Cleaned traces, oversampled, with direct replies for a sample of the rest.

    The cleaned traces are stored once: their ids are needed to exclude problems,
    in every pass of the sample, and their texts for the mix. The sample is stored
    too, but not the mix: repeating a stored trace costs less than writing the copies.
    Sampled rows are scattered over all problem files, so they are brought together
    in files of a sensible size first.
    """
    counted = Observation("cleaning")
    judged = judge_traces(traces).observe(counted, *cleaning_counters())
    clean = stage(sound_traces(judged), "clean")
    pool = exclude_ids(problems, clean)
    sampled, pool_rows = sample_counted(pool, direct_samples, seed)
    direct = stage(direct_texts(sampled).hint("rebalance"), "direct")
    rows = union_texts(direct, trace_texts(clean, copies))
    return Mix(counted.get, problems, pool, clean, rows, pool_rows, direct_samples, seed, (clean, direct))


@dataclass(frozen=True)
class Recipe:
    """What a configured data set is built from."""

    path: str
    sample_size: int | None = None
    val_ratio: float = 0.0
    prompt_field: str = "prompt"
    answer_field: str = "answer"
    reasoning_field: str | None = None
    instruction_suffix: str | None = chat.INSTRUCTION_SUFFIX
    seed: int = DEFAULT_SEED
    multi_line: bool | None = None

    @classmethod
    def from_config(cls, config: Mapping[str, Any]) -> Recipe:
        """From a parsed configuration with a ``data`` section and a ``seed``."""
        known = cls.__dataclass_fields__.keys() - {"seed"}
        data = {name: value for name, value in config["data"].items() if name in known}
        data["val_ratio"] = float(data.get("val_ratio", 0.0))
        return cls(**data, seed=int(config.get("seed", DEFAULT_SEED)))

    def rows_wanted(self, max_samples: int | None = None, dry_run: bool = False) -> int | None:
        """The sample size: an override wins, and a dry run takes a few at most."""
        if max_samples is not None:
            return max_samples
        if dry_run and self.sample_size is None:
            return DRY_RUN_SAMPLES
        return self.sample_size


def format_dataset(
    records: DataFrame,
    recipe: Recipe,
    max_samples: int | None = None,
    dry_run: bool = False,
    keep: tuple[str, ...] = (),
) -> tuple[DataFrame, DataFrame | None]:
    """Sample, render and split loaded records as the recipe says."""
    named = with_id(records, recipe.prompt_field, recipe.answer_field)
    wanted = recipe.rows_wanted(max_samples, dry_run)
    if wanted is not None:
        named = sample_exact(named, wanted, recipe.seed)
    train, test = split_train_test(named, recipe.val_ratio, recipe.seed)

    def rendered(part: DataFrame) -> DataFrame:
        return training_text(
            part,
            recipe.prompt_field,
            recipe.answer_field,
            recipe.reasoning_field,
            recipe.instruction_suffix,
            keep,
        )

    return rendered(train), None if test is None else rendered(test)


def build_dataset(
    spark: SparkSession,
    recipe: Recipe,
    max_samples: int | None = None,
    dry_run: bool = False,
    keep: tuple[str, ...] = (),
) -> tuple[DataFrame, DataFrame | None]:
    """Load the recipe's records and format them; gives train and test part."""
    records = load_records(spark, recipe.path, multi_line=recipe.multi_line)
    repeated = recipe.rows_wanted(max_samples, dry_run) is not None or recipe.val_ratio > 0
    if repeated and not recipe.path.rstrip("/").lower().endswith(".parquet"):
        # Sampling and splitting pass over the keys several times: parse the text once.
        records = stage(records, "records")
    return format_dataset(records, recipe, max_samples, dry_run, keep)
