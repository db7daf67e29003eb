"""Counters over a training mix, and checks that say whether it is sound."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracemill.functions.chat import assistant_boxes, has_think_tag
from tracemill.operators.combine import union_texts

DIRECT = "direct"
TRACE = "trace"
GRADIENT_ACCUMULATION = 4


class MixError(ValueError):
    """A training mix that fails its checks."""


def optimizer_steps(rows: Column, accumulation: int = GRADIENT_ACCUMULATION) -> Column:
    return F.floor(rows / F.lit(accumulation)).cast("bigint")


def text_flags(mix: DataFrame) -> DataFrame:
    """The mix with ``boxes`` in the assistant part and ``has_think`` added."""
    return mix.select(
        "*",
        assistant_boxes(F.col("text")).alias("boxes"),
        has_think_tag(F.col("text")).alias("has_think"),
    )


def _part(df: DataFrame, name: str) -> DataFrame:
    # Only the row count matters, so no column of the table is read.
    return df.select(
        F.lit(name).alias("part"),
        F.lit(None).cast("int").alias("boxes"),
        F.lit(None).cast("boolean").alias("has_think"),
    )


def mix_report(
    problems: DataFrame,
    pool: DataFrame | int,
    clean: DataFrame | int,
    mix: DataFrame,
    accumulation: int = GRADIENT_ACCUMULATION,
) -> DataFrame:
    """One row of counters over the inputs and the mix ``(origin, text)``.

    All tables are counted in one aggregation; only partial counts are shuffled.
    Counts known already may stand for the pool and the clean traces.
    """
    flagged = text_flags(mix.select(F.col("origin").alias("part"), "text")).drop("text")
    inputs = {"problems": problems, "pool": pool, "clean": clean}
    unknown = {name: table for name, table in inputs.items() if not isinstance(table, int)}
    rows = union_texts(*(_part(table, name) for name, table in unknown.items()), flagged)
    part = F.col("part")

    def size(name: str) -> Column:
        return F.count_if(part == name) if name in unknown else F.lit(inputs[name]).cast("bigint")

    single, think = F.col("boxes") == 1, F.col("has_think")
    mixed = F.count_if(part.isin(DIRECT, TRACE))
    return rows.agg(
        size("problems").alias("train_rows"),
        size("pool").alias("pool_rows"),
        size("clean").alias("clean_rows"),
        F.count_if(part == DIRECT).alias("direct_rows"),
        F.count_if(part == TRACE).alias("trace_rows"),
        mixed.alias("mixed_rows"),
        optimizer_steps(mixed, accumulation).alias("optimizer_steps"),
        F.count_if((part == DIRECT) & single).alias("direct_single_boxed"),
        F.count_if((part == TRACE) & single).alias("trace_single_boxed"),
        F.count_if((part == DIRECT) & think).alias("direct_with_think"),
        F.count_if((part == TRACE) & think).alias("trace_with_think"),
    )


def mix_checks(report: DataFrame, direct_samples: int) -> DataFrame:
    """One row per check: its name, whether it passed, and how many violations."""
    expected_direct = F.least(F.lit(direct_samples), F.col("pool_rows"))
    violations = {
        "clean_traces_exist": F.when(F.col("clean_rows") > 0, 0).otherwise(1),
        "direct_one_box": F.col("direct_rows") - F.col("direct_single_boxed"),
        "trace_one_box": F.col("trace_rows") - F.col("trace_single_boxed"),
        "direct_no_think": F.col("direct_with_think"),
        "trace_no_think": F.col("trace_with_think"),
        "direct_row_count": F.abs(F.col("direct_rows") - expected_direct),
    }
    rows = [
        F.struct(
            F.lit(name).alias("check"),
            (count == 0).alias("passed"),
            count.cast("bigint").alias("violations"),
        )
        for name, count in violations.items()
    ]
    return report.select(F.inline(F.array(*rows)))


def require_checks(checks: DataFrame) -> None:
    """Raise if a check failed. There is one row per check."""
    failed = checks.filter(~F.col("passed")).collect()
    if failed:
        found = ", ".join(f"{row['check']} ({row['violations']})" for row in failed)
        raise MixError(f"checks failed: {found}")
