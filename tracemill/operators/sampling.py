"""Seeded sampling, splitting and shuffling, and the ordered head."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracemill.operators.ranking import (
    content_key,
    first_rows,
    order_key,
    seeded_key,
    split_at,
)
from tracemill.sources.staging import stage

DEFAULT_SEED = 42


def head_limit(df: DataFrame, count: int, by: str = "id") -> DataFrame:
    """The first ``count`` records by ``by``, in no order; Spark tables have no file order."""
    return first_rows(df, count, order_key(df, by))


def sample_exact(
    df: DataFrame, count: int, seed: int = DEFAULT_SEED, keys: Sequence[str] = ("id",)
) -> DataFrame:
    """``count`` rows without replacement, or all if there are fewer.

    The choice depends on the seed and the key columns only, not on how the table
    is partitioned.
    """
    return first_rows(df, count, seeded_key(seed, *keys), uniform=True)


def sample_counted(
    df: DataFrame, count: int, seed: int = DEFAULT_SEED, keys: Sequence[str] = ("id",)
) -> tuple[DataFrame, int]:
    """As :func:`sample_exact`, with the number of rows there are.

    The first pass of the sample counts them anyway.
    """
    if count < 0:
        raise ValueError(f"row count must not be negative: {count}")
    counted = []

    def wanted(available: int) -> int:
        counted.append(available)
        return count

    sample = split_at(df, [seeded_key(seed, *keys), content_key(df)], wanted)[0]
    return sample, counted[0]


def sample_strict(
    df: DataFrame, count: int, seed: int = DEFAULT_SEED, keys: Sequence[str] = ("id",)
) -> DataFrame:
    """As :func:`sample_exact`, but asking for more rows than there are is an error."""
    if count < 0:
        raise ValueError(f"row count must not be negative: {count}")

    def wanted(available: int) -> int:
        if count > available:
            raise ValueError(f"cannot sample {count} of {available} rows")
        return count

    return split_at(df, [seeded_key(seed, *keys), content_key(df)], wanted)[0]


def split_train_test(
    df: DataFrame,
    test_ratio: float,
    seed: int = DEFAULT_SEED,
    keys: Sequence[str] = ("id",),
) -> tuple[DataFrame, DataFrame | None]:
    """Train and test part; no test part for a ratio of zero or less.

    The test part has ``ceil(rows * ratio)`` rows.
    """
    if test_ratio <= 0:
        return df, None
    if test_ratio >= 1:
        raise ValueError(f"test ratio must be below 1: {test_ratio}")

    def test_rows(total: int) -> int:
        wanted = math.ceil(total * test_ratio)
        if total and wanted >= total:
            raise ValueError(f"a ratio of {test_ratio} leaves no training rows of {total}")
        return wanted

    test, train = split_at(df, [seeded_key(seed, *keys), content_key(df)], test_rows)
    return train, test


def shuffle_rows(
    df: DataFrame,
    seed: int = DEFAULT_SEED,
    keys: Sequence[str] = ("id",),
    stored: bool = False,
) -> DataFrame:
    """All rows in a seeded random order, as a range-partitioned sort.

    Rows with equal keys are ordered by content. Exact copies are told apart by
    their position, or else a group of copies would be one range and one task. The
    position must not change when a lost task runs again, so rows are read from a
    stored table: pass ``stored`` where ``df`` already is one (file scans with only
    row-wise steps and unions on top), otherwise it is written first.
    """
    source = df if stored else stage(df, "shuffle")
    named = source.withColumn("_shuffle_key", seeded_key(seed, *keys))
    named = named.withColumn("_content_key", F.xxhash64(*df.columns))
    named = named.withColumn("_position", F.monotonically_increasing_id())
    ordered = named.orderBy("_shuffle_key", "_content_key", "_position")
    return ordered.drop("_shuffle_key", "_content_key", "_position")

