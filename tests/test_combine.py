"""Joins, repeats and unions, with missing and hot ids."""

import pytest
from pyspark.sql import functions as F

from tracemill.operators.combine import (
    attach_completions,
    check_repeats,
    exclude_ids,
    oversample,
    union_texts,
    unknown_completions,
)


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


@pytest.fixture
def small_partitions(settings):
    """Make a few kilobytes count as skewed, and leave out broadcasts."""
    adaptive = "spark__sql__adaptive__"
    settings(
        spark__sql__autoBroadcastJoinThreshold=-1,
        **{
            adaptive + "skewJoin__skewedPartitionThresholdInBytes": "50KB",
            adaptive + "skewJoin__skewedPartitionFactor": "2",
            adaptive + "advisoryPartitionSizeInBytes": "50KB",
        },
    )


def test_exclude_keeps_rows_without_id(texts):
    problems = texts("id prompt", [("a", "1"), ("b", "2"), (None, "3"), ("", "4"), ("b", "5")])
    used = texts("id", [("b",), (None,), ("",), ("b",), ("z",)])
    found = exclude_ids(problems, used).select("prompt").collect()
    assert sorted(row["prompt"] for row in found) == ["1", "3", "4"]


def test_exclude_nothing(texts):
    problems = texts("id", [("a",), (None,)])
    assert exclude_ids(problems, texts("id", [])).count() == 2


def hot(spark, rows, hot_id, column):
    number = F.col("id")
    ids = F.when(number % 3 == 0, hot_id).otherwise(F.concat(F.lit("p"), number))
    filler = F.sha2(number.cast("string"), 512)
    return spark.range(rows, numPartitions=8).select(ids.alias("id"), filler.alias(column))


def test_excluding_splits_a_hot_id(spark, small_partitions):
    problems = hot(spark, 30000, "hot", "prompt")
    used = hot(spark, 30000, "p3", "text")
    kept = exclude_ids(problems, used)
    assert "SortMergeJoin(skew=true)" in executed(kept)
    assert kept.count() == 10000


def test_excluding_does_not_carry_copies_of_an_id(spark, small_partitions):
    """A hot id among the used ones is reduced before it is shuffled."""
    used = hot(spark, 30000, "p3", "text")
    plan = executed(exclude_ids(hot(spark, 100, "hot", "prompt"), used))
    assert plan.count("HashAggregate") == 2


def test_attaching_splits_a_hot_completion(spark, small_partitions):
    problems = hot(spark, 30000, "p0", "prompt").filter("id <> 'p0'")
    completions = hot(spark, 30000, "p1", "completion")
    pairs, silent = attach_completions(problems, completions)
    assert "SortMergeJoin(skew=true)" in executed(pairs)
    assert pairs.count() == 30000
    assert silent.count() == 0


def test_attach_pairs_and_leftovers(texts):
    problems = texts("id prompt", [("a", "1"), ("b", "2"), (None, "3"), ("", "4")])
    completions = texts("id completion", [("a", "x"), ("a", "y"), ("z", "q"), (None, "n"), ("", "e")])
    pairs, silent = attach_completions(problems, completions)
    assert sorted(map(tuple, pairs.select("id", "completion").collect())) == [("a", "x"), ("a", "y")]
    assert sorted(row["prompt"] for row in silent.collect()) == ["2", "3", "4"]


def test_every_copy_of_a_problem_counts(texts):
    problems = texts("id prompt", [("hot", "1")] * 500 + [(f"p{i}", "2") for i in range(1000)])
    pairs, silent = attach_completions(problems, texts("id completion", [("hot", "c"), ("p1", "d")]))
    assert pairs.count() == 501
    assert silent.count() == 999


def test_ids_repeated_on_both_sides_are_refused(texts):
    problems = texts("id prompt", [("hot", "1")] * 2 + [("a", "2"), (None, "3"), (None, "4")])
    check_repeats(problems, texts("id completion", [("a", "x"), ("a", "y"), ("hot", "z"), (None, "n"), (None, "n")]))
    with pytest.raises(ValueError, match="hot"):
        check_repeats(problems, texts("id completion", [("hot", "x"), ("hot", "y")]))


def test_completions_of_no_problem(texts):
    problems = texts("id prompt", [("a", "1"), (None, "2")])
    completions = texts("id completion", [("a", "x"), ("z", "y"), (None, "n"), ("", "e")])
    found = unknown_completions(problems, completions).select("completion").collect()
    assert sorted(row["completion"] for row in found) == ["e", "n", "y"]


@pytest.mark.parametrize("times", [0, 1, 2, 5])
def test_oversample(texts, times):
    found = oversample(texts("id", [("a",), ("b",)]), times).collect()
    assert sorted(map(tuple, found)) == [(i, c) for i in "ab" for c in range(times)]


def test_oversample_negative(texts):
    with pytest.raises(ValueError, match="negative"):
        oversample(texts("id", [("a",)]), -1)


def test_union_keeps_duplicates_and_matches_names(texts):
    found = union_texts(texts("a b", [("1", "2")]), texts("b a", [("2", "1")])).collect()
    assert [row.asDict() for row in found] == [{"a": "1", "b": "2"}] * 2
