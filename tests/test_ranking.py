"""Exact cuts against sorting in plain Python, with ties, copies and hot keys."""

import hashlib
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tracemill.operators import ranking
from tracemill.operators.ranking import find_cut, first_rows, order_key, seeded_key, split_at
from tracemill.operators.sampling import (
    head_limit,
    sample_exact,
    sample_strict,
    shuffle_rows,
    split_train_test,
)


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def ids(df):
    return [row["id"] for row in df.select("id").collect()]


@pytest.fixture(scope="module")
def numbered(spark):
    return spark.range(5000, numPartitions=7).select(
        F.concat(F.lit("p"), F.col("id")).alias("id"), F.lit("x").alias("prompt")
    ).cache()


@pytest.mark.parametrize("count", [0, 1, 20, 21, 300, 2500, 4999, 5000, 9000])
def test_sample_takes_the_lowest_seeded_keys(numbered, count):
    found = ids(sample_exact(numbered, count, seed=3))
    expected = sorted((f"p{i}" for i in range(5000)), key=lambda i: md5(f"3:{i}"))[:count]
    assert sorted(found) == sorted(expected)


def test_sample_does_not_depend_on_partitions(numbered):
    assert sorted(ids(sample_exact(numbered, 300))) == sorted(
        ids(sample_exact(numbered.repartition(3, "prompt"), 300))
    )


def test_sample_depends_on_the_seed(numbered):
    assert set(ids(sample_exact(numbered, 300, 1))) != set(ids(sample_exact(numbered, 300, 2)))


def test_strict_sample(numbered):
    assert sample_strict(numbered, 5000).count() == 5000
    with pytest.raises(ValueError, match="cannot sample"):
        sample_strict(numbered, 5001)


def test_negative_count(numbered):
    with pytest.raises(ValueError, match="negative"):
        sample_exact(numbered, -1)


def test_cut_of_an_empty_table(numbered):
    empty = numbered.filter(F.lit(False))
    assert find_cut(empty, F.col("id"), 5).bound is None
    assert sample_exact(empty, 50).count() == 0


def hot_rows():
    """A third exact copies, a third with one id but own texts, some without id."""
    rows = [("copy", "same")] * 1000
    rows += [("hot", f"text {i}") for i in range(1000)]
    rows += [(None, f"none {i % 10}") for i in range(300)] + [("", "blank")] * 50
    return rows + [(f"p{i}", "own") for i in range(650)]


@pytest.mark.parametrize("count", [21, 137, 500, 1111, 1600, 2047, 2600, 2999])
def test_sample_of_hot_ids_and_copies_is_exact(texts, count):
    rows = hot_rows()
    table = texts("id prompt", rows).repartition(5)
    found = Counter(tuple(row) for row in sample_exact(table, count).collect())
    assert found.total() == count
    assert not found - Counter(rows)
    # whole ids below the cut, none above it
    order = sorted(rows, key=lambda row: md5(f"42:{row[0] or ''}"))
    last = md5(f"42:{order[count - 1][0] or ''}")
    below = Counter(row for row in rows if md5(f"42:{row[0] or ''}") < last)
    assert not below - found


@pytest.mark.parametrize("ratio", [0.001, 0.1, 1 / 3, 0.5, 0.77])
def test_split_of_hot_ids_and_copies_loses_nothing(texts, ratio):
    rows = hot_rows()
    train, test = split_train_test(texts("id prompt", rows), ratio)
    train_rows = Counter(tuple(row) for row in train.collect())
    test_rows = Counter(tuple(row) for row in test.collect())
    assert test_rows.total() == math.ceil(len(rows) * ratio)
    assert train_rows + test_rows == Counter(rows)


def test_many_copies_are_multiplied_in_parts(texts, monkeypatch):
    monkeypatch.setattr(ranking, "COPIES_PER_TASK", 7)
    table = texts("id prompt", [("copy", "same")] * 100)
    train, test = split_train_test(table, 0.37)
    assert (train.count(), test.count()) == (63, 37)
    assert set(map(tuple, test.collect())) == {("copy", "same")}


def test_split_ratios(numbered):
    assert split_train_test(numbered, 0)[1] is None
    assert split_train_test(numbered, -0.5)[0] is numbered
    with pytest.raises(ValueError, match="below 1"):
        split_train_test(numbered, 1)
    with pytest.raises(ValueError, match="no training rows"):
        split_train_test(numbered.limit(1), 0.5)


def test_split_follows_the_seeded_order(numbered):
    train, test = split_train_test(numbered, 0.1, seed=5)
    order = sorted((f"p{i}" for i in range(5000)), key=lambda i: md5(f"5:{i}"))
    assert set(ids(test)) == set(order[:500])
    assert set(ids(train)) == set(order[500:])


def random_ids(count):
    rng = random.Random(9)
    letters = "ab09_ é𝔘　~"
    made = ["".join(rng.choices(letters, k=rng.randint(0, 6))) for _ in range(count)]
    return made + [None] * 30


@pytest.mark.parametrize("count", [1, 20, 30, 31, 250, 1000, 1500])
def test_head_by_text(texts, count):
    values = random_ids(1500)
    order = sorted(values, key=lambda v: (v is not None, (v or "").encode()))
    found = ids(head_limit(texts("id", [(v,) for v in values]), count))
    assert Counter(found) == Counter(order[:count])


@pytest.mark.parametrize("small", [0, 3, 4096])
def test_cut_by_few_and_by_all_digits(numbered, monkeypatch, small):
    """Whether a bucket is counted by more digits or by whole keys, the cut is the same."""
    monkeypatch.setattr(ranking, "SMALL_BUCKET", small)
    order = sorted(md5(f"3:p{i}") for i in range(5000))
    for rank in (1, 777, 4999):
        cut = find_cut(numbered, seeded_key(3, "id"), rank)
        assert sum(key < cut.bound for key in order) + cut.extra == rank


def test_a_hot_key_takes_few_passes(spark, monkeypatch):
    """A key of a third of all rows is recognized, not followed digit by digit."""
    number = F.col("id")
    table = spark.range(60000).select(F.when(number % 3 == 0, -1).otherwise(number).alias("id"))
    key = seeded_key(1, "id")
    order = sorted(md5(f"1:{-1 if i % 3 == 0 else i}") for i in range(60000))
    passes = []
    collect = type(table).collect
    monkeypatch.setattr(type(table), "collect", lambda df: passes.append(1) or collect(df))
    cut = find_cut(table, key, order.index(md5("1:-1")) + 100)
    assert (cut.bound, cut.extra, cut.tied) == (md5("1:-1"), 100, 20000)
    assert len(passes) <= 4


def test_head_of_ids_with_a_long_common_start(texts):
    rows = [(f"problem-with-a-long-name-{i:06d}",) for i in range(1000)]
    found = ids(head_limit(texts("id", rows), 321))
    assert sorted(found) == [row[0] for row in rows[:321]]


@pytest.mark.parametrize("count", [5, 21, 400])
def test_head_by_number(spark, count):
    rng = random.Random(10)
    values = [rng.randint(-(2**63), 2**63 - 1) for _ in range(500)] + [0, -1, 1, 2**63 - 1]
    table = spark.createDataFrame([(v,) for v in values], "id long")
    assert Counter(ids(head_limit(table, count))) == Counter(sorted(values)[:count])


def test_order_needs_text_or_integers(spark):
    with pytest.raises(TypeError):
        order_key(spark.createDataFrame([(1.5,)], "id double"), "id")


def test_split_at_keeps_every_row(numbered):
    head, tail = split_at(numbered, [seeded_key(1, "id")], 1234)
    assert head.count() == 1234
    assert head.unionByName(tail).exceptAll(numbered).count() == 0
    assert tail.count() == 5000 - 1234


def test_first_rows_with_and_without_a_uniform_key_agree(numbered):
    key = seeded_key(8, "id")
    few = ids(first_rows(numbered, 20, key, uniform=True))
    assert sorted(few) == sorted(ids(first_rows(numbered, 20, key)))


def test_fewer_rows_are_among_more_where_all_keys_tie(texts):
    rows = [("same", f"text {i}") for i in range(60)]
    table = texts("id prompt", rows)
    samples = [{row["prompt"] for row in sample_exact(table, n).collect()} for n in range(18, 24)]
    assert [len(s) for s in samples] == list(range(18, 24))
    assert all(few < more for few, more in zip(samples, samples[1:]))


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_rows_a_microsecond_apart_are_no_copies(spark, kind):
    made = F.timestamp_micros(F.col("id") + 10**15).cast(kind).alias("at")
    table = spark.range(60).select(F.lit("same").alias("id"), made)
    assert sample_exact(table, 30).distinct().count() == 30
    train, test = split_train_test(table, 0.5)
    assert train.unionByName(test).distinct().count() == 60


def test_columns_that_cannot_be_told_apart_are_refused(spark):
    table = spark.range(30).select("id", F.create_map(F.lit("a"), F.col("id")).alias("m"))
    with pytest.raises(TypeError, match="m: map"):
        sample_exact(table, 3)


def test_long_starts_take_few_passes(texts, monkeypatch):
    """Two groups of ids, one with a long start of its own."""
    start = "https://a-very-long-host-name.example.org/with/a/long/path/"
    rows = [(f"{start}{i:06d}",) for i in range(6000)] + [(f"a{i:06d}",) for i in range(4000)]
    table = texts("id", rows)
    looks = []
    for name in ("collect", "first"):
        plain = getattr(type(table), name)
        monkeypatch.setattr(type(table), name, lambda df, plain=plain: looks.append(1) or plain(df))
    found = head_limit(table, 7000)
    assert len(looks) <= 12
    monkeypatch.undo()
    assert sorted(ids(found)) == sorted(row[0] for row in rows)[:7000]


def test_shuffle_is_a_seeded_order(texts):
    rows = [(f"p{i}", "own") for i in range(500)]
    shuffled = ids(shuffle_rows(texts("id prompt", rows), seed=4))
    assert shuffled == sorted((row[0] for row in rows), key=lambda i: md5(f"4:{i}"))
    again = ids(shuffle_rows(texts("id prompt", rows).repartition(3), seed=4))
    assert again == shuffled
    assert ids(shuffle_rows(texts("id prompt", rows), seed=5)) != shuffled


def test_shuffle_keeps_copies_and_spreads_them(texts, settings):
    settings(spark__sql__adaptive__enabled="false")
    rows = hot_rows()
    shuffled = shuffle_rows(texts("id prompt", rows))
    assert Counter(map(tuple, shuffled.collect())) == Counter(rows)
    copies = shuffled.filter("id = 'copy'").groupBy(F.spark_partition_id()).count().count()
    assert copies > 1
