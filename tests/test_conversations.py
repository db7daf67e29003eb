"""Conversations from turns, short, long and hot."""

import pytest
from pyspark.sql import functions as F

from tracemill import conversation_segments, conversation_texts
from tracemill.operators import conversations
from tracemill.operators.running import running_start


def turns_of(spark, rows):
    return spark.createDataFrame(rows, "conv_id string, turn long, role string, text string")


def rendered(role, text):
    return f"<|im_start|>{role}\n{text}<|im_end|>"


def test_one_row_for_a_conversation(spark):
    rows = [("a", 2, "assistant", " well "), ("a", 1, "user", "hi"), ("b", 1, "system", "x"), ("a", 3, "user", "so")]
    found = {r.conv_id: r for r in conversation_segments(turns_of(spark, rows)).collect()}
    assert [tuple(m) for m in found["a"].messages] == [("user", "hi"), ("assistant", "well"), ("user", "so")]
    assert (found["a"].segment, found["a"].turns, found["b"].turns) == (0, 3, 1)
    text = {r.conv_id: r.text for r in conversation_texts(turns_of(spark, rows)).collect()}
    assert text["a"] == "\n".join([rendered("user", "hi"), rendered("assistant", "well"), rendered("user", "so")])


@pytest.mark.parametrize("limit", [1, 40, 100, 333])
def test_segments_begin_where_the_length_before_says(spark, limit):
    rows = [("a", i, "user", "x" * (i % 50)) for i in range(60)] + [("b", 0, "user", "y")]
    expected, before = {}, 0
    for _, turn, role, text in rows[:-1]:
        body = rendered(role, text)
        expected.setdefault(before // limit, []).append(body)
        before += len(body)
    found = conversation_texts(turns_of(spark, rows).repartition(5), limit).filter("conv_id = 'a'").collect()
    assert {r.segment: r.text for r in found} == {n: "\n".join(parts) for n, parts in expected.items()}
    assert all(len(r.text) < limit + len(rendered("user", "x" * 49)) + r.turns for r in found)


def test_nulls_ties_copies_and_other_names(spark):
    rows = [(None, 1, "user", "a"), (None, None, "user", "first"), ("c", 1, "user", "same"), ("c", 1, "user", "same")]
    rows += [("c", 1, "assistant", "tie"), ("c", 2, None, "no role"), ("c", 3, "user", None), ("", 1, "user", "")]
    named = turns_of(spark, rows).withColumnsRenamed({"conv_id": "talk", "turn": "at", "role": "who", "text": "said"})
    found = conversation_segments(named, conversation="talk", turn="at", role="who", text="said").collect()
    found = {r.talk: [tuple(m) for m in r.messages] for r in found}
    assert found[None] == [("user", "first"), ("user", "a")]
    assert found["c"] == [("assistant", "tie"), ("user", "same"), ("user", "same"), (None, "no role"), ("user", None)]
    assert found[""] == [("user", "")]
    assert conversation_segments(turns_of(spark, [])).collect() == []
    with pytest.raises(ValueError):
        conversation_segments(named, 0)


def test_a_conversation_of_a_million_turns(spark, settings, monkeypatch):
    settings(spark__sql__adaptive__coalescePartitions__enabled="false")
    stored = []
    real = conversations.running_start
    monkeypatch.setattr(conversations, "running_start", lambda df, *a: stored.append(df) or real(df, *a))
    number = F.col("id")
    turns = spark.range(1_000_000, numPartitions=8).select(
        F.when(number % 10 > 0, "hot").otherwise(F.concat(F.lit("c"), number)).alias("conv_id"),
        number.alias("turn"),
        F.when(number % 2 == 0, "user").otherwise("assistant").alias("role"),
        number.cast("string").alias("text"),
    )
    found = conversation_texts(turns, 50_000)
    hot = found.filter("conv_id = 'hot'")
    sizes = hot.agg(F.max(F.length("text")).alias("most"), F.sum("turns").alias("turns"), F.count("*").alias("rows")).first()
    assert sizes.turns == 900_000 and sizes.most < 60_000 and sizes.rows > 500
    assert found.count() - sizes.rows == 100_000
    # In order and without gaps: the numbers in all texts rise.
    numbers = hot.select("segment", F.explode(F.regexp_extract_all("text", F.lit("\n(\\d+)<"), 1)).alias("n"))
    ends = numbers.groupBy("segment").agg(F.min(F.col("n").cast("long")).alias("low"), F.max(F.col("n").cast("long")).alias("high"))
    ends = sorted(ends.collect(), key=lambda r: r.segment)
    assert all(a.high < b.low for a, b in zip(ends, ends[1:]))
    chunks = stored[0].repartitionByRange("conv", "turn").select(F.spark_partition_id().alias("task"))
    assert chunks.distinct().count() > 4


def test_running_totals_of_the_whole_table_and_of_groups(spark):
    df = spark.range(1000).selectExpr("id", "id % 3 as g", "id % 7 as amount").repartition(6)
    whole = {r.id: r.start for r in running_start(df, [], ["id"], "amount").collect()}
    assert whole == {i: sum(j % 7 for j in range(i)) for i in range(1000)}
    groups = {r.id: r.start for r in running_start(df, ["g"], ["id"], "amount").collect()}
    assert groups == {i: sum(j % 7 for j in range(i % 3, i, 3)) for i in range(1000)}
