"""Verification of completions, and the request rows."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tracemill.operators.requests import (
    SYSTEM_PROMPT,
    TASK_PREAMBLE,
    load_system_prompt,
    request_rows,
)
from tracemill.operators.running import running_start
from tracemill.operators.verification import Fields, verify

PROBLEMS = [
    ("a", " ask a ", " 7 "),
    ("b", "ask b", "cat imagines book"),
    ("c", "ask c", "1"),
    ("d", "ask d", "1"),
    ("e", "ask e", "1"),
    (None, "ask f", "1"),
]
COMPLETIONS = [
    ("a", "so\n\\boxed{ 7 } ", "m"),
    ("a", "so \\boxed{8}", "m"),
    ("b", r"so \boxed{cat\ imagines\ book}", "m"),
    ("c", "", "m"),
    ("d", None, "m"),
    ("z", r"\boxed{1}", "m"),
    (None, r"\boxed{1}", "m"),
]


@pytest.fixture
def verified(texts):
    problems = texts("id prompt answer", PROBLEMS)
    return verify(problems, texts("id completion source_model", COMPLETIONS))


def test_accepted(verified):
    found = {row["id"]: row.asDict() for row in verified.accepted.collect()}
    assert found.keys() == {"a", "b"}
    assert found["a"] == {
        "id": "a",
        "prompt": " ask a ",
        "answer": "7",
        "reasoning": "so\n\\boxed{ 7 } ",
        "boxed_answer": "7",
        "source_model": "m",
    }
    assert found["b"]["boxed_answer"] == r"cat\ imagines\ book"


def test_rejected(verified):
    found = sorted(map(tuple, verified.rejected.collect()), key=repr)
    assert found == [
        ("a", "7", "8", "mismatch", "so \\boxed{8}"),
        ("c", "1", None, "no_box", ""),
        ("d", "1", None, "no_box", ""),
        ("e", "1", None, "no_completion", None),
        (None, "1", None, "no_completion", None),
    ]


def test_summary(verified):
    assert verified.summary().first().asDict() == {"accepted_rows": 2, "rejected_rows": 5}


def test_audit(verified):
    assert verified.audit().first().asDict() == {"repeated_problem_ids": 0, "unknown_completions": 2}


def test_every_problem_row_is_judged(texts):
    """As a left join: copies of a problem are rows of their own, with an id or without."""
    rows = [(i, "ask", "1") for i in ("a", "a", "b", "b", None, None)]
    completions = texts("id completion source_model", [("a", r"\boxed{1}", "m")])
    copied = verify(texts("id prompt answer", rows), completions)
    assert copied.summary().first().asDict() == {"accepted_rows": 2, "rejected_rows": 4}
    assert copied.audit().first()["repeated_problem_ids"] == 2


def test_field_names(texts):
    fields = Fields("key", "question", "truth", "reply", "writer")
    problems = texts("key question truth", PROBLEMS)
    found = verify(problems, texts("key reply writer", COMPLETIONS), fields=fields)
    assert found.summary().first().asDict() == {"accepted_rows": 2, "rejected_rows": 5}
    assert {row["source_model"] for row in found.accepted.collect()} == {"m"}
    assert request_rows(problems, id_field="key", prompt_field="question").count() == len(PROBLEMS)


def test_the_summary_reads_no_prompt(texts, spark, tmp_path):
    texts("id prompt answer", PROBLEMS).write.parquet(str(tmp_path / "problems"))
    problems = spark.read.parquet(str(tmp_path / "problems"))
    summary = verify(problems, texts("id completion source_model", COMPLETIONS)).summary()
    plan = summary._jdf.queryExecution().executedPlan().toString()
    assert "answer:string" in plan and "prompt" not in plan


def test_what_was_stored_can_be_released(texts):
    problems = texts("id prompt answer", PROBLEMS)
    stored = verify(problems, texts("id completion source_model", COMPLETIONS), store=True)
    file = Path(stored.stored.inputFiles()[0].removeprefix("file://"))
    assert file.exists()
    stored.release()
    assert not file.parent.exists()


def test_stored_completions_give_the_same_and_are_read_in_part(texts, verified):
    problems = texts("id prompt answer", PROBLEMS)
    completions = texts("id completion source_model", COMPLETIONS)
    stored = verify(problems, completions, store=True)
    for outcome in ("accepted", "rejected"):
        left, right = getattr(stored, outcome), getattr(verified, outcome)
        assert sorted(map(tuple, left.collect()), key=repr) == sorted(
            map(tuple, right.collect()), key=repr
        )
    assert stored.summary().first() == verified.summary().first()
    plan = stored.summary()._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:string,boxed_answer:string>" in plan
    assert "regexp_extract_all" not in plan


def test_requests(texts):
    problems = texts("id prompt", [("a", 'say "é"\n\\x')])
    row = request_rows(problems).first()
    user = TASK_PREAMBLE + 'say "é"\n\\x'
    assert json.loads(row["body"]) == {
        "model": "gpt-4.1-mini",
        "max_tokens": 1200,
        "messages": [
            {"role": "system", "content": SYSTEM_PROMPT},
            {"role": "user", "content": user},
        ],
        "temperature": 0.2,
    }
    assert (row["token_key"], row["user_message"]) == ("max_tokens", user)


@pytest.mark.parametrize(
    ("model", "o_series"), [("o4-mini", True), ("o1", True), ("omni", False), ("gpt-o1", False)]
)
def test_o_series(texts, model, o_series):
    row = request_rows(texts("id prompt", [("a", "x")]), model, max_tokens=5).first()
    body = json.loads(row["body"])
    assert ("temperature" in body) is not o_series
    assert body["max_completion_tokens" if o_series else "max_tokens"] == 5


def test_system_prompt_file(spark, tmp_path):
    assert load_system_prompt(spark, str(tmp_path / "missing.txt")) == SYSTEM_PROMPT
    file = tmp_path / "prompt.txt"
    file.write_text(" two\nlines \n")
    assert load_system_prompt(spark, str(file)) == "two\nlines"


def test_repeats_on_both_sides_are_paired_one_by_one(texts):
    """Of m problems and n completions of one id max(m, n) pairs are judged, each row in one."""
    problems = [("a", f"ask {i}", "1") for i in range(3)] + [("b", f"ask {i}", "1") for i in range(2)] + [("c", "x", "1")]
    replies = [("a", r"\boxed{1} " + str(i), "m") for i in range(2)] + [("b", r"\boxed{2} " + str(i), "m") for i in range(5)]
    found = verify(texts("id prompt answer", problems), texts("id completion source_model", replies))
    accepted = found.accepted.collect()
    assert sorted(r.prompt for r in accepted) == ["ask 0", "ask 1", "ask 2"]
    assert {r.reasoning for r in accepted} == {r"\boxed{1} 0", r"\boxed{1} 1"}
    rejected = [(r["id"], r.reject_reason, r.preview) for r in found.rejected.collect()]
    assert sorted(rejected, key=repr) == sorted(
        [("b", "mismatch", r"\boxed{2} " + str(i)) for i in range(5)] + [("c", "no_completion", None)], key=repr
    )
    assert found.summary().first().asDict() == {"accepted_rows": 3, "rejected_rows": 6}
    found.release()


def test_pairing_does_not_depend_on_the_partitions(texts, spark):
    problems = texts("id prompt answer", [("a", f"ask {i % 7}", "1") for i in range(50)])
    replies = texts("id completion source_model", [("a", f"\\boxed{{1}} {i % 9}", "m") for i in range(70)])

    def met(p, c):
        return sorted((r.prompt, r.reasoning) for r in verify(p, c).accepted.collect())

    first = met(problems.coalesce(1), replies.coalesce(1))
    assert len(first) == 70 and first == met(problems.repartition(7), replies.repartition(5))


def test_a_hot_id_on_both_sides_lies_in_many_tasks(spark, settings):
    """Of exact copies as well; pairs are as many as the larger side has rows."""
    settings(spark__sql__adaptive__coalescePartitions__enabled="false")
    size = 20_000
    problems = spark.range(size).selectExpr("'hot' as id", "'ask' as prompt", "'1' as answer")
    replies = spark.range(size + 500).selectExpr("'hot' as id", "'\\\\boxed{1}' as completion", "'m' as source_model")
    pairs = verify(problems, replies).pairs
    assert pairs.count() == size + 500
    tasks = running_start(
        problems.select("id", F.monotonically_increasing_id().alias("row"), F.lit(1).alias("one")), ["id"], ["row"], "one"
    )
    assert tasks.agg(F.count_distinct("start")).first()[0] == size


def test_nothing_runs_before_an_outcome_is_asked_for(texts, spark):
    def fail(value):
        raise AssertionError("ran")

    bad = F.udf(fail, "string")
    problems = texts("id prompt answer", [("a", "x", "1")]).withColumn("id", bad("id"))
    verify(problems, texts("id completion source_model", [("a", "y", "m")]))
