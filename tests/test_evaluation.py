"""Scoring of predictions."""

import pytest

from tracemill.operators.evaluation import evaluate, judge_predictions

ROWS = [
    ("1", "7", r"so \boxed{7}"),
    ("2", "7", "  7 "),
    ("3", "7", r"\boxed{1} then \boxed{7.004}"),
    ("4", "7", None),
    ("5", "7", ""),
    ("6", r"cat\ book", "cat book"),
    ("7", None, "7"),
    ("8", "a  b", r"\boxed{a b}"),
    ("9", "0110", "110"),
]


@pytest.mark.parametrize(
    ("tolerance", "matched"), [(None, {"1", "2", "8"}), (0, {"1", "2", "8", "9"}),
                               (0.01, {"1", "2", "3", "8", "9"})]
)
def test_matches(texts, tolerance, matched):
    judged = judge_predictions(texts("id answer prediction", ROWS), tolerance=tolerance)
    assert {row["id"] for row in judged.collect() if row["matched"]} == matched


def test_summary_and_misses(texts):
    result = evaluate(texts("id answer prediction", ROWS), tolerance=0.01, misses=2)
    assert tuple(result.summary.first()) == (9, 5, 5 / 9)
    assert sorted(map(tuple, result.misses.collect())) == [
        ("4", "7", None, None),
        ("5", "7", "", None),
    ]


def test_no_id(texts):
    rows = [row[1:] for row in ROWS]
    result = evaluate(texts("answer prediction", rows), tolerance=0.01, misses=3)
    assert tuple(result.summary.first()) == (9, 5, 5 / 9)
    assert result.misses.count() == 3


def test_nothing_runs_or_is_read_before_it_is_needed(texts, spark, tmp_path):
    path = str(tmp_path / "predictions")
    texts("id answer prediction", ROWS).selectExpr("*", "answer as meta").write.parquet(path)
    predictions = spark.read.parquet(path)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("evaluate", "evaluate")
    result = evaluate(predictions, misses=100)
    summary = result.summary
    assert not tracker.getJobIdsForGroup("evaluate")
    plan = summary._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<answer:string,prediction:string>" in plan


def test_field_names(texts):
    result = evaluate(texts("key truth guess", [("1", "7", "7")]), "truth", "guess", by="key")
    assert result.summary.first()["matched"] == 1


def test_no_rows(texts):
    result = evaluate(texts("id answer prediction", []))
    assert tuple(result.summary.first()) == (0, 0, 0.0)
    assert result.misses.count() == 0


def test_negative_tolerance(texts):
    with pytest.raises(ValueError, match="tolerance"):
        evaluate(texts("id answer prediction", ROWS), tolerance=-0.1)
