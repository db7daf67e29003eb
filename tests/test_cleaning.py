"""Cleaning of traces, row by row and in counts."""

import pytest

from tracemill.operators.cleaning import (
    clean_report,
    clean_traces,
    judge_traces,
    rejected_traces,
    trace_flags,
)

FIELDS = "id prompt answer reasoning"


def judged(texts, *row):
    return judge_traces(texts(FIELDS, [row])).first()


@pytest.mark.parametrize(
    ("row", "reason"),
    [
        (("1", " ", "7", r"so \boxed{7}"), "empty_field"),
        (("1", "p", "", r"so \boxed{7}"), "empty_field"),
        (("1", "p", "7", "　"), "empty_field"),
        (("1", None, "7", r"so \boxed{7}"), "empty_field"),
        (("1", "p", None, r"so \boxed{7}"), "empty_field"),
        (("1", "p", "7", None), "empty_field"),
        (("1", "p", "7", r"so \boxed{8}"), "box_differs"),
        (("1", "p", "7", "so 7"), "box_differs"),
        (("1", "p", "7", r"so \boxed{7.0}"), "box_differs"),
        (("1", "p", "7", r"\boxed{7}"), "nothing_left"),
        (("1", "p", "7", r" .。 \boxed{7}"), "nothing_left"),
        (("1", "p", "7", r"so \boxed{7}"), None),
        ((None, "p", "7", r"so \boxed{7}"), None),
    ],
)
def test_reasons(texts, row, reason):
    assert judged(texts, *row)["reject_reason"] == reason


def test_clean_fields(texts):
    rows = [("1", " p ", " a\\ b ", "x\\ y. \\boxed{a\\ \\ b} done")]
    found = clean_traces(texts(FIELDS, rows)).first()
    assert found.asDict() == {
        "id": "1",
        "prompt": "p",
        "answer": "a b",
        "reasoning": "x y",
        "boxed_answer": "a b",
    }


def test_earlier_boxes_stay(texts):
    found = judged(texts, "1", "p", "7", r"r1 \boxed{x} r2 \boxed{7}")
    assert found["reasoning"] == r"r1 \boxed{x} r2"


def test_an_unclosed_box_after_the_answer_is_what_gets_cut(texts):
    found = judged(texts, "1", "p", "7", r"r1 \boxed{7} r2 \boxed{8")
    assert (found["reject_reason"], found["reasoning"]) == (None, r"r1 \boxed{7} r2")


def test_other_backslashes_matter_here(texts):
    assert judged(texts, "1", "p", "a", r"so \boxed{\a}")["reject_reason"] == "box_differs"


ROWS = [
    ("1", "p", "7", r"so \boxed{7}"),
    ("2", "p", "7", r"so \boxed{7}."),
    ("3", "p", "a b", r"so \boxed{a\ b}  "),
    ("4", "p", "7", "nothing"),
    ("5", "p", "7", r"open \boxed{7"),
    ("6", "p", "7", ""),
]


def test_report(texts):
    assert clean_report(texts(FIELDS, ROWS)).first().asDict() == {
        "raw_rows": 6,
        "boxed_any": 4,
        "boxed_at_end": 2,
        "latex_blank": 1,
        "clean_rows": 3,
        "rejected_rows": 3,
    }


def test_report_of_nothing(texts):
    assert set(clean_report(texts(FIELDS, [])).first()) == {0}


def test_flags_and_rejects(texts):
    table = texts(FIELDS, ROWS)
    flags = {row["id"]: tuple(row)[1:] for row in trace_flags(table).collect()}
    assert flags["3"] == (True, True, True)
    assert flags["5"] == (True, False, False)
    assert {row["id"] for row in rejected_traces(table).collect()} == {"4", "5", "6"}


def test_each_text_step_runs_once(texts):
    """No filter repeats the extraction, and all runs in generated code."""
    plan = clean_traces(texts(FIELDS, ROWS))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_extract_all") == 1
    assert "Python" not in plan
