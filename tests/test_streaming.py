"""Arriving completions: nothing twice, nothing lost."""

import json
import time

from tracemill.operators.verification import Fields
from tracemill.streaming.arrivals import (
    read_accepted,
    read_rejected,
    verify_arrivals,
    watch_completions,
    watch_json_lines,
)
from tracemill.streaming.pairing import verify_pairs


def put(folder, name, *completions):
    folder.mkdir(exist_ok=True)
    lines = [json.dumps({"id": i, "completion": c, "source_model": "m"}) for i, c in completions]
    (folder / name).write_text("\n".join(lines))


def test_rerun_adds_nothing_and_a_new_file_only_its_rows(texts, spark, tmp_path):
    problems = texts("id prompt answer", [("a", "ask", " 7"), ("b", "ask", "x y")])
    folder, output, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")

    def run():
        query = verify_arrivals(problems, watch_completions(spark, str(folder), 1), output, state)
        query.awaitTermination()
        accepted = sorted((r["id"], r["reasoning"]) for r in read_accepted(spark, output).collect())
        rejected = sorted((r["id"], r["reject_reason"]) for r in read_rejected(spark, output).collect())
        return accepted, rejected

    put(folder, "1.json", ("a", "so \\boxed{7}"), ("b", "none"), ("z", "\\boxed{1}"))
    first = run()
    assert first == ([("a", "so \\boxed{7}")], [("b", "no_box")])
    assert run() == first
    put(folder, "2.json", ("b", r"\boxed{x\ y}"), ("a", r"\boxed{8}"))
    put(folder, "3.json", ("b", r"again \boxed{x y}"))
    accepted, rejected = run()
    assert accepted == [("a", "so \\boxed{7}"), ("b", r"\boxed{x\ y}"), ("b", r"again \boxed{x y}")]
    assert rejected == [("a", "mismatch"), ("b", "no_box")]
    assert run() == (accepted, rejected)


def test_another_checkpoint_does_not_overwrite(texts, spark, tmp_path):
    problems = texts("id prompt answer", [("a", "ask", "7"), ("b", "ask", "8")])
    output = str(tmp_path / "out")
    for name, answer in (("a", 7), ("b", 8)):
        folder = tmp_path / f"in-{name}"
        put(folder, "1.json", (name, f"\\boxed{{{answer}}}"))
        arriving = watch_completions(spark, str(folder))
        verify_arrivals(problems, arriving, output, str(tmp_path / f"state-{name}")).awaitTermination()
    assert sorted(row["id"] for row in read_accepted(spark, output).collect()) == ["a", "b"]


def test_no_input_gives_no_rows(texts, spark, tmp_path):
    problems = texts("id prompt answer", [("a", "ask", "7")])
    (tmp_path / "in").mkdir()
    arriving = watch_completions(spark, str(tmp_path / "in"))
    output = str(tmp_path / "out")
    verify_arrivals(problems, arriving, output, str(tmp_path / "state")).awaitTermination()
    assert read_accepted(spark, output).collect() == read_rejected(spark, output).collect() == []
    assert "reasoning" in read_accepted(spark, output).columns


def outcomes(spark, output):
    accepted = sorted((r["id"], r["reasoning"]) for r in read_accepted(spark, output).collect())
    rejected = [(r["id"], r["predicted"], r["reject_reason"]) for r in read_rejected(spark, output).collect()]
    return accepted, sorted(rejected, key=repr)


def test_outcome_does_not_depend_on_the_batches(texts, spark, tmp_path):
    """Repeated ids on both sides, and an id of different problems, in one file a batch or ten."""
    problems = [("a", "ask", "7"), ("a", "ask", "7"), ("b", "ask", "1"), ("b", "other", "2"), ("c", "ask", "3")]
    folder = tmp_path / "in"
    replies = [("a", "one \\boxed{7}"), ("a", "two \\boxed{7}"), ("a", "\\boxed{8}"), ("b", "\\boxed{1}"), ("c", "\\boxed{3}")]
    for number, reply in enumerate(replies):
        put(folder, f"{number}.json", reply)
    found = []
    for files in (1, 10):
        output, state = str(tmp_path / f"out-{files}"), str(tmp_path / f"state-{files}")
        arriving = watch_completions(spark, str(folder), files)
        verify_arrivals(texts("id prompt answer", problems), arriving, output, state).awaitTermination()
        found.append(outcomes(spark, output))
    assert found[0] == found[1]
    accepted, rejected = found[0]
    assert accepted == [("a", "one \\boxed{7}"), ("a", "two \\boxed{7}"), ("c", "\\boxed{3}")]
    assert rejected == [("a", "8", "mismatch"), ("b", "1", "ambiguous_id")]


def test_other_field_names(texts, spark, tmp_path):
    fields = Fields("key", "question", "truth", "reply", "writer")
    folder, output = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    (folder / "1.json").write_text(json.dumps({"key": "a", "reply": "\\boxed{7}", "writer": "w"}))
    arriving = watch_completions(spark, str(folder), fields=fields)
    problems = texts("key question truth", [("a", "ask", "7")])
    verify_arrivals(problems, arriving, output, str(tmp_path / "state"), fields).awaitTermination()
    assert [(r["id"], r.prompt, r.source_model) for r in read_accepted(spark, output).collect()] == [("a", "ask", "w")]


def put_problems(folder, name, *problems):
    folder.mkdir(exist_ok=True)
    lines = [json.dumps({"id": i, "prompt": p, "answer": a}) for i, p, a in problems]
    (folder / name).write_text("\n".join(lines))


def test_two_streams_with_late_problems_and_late_completions(spark, tmp_path, settings):
    settings(spark__sql__shuffle__partitions=2)
    asked, replied = tmp_path / "problems", tmp_path / "completions"
    output, state = str(tmp_path / "out"), str(tmp_path / "state")

    def run(patience):
        """Every run is a restart from the checkpoint."""
        problems = watch_json_lines(spark, str(asked), ("id", "prompt", "answer"))
        verify_pairs(problems, watch_completions(spark, str(replied)), output, state, patience).awaitTermination()
        return outcomes(spark, output)

    put_problems(asked, "1.json", ("a", "ask", " 7"), ("b", "ask", "x y"), ("quiet", "ask", "1"), (None, "ask", "1"))
    put(replied, "1.json", ("a", "\\boxed{7}"), ("late", "\\boxed{2}"), ("lost", "\\boxed{5}"), (None, "\\boxed{1}"))
    accepted, rejected = run(3600)
    assert accepted == [("a", "\\boxed{7}")] and rejected == [(None, None, "no_completion")]
    # A problem after its completion; the same completion again; another problem under a known id.
    put_problems(asked, "2.json", ("late", "ask", "2"), ("a", "other", "8"))
    put(replied, "2.json", ("a", "\\boxed{7}"), ("b", r"\boxed{x\ y}"), ("b", "no box"))
    accepted, rejected = run(1)
    assert accepted == [("a", "\\boxed{7}"), ("b", r"\boxed{x\ y}"), ("late", "\\boxed{2}")]
    assert rejected == [("a", None, "repeated_id"), ("b", None, "no_box"), (None, None, "no_completion")]


def test_waits_end(spark, tmp_path, settings):
    settings(spark__sql__shuffle__partitions=2)
    asked, replied = tmp_path / "problems", tmp_path / "completions"
    output, state = str(tmp_path / "out"), str(tmp_path / "state")

    def run():
        problems = watch_json_lines(spark, str(asked), ("id", "prompt", "answer"))
        verify_pairs(problems, watch_completions(spark, str(replied)), output, state, 1).awaitTermination()
        return outcomes(spark, output)

    put_problems(asked, "1.json", ("a", "ask", "7"), ("quiet", "ask", "1"))
    put(replied, "1.json", ("a", "\\boxed{7}"), ("lost", "\\boxed{5}"))
    run()
    time.sleep(1.5)
    put(replied, "2.json", ("z", "\\boxed{0}"))
    accepted, rejected = run()
    assert accepted == [("a", "\\boxed{7}")]
    assert rejected == [("lost", "5", "no_problem"), ("quiet", None, "no_completion")]
    # The ids are forgotten now: what comes after the wait has no problem any more.
    time.sleep(1.5)
    put(replied, "3.json", ("quiet", "\\boxed{1}"))
    run()
    time.sleep(1.5)
    put(replied, "4.json", ("y", "\\boxed{0}"))
    assert ("quiet", "1", "no_problem") in run()[1]
