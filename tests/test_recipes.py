"""Training mixes, their checks, and configured data sets."""

import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tracemill import (
    MixError,
    Recipe,
    baseline_recipe,
    build_dataset,
    format_dataset,
    mixed_recipe,
    trace_recipe,
    training_text,
)

SUFFIX = "Put your final answer inside \\boxed{}."


def problems(spark, count):
    return spark.range(count).select(
        F.concat(F.lit("p"), F.col("id")).alias("id"),
        F.concat(F.lit("ask "), F.col("id")).alias("prompt"),
        F.concat(F.col("id"), F.lit("\\ km")).alias("answer"),
    )


def traces(spark, count):
    reasoning = F.concat(F.lit("think. \\boxed{"), F.col("answer"), F.lit("}"))
    return problems(spark, count).withColumn("reasoning", reasoning)


@pytest.fixture(scope="module")
def full_mix(spark):
    """435 sound traces and enough problems, as the published counts assume."""
    return mixed_recipe(problems(spark, 5600), traces(spark, 435))


def test_published_counts(full_mix):
    assert full_mix.report().first().asDict() == {
        "train_rows": 5600,
        "pool_rows": 5165,
        "clean_rows": 435,
        "direct_rows": 5000,
        "trace_rows": 870,
        "mixed_rows": 5870,
        "optimizer_steps": 1467,
        "direct_single_boxed": 5000,
        "trace_single_boxed": 870,
        "direct_with_think": 0,
        "trace_with_think": 0,
    }


def test_cleaning_is_counted_on_the_way(full_mix):
    assert full_mix.cleaning == {
        "raw_rows": 435,
        "boxed_any": 435,
        "boxed_at_end": 435,
        "latex_blank": 435,
        "clean_rows": 435,
        "rejected_rows": 0,
    }


def test_ordering_needs_no_join(full_mix):
    """Positions are only stable over stored tables."""
    plan = full_mix.ordered._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan


def test_sound_mix_passes(full_mix):
    checks = full_mix.checks().collect()
    assert len(checks) == 6 and all(row["passed"] for row in checks)
    full_mix.require()


def test_mix_rows(full_mix):
    rows = Counter((row["origin"], row["id"]) for row in full_mix.rows.collect())
    traced = {f"p{i}" for i in range(435)}
    assert {i: n for (origin, i), n in rows.items() if origin == "trace"} == dict.fromkeys(traced, 2)
    direct = {i: n for (origin, i), n in rows.items() if origin == "direct"}
    assert set(direct.values()) == {1} and not traced & direct.keys()


def test_mix_texts(full_mix):
    rows = {(row["origin"], row["id"]): row["text"] for row in full_mix.rows.collect()}
    assert rows["trace", "p3"] == (
        f"<|im_start|>user\nask 3\n{SUFFIX}<|im_end|>\n"
        "<|im_start|>assistant\nthink\n\n\\boxed{3 km}<|im_end|>"
    )
    number = next(i for origin, i in rows if origin == "direct")[1:]
    assert rows["direct", f"p{number}"] == (
        f"<|im_start|>user\nask {number}\n{SUFFIX}<|im_end|>\n"
        f"<|im_start|>assistant\n\\boxed{{{number} km}}<|im_end|>"
    )


def test_mix_order_is_a_permutation(full_mix):
    ordered = full_mix.text()
    assert ordered.columns == ["text"]
    first = [row["text"] for row in ordered.collect()]
    assert Counter(first) == Counter(row["text"] for row in full_mix.rows.collect())
    origins = [row["origin"] for row in full_mix.ordered.collect()]
    # shuffled: each tenth holds traces in about their share of 15 %
    tenths = [origins[i : i + 587].count("trace") / 587 for i in range(0, 5870, 587)]
    assert all(0.08 < share < 0.22 for share in tenths)


def test_mix_of_copied_problems_is_exact(spark):
    """A third of all problems are one row, another third has no id."""
    number = F.col("id").substr(2, 9).cast("int") % 3
    table = problems(spark, 3000)
    table = table.select(
        F.when(number == 0, "hot").when(number == 1, F.col("id")).alias("id"),
        F.when(number == 0, "same").otherwise(F.col("prompt")).alias("prompt"),
        F.when(number == 0, "7").otherwise(F.col("answer")).alias("answer"),
    )
    for count in (150, 1700, 2900):
        mix = mixed_recipe(table, traces(spark, 30), count)
        report = mix.report().first()
        assert (report["pool_rows"], report["direct_rows"]) == (2990, count)
        found = Counter(row["text"] for row in mix.ordered.collect())
        assert found == Counter(row["text"] for row in mix.rows.collect())
        assert max(found.values()) <= 1000


def test_rejected_traces_stay_in_the_pool(spark):
    wrong = traces(spark, 10).withColumn("reasoning", F.lit("so \\boxed{wrong}"))
    mix = mixed_recipe(problems(spark, 30), wrong, 100)
    report = mix.report().first()
    assert (report["pool_rows"], report["trace_rows"]) == (30, 0)
    with pytest.raises(MixError, match="clean_traces_exist"):
        mix.require()


def test_two_boxes_and_think_tags_are_reported(spark):
    good = traces(spark, 10)
    double = F.concat(F.lit("a \\boxed{x} <think> "), F.col("reasoning"))
    bad = good.withColumn(
        "reasoning", F.when(F.col("id") == "p1", double).otherwise(F.col("reasoning"))
    )
    mix = mixed_recipe(problems(spark, 30), bad, 10, copies=3)
    failed = {row["check"]: row["violations"] for row in mix.checks().collect() if not row["passed"]}
    assert failed == {"trace_one_box": 3, "trace_no_think": 3}
    with pytest.raises(MixError, match="trace_one_box"):
        mix.require()


def test_missing_answers_fail_the_checks(texts, spark):
    blank = texts("id prompt answer", [("n", "ask", None)])
    mix = mixed_recipe(problems(spark, 30).unionByName(blank), traces(spark, 3), 100)
    failed = {row["check"] for row in mix.checks().collect() if not row["passed"]}
    assert failed == {"direct_one_box"}


def test_baseline_recipe(spark):
    found = baseline_recipe(problems(spark, 700), keep=("id",))
    assert found.count() == 600
    row = found.first()
    assert row["text"].endswith(f"\\boxed{{{row['id'][1:]}\\ km}}<|im_end|>")
    with pytest.raises(ValueError, match="cannot sample"):
        baseline_recipe(problems(spark, 599))


def test_trace_recipe_does_not_clean(texts):
    rows = [("1", "p", "7", "so \\boxed{8}. "), ("2", "p", "7", None)]
    found = trace_recipe(texts("id prompt answer reasoning", rows), keep=("id",)).collect()
    replies = {row["id"]: row["text"].split("assistant\n")[1] for row in found}
    assert replies == {"1": "so \\boxed{8}.<|im_end|>", "2": "\\boxed{7}<|im_end|>"}


def test_training_text_needs_its_fields_but_no_reasoning(spark):
    table = problems(spark, 1)
    assert "\\boxed{0\\ km}" in training_text(table, reasoning="absent").first()["text"]
    with pytest.raises(Exception, match="absent"):
        training_text(table, prompt="absent")


CONFIG = {
    "seed": 7,
    "experiment_name": "x",
    "data": {
        "path": "somewhere.jsonl",
        "sample_size": 40,
        "val_ratio": 0.25,
        "prompt_field": "q",
        "answer_field": "a",
        "reasoning_field": "r",
        "instruction_suffix": "Go.",
    },
    "training": {"max_length": 1},
}


def test_recipe_from_config():
    recipe = Recipe.from_config(CONFIG)
    assert recipe == Recipe("somewhere.jsonl", 40, 0.25, "q", "a", "r", "Go.", 7)
    assert Recipe.from_config({"data": {"path": "x"}}) == Recipe("x")


@pytest.mark.parametrize(
    ("size", "override", "dry", "wanted"),
    [(None, None, False, None), (None, None, True, 8), (600, None, True, 600),
     (600, 5, False, 5), (None, 5, True, 5), (600, 0, False, 0)],
)
def test_sample_size(size, override, dry, wanted):
    assert Recipe("x", size).rows_wanted(override, dry) == wanted


def test_dataset_from_files(spark, tmp_path):
    path = tmp_path / "records.jsonl"
    lines = [json.dumps({"q": f"ask {i}", "a": i, "r": f"why {i}"}) for i in range(100)]
    path.write_text("\n".join(lines))
    recipe = Recipe.from_config({**CONFIG, "data": {**CONFIG["data"], "path": str(path)}})
    train, test = build_dataset(spark, recipe)
    assert train.columns == test.columns == ["text"]
    train_texts = {row["text"] for row in train.collect()}
    test_texts = {row["text"] for row in test.collect()}
    assert (len(train_texts), len(test_texts)) == (30, 10)
    assert not train_texts & test_texts
    some = next(iter(train_texts))
    assert "\nGo.<|im_end|>" in some and "Therefore, the answer is \\boxed{" in some


def test_dataset_without_split_or_sample(spark):
    train, test = format_dataset(problems(spark, 50), Recipe("unused"))
    assert test is None
    assert train.count() == 50
    assert format_dataset(problems(spark, 50), Recipe("unused"), dry_run=True)[0].count() == 8
