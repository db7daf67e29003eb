"""Preparing, verifying, mixing and scoring fine-tuning text with Spark."""

from tracemill.operators.checks import MixError, mix_checks, mix_report, require_checks
from tracemill.operators.cleaning import clean_report, clean_traces, judge_traces, rejected_traces
from tracemill.operators.combine import attach_completions, exclude_ids, oversample, union_texts
from tracemill.operators.conversations import conversation_segments, conversation_texts
from tracemill.operators.evaluation import Evaluation, evaluate, summarize_by
from tracemill.operators.requests import load_system_prompt, request_rows, write_request_files
from tracemill.operators.sampling import (
    head_limit,
    sample_exact,
    sample_strict,
    shuffle_rows,
    split_train_test,
)
from tracemill.operators.verification import Verified, verify
from tracemill.plans.recipes import (
    Mix,
    Recipe,
    baseline_recipe,
    build_dataset,
    format_dataset,
    mixed_recipe,
    trace_recipe,
    training_text,
)
from tracemill.sources.records import load_records, with_id

__all__ = [
    "Evaluation",
    "Mix",
    "MixError",
    "Recipe",
    "Verified",
    "attach_completions",
    "baseline_recipe",
    "build_dataset",
    "clean_report",
    "clean_traces",
    "conversation_segments",
    "conversation_texts",
    "evaluate",
    "exclude_ids",
    "format_dataset",
    "head_limit",
    "judge_traces",
    "load_records",
    "load_system_prompt",
    "mix_checks",
    "mix_report",
    "mixed_recipe",
    "oversample",
    "rejected_traces",
    "request_rows",
    "require_checks",
    "sample_exact",
    "sample_strict",
    "shuffle_rows",
    "split_train_test",
    "summarize_by",
    "trace_recipe",
    "training_text",
    "union_texts",
    "verify",
    "with_id",
    "write_request_files",
]
