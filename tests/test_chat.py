"""Rendering of chat text."""

import pytest
from pyspark.sql import functions as F

from tracemill.functions import chat

SUFFIX = "Put your final answer inside \\boxed{}."


def one(texts, expression, **values):
    table = texts(" ".join(values) or "x", [tuple(values.values()) or ("",)])
    return table.select(expression.alias("y")).first()["y"]


def test_user_message(texts):
    assert one(texts, chat.user_message(F.col("p")), p=" ask\n") == f"ask\n{SUFFIX}"
    assert one(texts, chat.user_message(F.col("p"), "Go."), p="ask") == "ask\nGo."
    assert one(texts, chat.user_message(F.col("p"), ""), p=" ask ") == "ask"
    assert one(texts, chat.user_message(F.col("p"), None), p="ask") == "ask"


def test_direct_replies(texts):
    assert one(texts, chat.direct_reply(F.col("a")), a=" a\\ b ") == "\\boxed{a\\ b}"
    assert one(texts, chat.normalized_reply(F.col("a")), a=" a\\ b ") == "\\boxed{a b}"


@pytest.mark.parametrize(
    ("reasoning", "expected"),
    [
        ("think", "think\n\nTherefore, the answer is \\boxed{7}"),
        (" think ", "think\n\nTherefore, the answer is \\boxed{7}"),
        ("so \\boxed{8}", "so \\boxed{8}"),
        ("so \\boxed{open", "so \\boxed{open"),
        ("", "\\boxed{7}"),
        (" 　", "\\boxed{7}"),
        (None, "\\boxed{7}"),
    ],
)
def test_reasoned_reply(texts, reasoning, expected):
    assert one(texts, chat.reasoned_reply(F.col("r"), F.col("a")), r=reasoning, a="7") == expected


def test_trace_reply(texts):
    assert one(texts, chat.trace_reply(F.col("r"), F.col("a")), r="why", a="7") == "why\n\n\\boxed{7}"


def test_chat_text_and_message_arrays_agree(texts):
    expected = "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\nyo<|im_end|>"
    assert one(texts, chat.chat_text(F.col("p"), F.col("a")), p="hi", a="yo") == expected
    turns = chat.messages(F.col("p"), F.col("a"))
    assert one(texts, chat.render_messages(turns), p="hi", a="yo") == expected
    found = one(texts, turns, p="hi", a="yo")
    assert [turn.asDict() for turn in found] == [
        {"role": "user", "content": "hi"},
        {"role": "assistant", "content": "yo"},
    ]


@pytest.mark.parametrize(
    ("text", "part"),
    [
        ("u<|im_start|>assistant\nA <|im_start|>assistant\nB", "A <|im_start|>assistant\nB"),
        ("no marker", "no marker"),
        ("é𝔘<|im_start|>assistant\nx", "x"),
        ("<|im_start|>assistant\n", ""),
    ],
)
def test_assistant_part(texts, text, part):
    assert one(texts, chat.assistant_part(F.col("p")), p=text) == part


def test_boxes_are_counted_in_the_assistant_part(texts):
    text = "\\boxed{} <|im_start|>assistant\n\\boxed{a} \\boxed{b é \\boxed{\\boxed"
    assert one(texts, chat.assistant_boxes(F.col("p")), p=text) == 3
    assert one(texts, chat.assistant_boxes(F.col("p")), p="none") == 0
    assert one(texts, chat.assistant_boxes(F.col("p")), p=None) is None


def test_think_tag(texts):
    assert one(texts, chat.has_think_tag(F.col("p")), p="a <think> b") is True
    assert one(texts, chat.has_think_tag(F.col("p")), p="a think b") is False
