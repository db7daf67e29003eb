"""Chat messages and ChatML training text as Spark columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tracemill.functions.answers import BOX_OPEN, has_box, normalize
from tracemill.functions.text import strip, strip_long

# The default instruction, the sentence that introduces an answer,
# and the ChatML turn markers.
INSTRUCTION_SUFFIX = r"Put your final answer inside \boxed{}."
ANSWER_SENTENCE = "Therefore, the answer is "
TURN_START = "<|im_start|>"
TURN_END = "<|im_end|>"
ASSISTANT_START = "<|im_start|>assistant\n"
THINK_TAG = "<think>"


def boxed(answer: Column) -> Column:
    return F.concat(F.lit(BOX_OPEN), answer, F.lit("}"))


def user_message(prompt: Column, suffix: str | None = INSTRUCTION_SUFFIX) -> Column:
    """The stripped prompt, with the instruction on a line of its own if any."""
    asked = strip_long(prompt)
    return F.concat(asked, F.lit("\n" + suffix)) if suffix else asked


def direct_reply(answer: Column) -> Column:
    """Only the boxed answer, as given but stripped."""
    return boxed(strip(answer))


def normalized_reply(answer: Column) -> Column:
    """Only the boxed answer, with LaTeX blanks resolved."""
    return boxed(normalize(answer, "latex_space"))


def reasoned_reply(reasoning: Column, answer: Column) -> Column:
    """The reasoning, closed by an answer sentence unless it has a box.

    Falls back to the direct reply where there is no reasoning.
    """
    body = strip_long(reasoning)
    closed = F.when(has_box(body), body).otherwise(
        F.concat(body, F.lit("\n\n" + ANSWER_SENTENCE), direct_reply(answer))
    )
    return F.when(F.coalesce(body, F.lit("")) == "", direct_reply(answer)).otherwise(closed)


def trace_reply(reasoning: Column, answer: Column) -> Column:
    """Cleaned reasoning, a blank line, and the one boxed answer."""
    return F.concat(reasoning, F.lit("\n\n"), boxed(answer))


def chat_turn(role: Column, content: Column) -> Column:
    return F.concat(F.lit(TURN_START), role, F.lit("\n"), content, F.lit(TURN_END))


def chat_text(user: Column, assistant: Column) -> Column:
    """One user turn and one assistant turn, without a newline at the end."""
    return F.concat(
        chat_turn(F.lit("user"), user), F.lit("\n"), chat_turn(F.lit("assistant"), assistant)
    )


def message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def messages(user: Column, assistant: Column) -> Column:
    """The two turns as an array of ``{role, content}``."""
    return F.array(message("user", user), message("assistant", assistant))


def render_messages(turns: Column) -> Column:
    """ChatML text of an array of ``{role, content}`` of any length."""
    return F.array_join(F.transform(turns, lambda m: chat_turn(m["role"], m["content"])), "\n")


def assistant_part(text: Column) -> Column:
    """What follows the first assistant marker; the whole text without one."""
    # instr gives 0 when the marker is missing
    at = F.instr(text, ASSISTANT_START)
    return F.when(at > 0, F.substr(text, at + F.lit(len(ASSISTANT_START)))).otherwise(text)


def assistant_boxes(text: Column) -> Column:
    """How many box markers the assistant part holds."""
    part = assistant_part(text)
    without = F.replace(part, F.lit(BOX_OPEN), F.lit(""))
    return F.floor((F.length(part) - F.length(without)) / F.lit(len(BOX_OPEN))).cast("int")


def has_think_tag(text: Column) -> Column:
    return text.contains(F.lit(THINK_TAG))
