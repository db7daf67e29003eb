"""Whole conversations from a table of turns.

A conversation becomes one row of messages in their order, or several where it is long:
segments that follow each other. Where one ends depends on the lengths of the rendered turns
before it only, never on how the table is dealt out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracemill.functions.chat import chat_turn, render_messages
from tracemill.functions.text import strip_long
from tracemill.operators.running import running_start
from tracemill.sources.staging import stage

SEGMENT_CHARS = 1_000_000


def conversation_segments(
    turns: DataFrame,
    max_chars: int = SEGMENT_CHARS,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """``conversation, segment, turns, messages``: messages in the order of their turns.

    A turn belongs to the segment ``n`` if the rendered turns before it have from ``n *
    max_chars`` to ``(n + 1) * max_chars`` characters, so a segment is at most one turn
    longer than that. A number without turns is left out. Contents are stripped; a turn
    without role or text has null there and is rendered as nothing. Null turns come first,
    equal ones are ordered by role and by a hash of the content. Rows without an id are a
    conversation too.

    Only turns of conversations beyond one segment are numbered, without their contents.
    Contents are shuffled once, by conversation and segment.
    """
    if max_chars < 1:
        raise ValueError(f"a segment needs room: {max_chars}")
    content = strip_long(F.col(text))
    named = turns.select(
        F.col(conversation).alias("conv"),
        F.col(turn).alias("turn"),
        F.col(role).alias("role"),
        content.alias("content"),
    )
    named = named.select(
        "*",
        F.md5("content").alias("digest"),
        F.coalesce(F.length(chat_turn(F.col("role"), F.col("content"))), F.lit(0)).cast("long").alias("chars"),
        F.monotonically_increasing_id().alias("row"),
    )
    # Stored, so that a row keeps its number in all that follows.
    named = stage(named, "turns")
    light = named.select("conv", "turn", "role", "digest", "row", "chars")
    totals = light.groupBy("conv").agg(F.sum("chars").alias("total"))
    long = totals.filter(F.col("total") > max_chars).select(F.col("conv").alias("long"))
    long_rows = light.join(long, F.col("conv").eqNullSafe(F.col("long")), "left_semi")
    started = running_start(long_rows, ["conv"], ["turn", "role", "digest", "row"], "chars")
    number = F.floor(F.col("start") / F.lit(max_chars)).cast("long")
    later = started.select("row", number.alias("segment")).filter("segment > 0")
    cut = named.join(later, "row", "left").withColumn("segment", F.coalesce("segment", F.lit(0)))
    # Null turns sort first in an array of structs as well.
    entry = F.struct("turn", "role", "digest", "row", "content")
    gathered = cut.groupBy("conv", "segment").agg(F.array_sort(F.collect_list(entry)).alias("turns"))
    messages = F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content")))
    return gathered.select(
        F.col("conv").alias(conversation), "segment", F.size("turns").alias("turns"), messages.alias("messages")
    )


def conversation_texts(turns: DataFrame, max_chars: int = SEGMENT_CHARS, **columns: str) -> DataFrame:
    """``conversation, segment, turns, text``: the segments as ChatML.

    The texts of a conversation's segments, joined by newlines, are its whole text.
    """
    segments = conversation_segments(turns, max_chars, **columns)
    return segments.withColumn("text", render_messages(F.col("messages"))).drop("messages")
