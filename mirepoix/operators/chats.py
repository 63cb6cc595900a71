"""Conversations to text.

The base form is one row per message, so no conversation is ever brought together:
its first and last turn are a minimum and a maximum, which combine on the map side.
The whole text of a conversation is one value; it is built from those rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mirepoix import lookups


def _chat_line(role: Column, text: Column) -> Column:
    return F.concat(
        F.lit(lookups.CHAT_START), role, F.lit("\n"), text, F.lit(lookups.CHAT_END + "\n")
    )


def _flat_line(role: Column, text: Column) -> Column:
    return F.concat(role, F.lit(": "), text, F.lit("\n"))


def _lines(messages: DataFrame, line: Column, opening: Column, closing: Column) -> DataFrame:
    """``(conv_id, turn, text)``: each message's line, the first with ``opening`` before it, the last with ``closing`` after it.

    ``opening`` may use the column ``role``. Of messages with one turn the order is by
    role and line; equal messages are told apart by their number, so that only one is
    first and one is last.
    """
    rows = messages.select("conv_id", "turn", "role", line.alias("line"))
    counted = rows.groupBy("conv_id", "turn", "role", "line").agg(F.count(F.lit(1)).alias("copies"))
    place = F.struct("turn", "role", "line")
    ends = counted.groupBy("conv_id").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    placed = counted.join(ends, "conv_id").select(
        "conv_id", "turn", "role", "line", "copies", (place == F.col("first")).alias("is_first"), (place == F.col("last")).alias("is_last"),
        F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"),
    )
    before = F.when(F.col("is_first") & (F.col("copy") == 1), opening).otherwise("")
    after = F.when(F.col("is_last") & (F.col("copy") == F.col("copies")), closing).otherwise("")
    return placed.select("conv_id", "turn", "role", "line", F.concat(before, "line", after).alias("text"))


def _whole(lines: DataFrame) -> DataFrame:
    """One row per conversation: its lines in turn order, as one value."""
    ordered = F.sort_array(F.collect_list(F.struct("turn", "role", "line", F.length("text").alias("size"), "text")))
    return lines.groupBy("conv_id").agg(
        F.array_join(F.transform(ordered, lambda m: m.getField("text")), "").alias("text")
    )


def _chat(messages: DataFrame, generation_prompt: bool, default_system: str) -> DataFrame:
    opening = F.when(
        F.col("role") != "system", _chat_line(F.lit("system"), F.lit(default_system))
    ).otherwise("")
    closing = F.lit(lookups.CHAT_START + "assistant\n" if generation_prompt else "")
    return _lines(messages, _chat_line(F.col("role"), F.col("text")), opening, closing)


def render_chat_messages(
    messages: DataFrame,
    generation_prompt: bool = False,
    default_system: str = lookups.DEFAULT_SYSTEM_MESSAGE,
) -> DataFrame:
    """Messages in chat-template form, ``(conv_id, turn, text)``; in turn order they are the whole text.

    The first message of a conversation that does not open with a system message
    carries the default one, the last message the generation prompt.
    """
    return _chat(messages, generation_prompt, default_system).select("conv_id", "turn", "text")


def render_chat(
    messages: DataFrame,
    generation_prompt: bool = False,
    default_system: str = lookups.DEFAULT_SYSTEM_MESSAGE,
) -> DataFrame:
    """Conversations in chat-template form: ``(conv_id, text)``, one row each."""
    return _whole(_chat(messages, generation_prompt, default_system))


def render_flat_chat(messages: DataFrame) -> DataFrame:
    """Conversations as ``role: text`` lines with ``assistant:`` at the end, one row each."""
    line = _flat_line(F.col("role"), F.col("text"))
    return _whole(_lines(messages, line, F.lit(""), F.lit("assistant:")))
