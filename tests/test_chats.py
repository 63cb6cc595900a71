"""Conversations, short and very long, whole and by message."""

from pyspark.sql import functions as F

from mirepoix.operators import chats

LINE = "<|im_start|>{}\n{}<|im_end|>\n"


def messages(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "user", "hi"), (2, 1, "assistant", "yes"), (2, 0, "user", "no?")]
    rows += [(3, t, "user" if t % 2 == 0 else "assistant", f"m{t}") for t in range(997)]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)


def test_short_and_long_conversations(spark):
    rows = chats.render_chat(messages(spark), True, "default").collect()
    text = {r.conv_id: r.text for r in rows}
    assert len(rows) == 3
    opening, closing = LINE.format("system", "default"), "<|im_start|>assistant\n"
    assert text[1] == LINE.format("system", "be kind") + LINE.format("user", "hi") + closing
    assert text[2] == opening + LINE.format("user", "no?") + LINE.format("assistant", "yes") + closing
    assert text[3] == opening + "".join(
        LINE.format("user" if t % 2 == 0 else "assistant", f"m{t}") for t in range(997)) + closing


def test_messages_in_order_are_the_whole_text(spark):
    whole = {r.conv_id: r.text for r in chats.render_chat(messages(spark), True).collect()}
    joined = {}
    for r in sorted(chats.render_chat_messages(messages(spark), True).collect(), key=lambda r: (r.conv_id, r.turn)):
        joined[r.conv_id] = joined.get(r.conv_id, "") + r.text
    assert joined == whole


def test_many_copies_of_one_turn(spark):
    copies = spark.range(1000).select(
        F.lit(1).cast("long").alias("conv_id"), F.lit(0).cast("long").alias("turn"),
        F.lit("user").alias("role"), F.lit("x").alias("text"))
    rows = chats.render_flat_chat(copies).collect()
    assert [r.text for r in rows] == ["user: x\n" * 1000 + "assistant:"]
