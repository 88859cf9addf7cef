"""Chat logs as training texts: events are folded into messages, and these are rendered.
DataFrame functions only.

An event is (conv_id, seq, message, op, role, text). In order of ``seq`` a *delta* adds its text
to a message, an *edit* replaces the message's text so far, and a *regenerate* drops the message
and all later ones so far; what comes after builds them anew. ``message`` is the message's place
in its conversation.

    <s>[INST]role[/INST]text</s>\\n

is one turn. Inside role and text a backslash is written as \\e, ``<`` as \\l and ``[`` as \\b, so
no text can hold a mark and reading back gives the text as it was.

What a conversation is made of is rendered row by row before it is brought together; one output
row holds one conversation, so a conversation must fit a row, as its contract asks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The marks of a turn, and what stands for their first characters inside texts.
BEGIN, MIDDLE, END = "<s>[INST]", "[/INST]", "</s>\n"
ESCAPES = (("\\", "\\e"), ("<", "\\l"), ("[", "\\b"))
TRAINED_ROLE = "assistant"


def escape(text: Column) -> Column:
    for plain, written in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def unescape(text: Column) -> Column:
    for plain, written in reversed(ESCAPES):
        text = F.replace(text, F.lit(written), F.lit(plain))
    return text


def fold_events(events: DataFrame) -> DataFrame:
    """(conv_id, message, role, text): the messages that events leave, null texts as empty.

    Events of one ``seq`` are taken by role, then text. A message's role is its last event's. An
    unknown or null ``op`` counts as a delta. Other columns are not read.
    """
    later = Window.partitionBy("conv_id").orderBy(F.desc("seq")).rangeBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy("conv_id", "message").orderBy(F.desc("seq"), F.desc("role"), F.desc("text")).rowsBetween(Window.unboundedPreceding, -1)
    is_op = lambda op: F.coalesce(F.col("op") == op, F.lit(False))
    alive = (
        events.select("conv_id", F.col("seq").cast("long").alias("seq"), F.col("message").cast("long").alias("message"), "op", "role", F.coalesce("text", F.lit("")).alias("text"))
        .withColumn("dropped_from", F.min(F.when(is_op("regenerate"), F.col("message"))).over(later))
        .where("dropped_from IS NULL OR message < dropped_from")
        .withColumn("edited", F.max(is_op("edit")).over(after))
        .where("NOT coalesce(edited, false)")
        .where(~is_op("regenerate") | (F.col("text") != ""))
    )
    parts = F.array_sort(F.collect_list(F.struct("seq", "role", "text")))
    return alive.groupBy("conv_id", "message").agg(parts.alias("parts")).select(
        "conv_id", "message",
        F.element_at("parts", -1)["role"].alias("role"),
        F.array_join(F.col("parts.text"), "").alias("text"),
    )


def render(messages: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss): a conversation's text, and its loss mask.

    ``loss`` lists the trained spans as (turn, start, stop): code points from the beginning of
    the turn's text, so that a reader needs no second pass over what stands before it. A null
    role is written as an empty one.
    """
    head = F.concat(F.lit(BEGIN), escape(F.coalesce("role", F.lit(""))), F.lit(MIDDLE))
    body = escape(F.coalesce("text", F.lit("")))
    turns = messages.select(
        "conv_id", "message",
        F.coalesce(F.col("role") == TRAINED_ROLE, F.lit(False)).alias("trained"),
        F.length(head).alias("start"), (F.length(head) + F.length(body)).alias("stop"),
        F.concat(head, body, F.lit(END)).alias("turn"),
    )
    sorted_turns = F.array_sort(F.collect_list(F.struct("message", "turn", "trained", "start", "stop")))
    spans = F.transform("turns", lambda t, i: F.struct(i.alias("turn"), t["start"].alias("start"), t["stop"].alias("stop"), t["trained"].alias("trained")))
    loss = F.transform(F.filter(spans, lambda s: s["trained"]), lambda s: F.struct(s["turn"].alias("turn"), s["start"].alias("start"), s["stop"].alias("stop")))
    return turns.groupBy("conv_id").agg(sorted_turns.alias("turns")).select(
        "conv_id", F.array_join(F.col("turns.turn"), "").alias("formatted"), loss.alias("loss")
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, formatted, turns, trained_texts): what ``render`` was given, from its output alone.

    ``turns`` are (role, text); ``trained_texts`` are the texts under the loss mask, in order.
    """
    pieces = F.filter(F.split("formatted", F.lit(END)), lambda p: p != "")
    cut = F.transform(pieces, lambda p: F.split(F.substr(p, F.lit(len(BEGIN) + 1)), "\\[/INST\\]"))
    turns = F.transform(cut, lambda c: F.struct(unescape(c[0]).alias("role"), unescape(c[1]).alias("text")))
    inside = lambda s: F.substr(F.get(F.col("pieces"), s["turn"]), s["start"] + 1, s["stop"] - s["start"])
    return (
        formatted.withColumn("pieces", pieces)
        .select("conv_id", "formatted", turns.alias("turns"), F.transform("loss", lambda s: unescape(inside(s))).alias("trained_texts"))
    )
