"""Conversations as marked-up text, in DataFrame functions only: what is written is parsed again and escaped until it comes back as it was."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkrank.functions import with_once

#: A turn is START, the role, a line feed, the text, END and a line feed.
START, END = "<|im_start|>", "<|im_end|>"
LEARNED = "assistant"


def escape(text: Column) -> Column:
    """A backslash more in each ``<|``, ``<\\|``, ``<\\\\|`` and so on; none of them is left as it was."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def escape_role(role: Column) -> Column:
    """Backslash, line feed and ``<`` as two characters each."""
    return F.replace(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")), F.lit("<"), F.lit("\\l"))


def unescape_role(role: Column) -> Column:
    """Between doubled backslashes no other one can be part of an escaped backslash."""
    pieces = F.transform(F.split(role, r"\\\\", -1), lambda x: F.replace(F.replace(x, F.lit("\\n"), F.lit("\n")), F.lit("\\l"), F.lit("<")))
    return F.array_join(pieces, "\\")


def render(role: Column, text: Column) -> Column:
    return F.concat(F.lit(START), role, F.lit("\n"), text, F.lit(f"{END}\n"))


def parse(formatted: Column) -> Column:
    """The turns ``(role, text)`` of a formatted text, by one rule for each part: a turn goes from START to the next START, its role
    to the first line feed, its text from there to the first END. Escapes are undone."""
    pieces = F.split(formatted, r"<\|im_start\|>", -1)

    def turn(piece: Column) -> Column:
        role = F.substring_index(piece, "\n", 1)
        text = F.substring_index(F.substring(piece, F.length(role) + 2, F.length(piece)), END, 1)
        return F.struct(unescape_role(role).alias("role"), unescape(text).alias("text"))

    return F.transform(F.slice(pieces, F.lit(2), F.size(pieces) - 1), turn)


def written(role: Column, text: Column) -> Column:
    """Role and text as they are to be written: as they are where that reads back, else the text, the role, or both escaped."""
    turn = F.array(F.struct(role.alias("role"), text.alias("text")))
    choice = F
    for r, t in ((role, text), (role, escape(text)), (escape_role(role), text), (escape_role(role), escape(text))):
        choice = choice.when(parse(render(r, t)) == turn, F.struct(r.alias("role"), t.alias("text")))
    return choice.otherwise(F.raise_error(F.lit("a turn does not read back")))


def format_chats(conversations: DataFrame, learned: str = LEARNED) -> DataFrame:
    """``(conv_id, formatted, mask)`` for each conversation of ``conversations (conv_id, turn, role, text)``.

    Each turn is rendered, parsed again and held against its source; content that conflicts with the grammar is escaped, so
    every turn reads back identical (a job fails rather than writing one that doesn't). mask cuts formatted into stretches ``(chars, loss)``
    in code points; those of texts by ``learned`` have loss.

    Turns come by number, those without one last, equal ones by what is written. A null role or text is an empty one, a null conv_id a
    conversation of its own, repeated rows are turns of their own, and further columns are not looked at. Escaping is done
    row by row before the one exchange, by conversation. A conversation is one row of the result and so must fit into one, at most 2 GB.
    """
    empty = F.lit("")
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), empty).alias("role"), F.coalesce(F.col("text").cast("string"), empty).alias("text"))
    rows = with_once(rows, "written", written(F.col("role"), F.col("text")))
    line = F.struct(
        F.isnull("turn").alias("unnumbered"), "turn", render(F.col("written.role"), F.col("written.text")).alias("line"),
        F.length("written.text").alias("chars"), (F.col("role") == learned).alias("loss"),
    )
    lines = rows.select("conv_id", line.alias("line")).groupBy("conv_id").agg(F.array_sort(F.collect_list("line")).alias("lines"))
    tail = F.lit(len(END) + 1)

    def cut(x: Column) -> Column:
        stretches = ((F.length(x["line"]) - x["chars"] - tail, F.lit(False)), (x["chars"], x["loss"]), (tail, F.lit(False)))
        return F.array(*(F.struct(n.cast("long").alias("chars"), loss.alias("loss")) for n, loss in stretches))

    return lines.select("conv_id", F.array_join(F.transform("lines", lambda x: x["line"]), "").alias("formatted"), F.flatten(F.transform("lines", cut)).alias("mask"))


def read_chats(formatted: DataFrame, learned: str = LEARNED) -> DataFrame:
    """``(conv_id, formatted, turns, loss)`` read back from ``(conv_id, formatted)``: turns as ``(role, text)``, loss as the texts by ``learned``."""
    rows = with_once(formatted.select("conv_id", "formatted"), "once", F.col("formatted")).select("conv_id", F.col("once").alias("formatted"))
    rows = with_once(rows, "turns", parse(F.col("formatted")))
    return rows.withColumn("loss", F.transform(F.filter("turns", lambda x: x["role"] == learned), lambda x: x["text"]))
