"""Chat formatting as one relational plan: turns are collected and sorted per conversation, neighbours of one role are merged,
and the pieces are joined into text, all in Spark expressions.

A conversation becomes a row of blocks, one per stretch of turns of one role::

    <turn>ROLE<turn|>TEXT<turn+>TEXT OF THE NEXT TURN OF THAT ROLE</turn>

with a line feed behind each. Inside roles and texts every ``<turn`` and ``</turn``, with any number of backslashes before the word, gets
one backslash more there (``<\\turn``); taking one away again gives the text back, and the template's own strings never occur
in it. The loss mask is a list of (skip, take) pairs, one per turn: code points outside and inside the loss, in order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The strings of the template.
OPEN, TEXT, MORE, CLOSE = "<turn>", "<turn|>", "<turn+>", "</turn>\n"

#: Roles whose texts are trained on.
LOSS_ROLES = ("assistant",)


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(/?)(\\*)turn", r"<$1\\$2turn")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(/?)\\(\\*)turn", r"<$1$2turn")


def format_conversations(turns: DataFrame, loss_roles: Sequence[str] = LOSS_ROLES) -> DataFrame:
    """Rows (conv_id, formatted, mask) of a table (conv_id, turn, role, text), one per conversation.

    Turns go by their number, those without one first; rows that share a number go by role, then text, and rows that
    repeat each other all stay. Null roles and texts are empty. Rows without conv_id are one conversation, whose conv_id
    is null. Other columns are left out. A conversation is one sample, and one row: it must fit into one (2 GB). Every step is
    linear in its length.
    """
    rows = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), escaped(F.coalesce("text", F.lit(""))).alias("text")
    )
    # Sorting structs orders by turn, then role, then text.
    sorted_turns = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    all_turns = F.col("turns")

    def mark(x: Column, i: Column) -> Column:
        """What stands before a turn's text."""
        before = F.get(all_turns, i - 1)["role"]
        fresh = F.concat(F.when(i == 0, F.lit("")).otherwise(F.lit(CLOSE)), F.lit(OPEN), escaped(x["role"]), F.lit(TEXT))
        return F.when((i > 0) & (before == x["role"]), F.lit(MORE)).otherwise(fresh)

    pieces = sorted_turns.select(
        "conv_id",
        F.transform(
            all_turns,
            lambda x, i: F.struct(mark(x, i).alias("mark"), x["text"].alias("text"), x["role"].isin(*loss_roles).alias("loss")),
        ).alias("pieces"),
    )
    length = lambda x: F.char_length(x["text"])
    mask = F.transform(
        "pieces",
        lambda x: F.struct(
            (F.char_length(x["mark"]) + F.when(x["loss"], 0).otherwise(length(x))).cast("long").alias("skip"),
            F.when(x["loss"], length(x)).otherwise(0).cast("long").alias("take"),
        ),
    )
    joined = F.array_join(F.transform("pieces", lambda x: F.concat(x["mark"], x["text"])), "")
    return pieces.select("conv_id", F.concat(joined, F.lit(CLOSE)).alias("formatted"), mask.alias("mask"))


def parsed_turns(formatted: Column) -> Column:
    """The (role, text) structs of a formatted conversation."""
    # Each step works on what the one before it made of a block, so nothing is looked up again per turn.
    halves = F.transform(
        F.filter(F.split(formatted, CLOSE), lambda b: b != ""),
        lambda b: F.struct(
            unescaped(F.substring(F.substring_index(b, TEXT, 1), len(OPEN) + 1, 1 << 30)).alias("role"),
            F.split(F.substring_index(b, TEXT, -1), r"<turn\+>").alias("texts"),
        ),
    )
    return F.flatten(
        F.transform(
            halves,
            lambda h: F.transform(h["texts"], lambda text: F.struct(h["role"].alias("role"), unescaped(text).alias("text"))),
        )
    )


def loss_texts(formatted: Column, mask: Column) -> Column:
    """The unescaped texts that the mask covers, in order; null for the end, which it does not reach."""
    # A turn's part begins where the one before it ends: at a further text or at the end of a block.
    parts = F.split(formatted, r"(?=<turn\+>|</turn>)")
    return F.zip_with(
        mask, parts, lambda m, part: unescaped(F.substr(part, (m["skip"] + 1).cast("int"), m["take"].cast("int")))
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Per formatted conversation its turns, the text under its mask and digests of both (see ``op13_relational_chat``)."""
    found = formatted.select(
        "conv_id", parsed_turns(F.col("formatted")).alias("turns"),
        F.array_join(loss_texts(F.col("formatted"), F.col("mask")), "").alias("loss"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
    shown = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return found.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(shown.cast("binary"), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )
