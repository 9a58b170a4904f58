"""Chat formatting: turns of a conversation to one marked training text and back, in Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The template's marks. All begin with "<|", which no escaped text contains.
TURN, TEXT, NEXT, END = "<|turn|>", "<|text|>", "<|next|>", "<|end|>"

# An opening "<" or "[" of a control string: this template's, and those of common chat templates.
_CONTROL = r"([<\[])(?=\||/?s>|/?INST\]|</?SYS>>|/SYS>>)"

LOSS_ROLE = "assistant"


def escaped(text: Column) -> Column:
    """Backslashes doubled, then one put inside every control string, which breaks it."""
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), _CONTROL, r"$1\\")


def unescaped(text: Column) -> Column:
    """Inverse of ``escaped``: each backslash goes, the character after it stays."""
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _blocks(turns: Column) -> Column:
    """Runs of one role in the sorted turns: an array of (role, texts)."""
    places = F.sequence(F.lit(0), F.size(turns) - 1)
    starts = F.filter(
        places, lambda i: (i == 0) | (F.get(turns, i)["role"] != F.get(turns, i - 1)["role"])
    )
    return F.transform(
        F.arrays_zip(starts.alias("at"), F.slice(F.array_append(starts, F.size(turns)), 2, F.size(starts)).alias("to")),
        lambda run: F.struct(
            F.get(turns, run["at"])["role"].alias("role"),
            F.transform(F.slice(turns, run["at"] + 1, run["to"] - run["at"]), lambda t: t["text"]).alias("texts"),
        ),
    )


def _segments(blocks: Column, loss_role: str) -> Column:
    """The formatted text in pieces, each either under the loss mask or not."""

    def piece(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    no_loss = F.lit(False)
    return F.flatten(
        F.transform(
            blocks,
            lambda b: F.concat(
                F.array(piece(F.concat(F.lit(TURN), escaped(b["role"]), F.lit(TEXT)), no_loss)),
                F.flatten(
                    F.transform(
                        b["texts"],
                        lambda text, i: F.when(
                            i == 0, F.array(piece(escaped(text), b["role"] == loss_role))
                        ).otherwise(
                            F.array(piece(F.lit(NEXT), no_loss), piece(escaped(text), b["role"] == loss_role))
                        ),
                    )
                ),
                F.array(piece(F.lit(END), no_loss)),
            ),
        )
    )


def format_chats(
    turns: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    loss_role: str = LOSS_ROLE,
) -> DataFrame:
    """One row per conversation: conv_id, formatted (string), segments (array of text and loss flag).

    Turns are sorted by ``turn``, a missing one first, then by role and text; neighbours of one role share a block.
    The segments, joined, are the formatted text; those with the flag are what a
    model is trained to say. ``parse_chats`` gives the turns back, one for each row.

    A null role or text counts as empty. A null conversation id is a conversation of its own.
    A repeated row is a repeated turn. A conversation is one row of the result, so its
    turns meet in one task, as the text that they make has to.
    """
    rows = turns.select(
        F.col(conversation).alias("conv_id"),
        F.struct(
            F.col(turn).alias("turn"),
            F.coalesce(F.col(role), F.lit("")).alias("role"),
            F.coalesce(F.col(text), F.lit("")).alias("text"),
        ).alias("row"),
    )
    # The turns stand in a column of their own before anything refers to them twice.
    whole = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("row")).alias("turns"))
    segments = whole.select("conv_id", _segments(_blocks(F.col("turns")), loss_role).alias("segments"))
    return segments.select(
        "conv_id", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"), "segments"
    )


def parsed_turns(formatted: Column) -> Column:
    """The turns of a formatted text: an array of (role, text)."""
    cut = F.split(formatted, r"<\|turn\|>")  # nothing stands before the first mark
    blocks = F.slice(cut, 2, F.size(cut))
    return F.flatten(
        F.transform(
            blocks,
            lambda b: F.transform(
                F.split(F.regexp_replace(F.split(b, r"<\|text\|>")[1], r"<\|end\|>$", ""), r"<\|next\|>"),
                lambda text: F.struct(
                    unescaped(F.split(b, r"<\|text\|>")[0]).alias("role"), unescaped(text).alias("text")
                ),
            ),
        )
    )


def parse_chats(formatted: DataFrame) -> DataFrame:
    """``format_chats`` read back: conv_id, turns (array of role and text), loss_text."""
    return formatted.select(
        "conv_id",
        parsed_turns(F.col("formatted")).alias("turns"),
        F.array_join(
            F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescaped(s["text"])), ""
        ).alias("loss_text"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
