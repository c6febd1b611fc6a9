"""Chat formatting with Spark expressions only.

A conversation's turn structs are collected and sorted, adjacent turns of one
role become one block, and blocks are concatenated:

    <|im_start|>role \\n text [<|im_part|> text ...] <|im_end|> \\n

Reversible escape: ``<|`` inside a role or text becomes ``<||``, so no text can
hold a control string (each is ``<|`` and a letter); a line break in a role
becomes ``<|im_nl|>``.  The turns of a block stay apart by ``<|im_part|>``,
which like every control string is outside the loss mask.

Defined cases: a null role or text is empty; a null turn sorts first; equal
turn numbers are ordered by role, then text; repeated rows are turns of their
own; rows with a null conv_id form one conversation with a null id; an empty
table gives no rows.  Other input columns are ignored.  One conversation is
one output row, so its size is bounded by what a Spark row may hold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cumulus.llm.common import let

# fixed values: the template's control strings
START, END, PART, BREAK = "<|im_start|>", "<|im_end|>", "<|im_part|>", "<|im_nl|>"
LOSS_ROLE = "assistant"


def escape(c: Column) -> Column:
    return F.replace(c, F.lit("<|"), F.lit("<||"))


def unescape(c: Column) -> Column:
    return F.replace(c, F.lit("<||"), F.lit("<|"))


def _segment(text: Column, loss: Column) -> Column:
    return F.struct(text.alias("text"), loss.alias("loss"))


def _block(turns: Column, first: Column, until: Column) -> Column:
    """Segments of the turns ``first`` (from 1) up to but without ``until``."""
    role = F.element_at(turns, first)["role"]
    loss = role == LOSS_ROLE
    plain = F.lit(False)
    head = _segment(F.concat(F.lit(START), F.replace(escape(role), F.lit("\n"), F.lit(BREAK)), F.lit("\n")), plain)
    parts = F.transform(F.slice(turns, first, until - first), lambda t, i: F.when(
        i == 0, F.array(_segment(escape(t["text"]), loss))).otherwise(
        F.array(_segment(F.lit(PART), plain), _segment(escape(t["text"]), loss))))
    return F.concat(F.array(head), F.flatten(parts), F.array(_segment(F.lit(END + "\n"), plain)))


def format_conversations(turns: DataFrame, conv_id="conv_id", turn="turn", role="role", text="text") -> DataFrame:
    """One row per conversation: conv_id, n_blocks, segments (array of text, loss), formatted.

    ``formatted`` is the segments' texts joined; ``loss`` marks those the model is trained on.
    """
    grouped = (
        turns.select(F.col(conv_id).alias("conv_id"),
                     F.struct(F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"),
                              F.coalesce(F.col(text), F.lit("")).alias("text")).alias("t"))
        .groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns")))

    def starts(ts):
        return F.filter(F.sequence(F.lit(1), F.size(ts)), lambda i: (i == 1) | (
            F.element_at(ts, i)["role"] != F.get(ts, i - 2)["role"]))

    blocks = let(F.col("turns"), lambda ts: let(starts(ts), lambda ss: F.transform(
        ss, lambda s, i: _block(ts, s, F.coalesce(F.get(ss, i + 1), F.size(ts) + 1)))))
    return (
        grouped.select("conv_id", blocks.alias("blocks"))
        .select("conv_id", F.size("blocks").cast("long").alias("n_blocks"), F.flatten("blocks").alias("segments"))
        .select("conv_id", "n_blocks", "segments",
                F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted")))


def read_back(formatted: Column) -> Column:
    """The turns (array of role, text) parsed from a formatted conversation."""

    def of_block(b):
        head = F.substring_index(b, "\n", 1)
        role = unescape(F.replace(head, F.lit(BREAK), F.lit("\n")))
        body = F.substr(b, F.char_length(head) + 2, F.char_length(b) - F.char_length(head) - 2 - len(END))
        return let(role, lambda r: F.transform(
            F.split(body, PART.replace("|", "\\|")),
            lambda p: F.struct(r.alias("role"), unescape(p).alias("text"))))

    pieces = F.split(formatted, START.replace("|", "\\|"))
    return F.flatten(F.transform(F.filter(pieces, lambda b: b != ""), of_block))


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
