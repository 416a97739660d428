"""Chat formatting with DataFrame expressions only: collected turns, merged neighbours, reversible escapes, a loss mask.

A conversation becomes one string. A block holds neighbouring turns of one role, `<|turn|>role<|text|>first<|next|>second
<|end|>`, without the line break shown here. Texts and roles that contain a mark get a backslash after its first
character, and one more for each that is already there, so taking one away restores them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN, TEXT, NEXT, END = "<|turn|>", "<|text|>", "<|next|>", "<|end|>"
LOSS_ROLE = "assistant"

# Strings that must not reach a model as they stand, our own marks and those of common templates.
CONTROL = r"([<\[])(\\*)(\|(?:turn|text|next|end|im_start|im_end|endoftext)\|>|/?s>|/?INST\]|<SYS>>|</SYS>>)"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"$1\\$2$3")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL.replace(r"(\\*)", r"\\(\\*)"), "$1$2$3")


def formatted(conversations: DataFrame, loss_role: str = LOSS_ROLE) -> DataFrame:
    """conv_id, text, mask for each conversation of (conv_id, turn, role, text).

    Turns are sorted by turn, then role and text; rows alike stay, so repeated rows are repeated turns. Null roles and
    texts are empty. mask is an array of (n, loss): runs of n characters of `text`, in order, that count towards the
    loss or not. Other columns are ignored. No rows: no conversations.
    """
    empty = F.lit("")
    turns = conversations.select(
        "conv_id",
        F.struct(
            "turn",
            F.coalesce("role", empty).alias("role"),
            F.coalesce("text", empty).alias("text"),
        ).alias("t"),
    )
    grouped = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t"))
    same = "i > 0 AND t[i - 1].role = x.role"
    head = F.expr(
        f"transform(t, (x, i) -> CASE WHEN {same} THEN '{NEXT}' ELSE"
        f" concat(CASE WHEN i > 0 THEN '{END}' ELSE '' END, '{TURN}', x.role, '{TEXT}') END)"
    )
    # Roles and texts are escaped before anything is put between them.
    safe = F.transform(
        "t", lambda x: F.struct(x["role"].alias("plain"), escaped(x["role"]).alias("role"), escaped(x["text"]).alias("text"))
    )
    parts = grouped.select("conv_id", safe.alias("t")).select("conv_id", "t", head.alias("head"))
    runs = F.expr(
        f"flatten(transform(t, (x, i) -> array(struct(char_length(head[i]) AS n, false AS loss),"
        f" struct(char_length(x.text) AS n, x.plain = '{loss_role}' AS loss))))"
    )
    last = F.array(F.struct(F.lit(len(END)).alias("n"), F.lit(False).alias("loss")))
    joined = F.expr("array_join(transform(t, (x, i) -> concat(head[i], x.text)), '')")
    return parts.select("conv_id", F.concat(joined, F.lit(END)).alias("text"), F.concat(runs, last).alias("mask"))


def turns_of(text: Column) -> Column:
    """Array of (role, text), read back from a formatted conversation."""
    blocks = F.filter(F.split(text, r"<\|turn\|>"), lambda b: b != "")

    def block(b: Column) -> Column:
        role = unescaped(F.substring_index(b, TEXT, 1))
        body = F.regexp_replace(b, r"(?s)^.*?<\|text\|>", "")
        parts = F.split(F.regexp_replace(body, r"<\|end\|>$", ""), r"<\|next\|>", -1)
        return F.transform(parts, lambda p: F.struct(role.alias("role"), unescaped(p).alias("text"), p.alias("raw")))

    return F.flatten(F.transform(blocks, block))


def loss_text(turns: Column, mask: Column) -> Column:
    """The unescaped text under the mask, null if the mask does not fit the turns.

    Runs alternate between marks and texts, so run 2i + 1 belongs to turn i and must have its length.
    """
    return F.expr(
        "CASE WHEN size(mask) = 2 * size(turns) + 1"
        " AND forall(transform(turns, (x, i) -> char_length(x.raw) = mask[2 * i + 1].n), ok -> ok)"
        " AND NOT exists(filter(mask, (m, i) -> i % 2 = 0), m -> m.loss)"
        " THEN array_join(transform(filter(turns, (x, i) -> mask[2 * i + 1].loss), x -> x.text), '') END"
    )


def read_back(chats: DataFrame) -> DataFrame:
    """conv_id, turns (role, text), loss (the text under the mask), n_chars of each formatted conversation."""
    rows = chats.select("conv_id", "text", "mask", turns_of(F.col("text")).alias("turns"))
    return rows.select(
        "conv_id",
        F.transform("turns", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"))).alias("turns"),
        loss_text(F.col("turns"), F.col("mask")).alias("loss"),
        F.char_length("text").alias("n_chars"),
        (F.aggregate("mask", F.lit(0), lambda n, m: n + m["n"]) == F.char_length("text")).alias("mask_fits"),
    )
