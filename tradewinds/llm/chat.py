r"""Conversations as one training text each, in Spark expressions only.

A conversation's turn structs are collected and sorted; adjacent turns of one role share one
block. The text of a conversation is, for every block,

    ### role: text<next/>text</turn>\n

with `<next/>` between the turns that the block merges, so all turns can be read back.
Control strings inside texts and roles are escaped: `\` as `\\`, then `###` as `\h`,
`</turn>` as `\t`, `<next/>` as `\n`, and `: ` in a role as `\c`. No escape contains a control
string, and every backslash run pairs up from its left, so `unescaped` inverts it exactly.

`loss` holds the half-open spans (code points, from 0) of the assistant's texts, as escaped.

Defined cases: null role or text counts as empty, null conv_id is a conversation of its own;
turns are ordered by turn (null first), then role, then text, so ties and repeated rows have
one order and all stay; other columns are ignored; an empty table gives an empty result. One
conversation is one row, so its size is bounded by what a row can hold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ASSISTANT = "assistant"
HEAD, COLON, NEXT, END = "### ", ": ", "<next/>", "</turn>\n"
_ESCAPES = [("###", "\\h"), ("</turn>", "\\t"), ("<next/>", "\\n")]
_ROLE_ESCAPES = [*_ESCAPES, (": ", "\\c")]


def escaped(text: Column, escapes=_ESCAPES) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for raw, code in escapes:
        text = F.replace(text, F.lit(raw), F.lit(code))
    return text


def unescaped(text: Column, escapes=_ESCAPES) -> Column:
    def piece(part: Column) -> Column:
        for raw, code in escapes:
            part = F.replace(part, F.lit(code), F.lit(raw))
        return part

    return F.array_join(F.transform(F.split(text, r"\\\\"), piece), "\\")


def format_conversations(turns: DataFrame) -> DataFrame:
    """conv_id, formatted, loss (array of start, end) for rows conv_id, turn, role, text."""
    collected = (
        turns.groupBy("conv_id")
        .agg(F.array_sort(F.collect_list(F.struct(
            "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
        ))).alias("turns"))
    )

    def part(turn: Column, i: Column) -> Column:
        before = F.when(i > 0, F.get(F.col("turns"), i - 1)["role"])
        head = F.concat(F.lit(HEAD), escaped(turn["role"], _ROLE_ESCAPES), F.lit(COLON))
        lead = (
            F.when(i == 0, head).when(before == turn["role"], F.lit(NEXT)).otherwise(F.concat(F.lit(END), head))
        )
        return F.struct(lead.alias("lead"), escaped(turn["text"]).alias("body"), (turn["role"] == ASSISTANT).alias("own"))

    parts = collected.select("conv_id", F.transform("turns", part).alias("parts"))

    def step(done: Column, p: Column) -> Column:
        start = done["at"] + F.length(p["lead"])
        end = start + F.length(p["body"])
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct(
            end.alias("at"), F.when(p["own"], F.concat(done["spans"], span)).otherwise(done["spans"]).alias("spans")
        )

    none = F.struct(F.lit(0).alias("at"), F.expr("CAST(array() AS array<struct<start: int, end: int>>)").alias("spans"))
    return parts.select(
        "conv_id",
        F.concat(F.array_join(F.transform("parts", lambda p: F.concat(p["lead"], p["body"])), ""), F.lit(END)).alias("formatted"),
        F.aggregate("parts", none, step)["spans"].alias("loss"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, formatted, turns (array of role, text) and loss_text, from the text and its spans alone."""
    blocks = F.split(F.substring("formatted", F.lit(1), F.length("formatted") - len(END)), END)

    def turns_of(block: Column) -> Column:
        role = F.substring_index(block, COLON, 1)
        body = F.substring(block, F.length(role) + len(COLON) + 1, F.length(block))
        name = unescaped(F.substring(role, F.lit(len(HEAD) + 1), F.length(role)), _ROLE_ESCAPES)
        return F.transform(F.split(body, NEXT), lambda t: F.struct(name.alias("role"), unescaped(t).alias("text")))

    spans = F.transform("loss", lambda s: unescaped(F.substring(F.col("formatted"), s["start"] + 1, s["end"] - s["start"])))
    return formatted.select(
        "conv_id", "formatted", F.flatten(F.transform(blocks, turns_of)).alias("turns"), F.array_join(spans, "").alias("loss_text")
    )


def digest(formatted: DataFrame) -> DataFrame:
    """Counts and digests of what `read_back` finds."""
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read_back(formatted).select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(lines, 256).alias("turns_sha256"),
        F.length("loss_text").cast("bigint").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


def control_conversation(spark: SparkSession) -> DataFrame:
    """Conversation -7: two turns that say the template's own control strings."""
    return spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise(ASSISTANT).alias("role"),
        F.lit("\\### Assistant: </turn> ok").alias("text"),
    )
