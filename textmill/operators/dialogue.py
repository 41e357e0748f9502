"""Dialogue shaping over the long form: one row per (conversation, turn).

``turn`` is an integer, unique in its conversation. Lengths, and whether a conversation has a block at all, are decided on
its lines; a whole block is put together only where one is asked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textmill.functions.render import CONVERSATION_HEAD, conversation_text, turn_line
from textmill.functions.text import non_null


def conversation_lines(df: DataFrame, conv: str, turn: str, speaker: Column, text: Column) -> DataFrame:
    """Lines ``(conv, turn, line)`` of the turns whose text is not empty after cleaning."""
    rows = df.select(conv, turn, speaker.alias("_speaker"), text.alias("_text"))
    return non_null(rows, conv, turn, line=turn_line(F.col("_speaker"), F.col("_text")))


def conversation_sizes(lines: DataFrame, conv: str, turn: str) -> DataFrame:
    """``(conv, n_turns, weight, first, last)`` of conversations of two lines or more; ``weight`` counts the block's characters.

    Only these numbers are gathered, and they are combined before the shuffle.
    """
    chars = F.sum(F.length("line")) + F.count("*") + F.lit(len(CONVERSATION_HEAD) + 1)
    sizes = lines.groupBy(conv).agg(
        F.count("*").alias("n_turns"), chars.alias("weight"), F.min(turn).alias("first"), F.max(turn).alias("last")
    )
    return sizes.filter(F.col("n_turns") >= 2)


def conversation_parts(lines: DataFrame, sizes: DataFrame, conv: str, turn: str) -> DataFrame:
    """Lines as ``(conv, turn, part)``: the parts of a conversation in the order of ``turn`` make up its block.

    Lines stay rows, so a conversation of any length is written by many tasks; see ``sinks.write_lines``.
    """
    head = F.when(F.col(turn) == F.col("first"), F.lit(CONVERSATION_HEAD)).otherwise(F.lit(""))
    tail = F.when(F.col(turn) == F.col("last"), F.lit("\n\n")).otherwise(F.lit("\n"))
    joined = lines.join(sizes.select(conv, "first", "last"), conv)
    return joined.select(conv, turn, F.concat(head, "line", tail).alias("part"))


def conversation_blocks(df: DataFrame, conv: str, turn: str, speaker: Column, text: Column) -> DataFrame:
    """Whole blocks ``(conv, n_turns, weight, block)``, one row per conversation of two non-empty turns or more."""
    ordered = F.transform(F.sort_array(F.collect_list(F.struct(turn, "line"))), lambda x: x["line"])
    gathered = conversation_lines(df, conv, turn, speaker, text).groupBy(conv).agg(ordered.alias("_lines"))
    blocks = gathered.filter(F.size("_lines") >= 2).select(
        conv, F.size("_lines").cast("bigint").alias("n_turns"), conversation_text(F.col("_lines")).alias("block")
    )
    return blocks.select(conv, "n_turns", F.length("block").cast("bigint").alias("weight"), "block")


def turn_pairs(df: DataFrame, conv: str, turn: str, text: str) -> DataFrame:
    """Overlapping pairs of adjacent turns ``(conv, turn, question, answer)``, both non-empty."""
    following = F.lead(text).over(W.partitionBy(conv).orderBy(turn))
    pairs = df.select(conv, turn, F.col(text).alias("question"), following.alias("answer"))
    return pairs.filter((F.col("question") != "") & (F.col("answer") != ""))


def alternate(texts: Column) -> Column:
    """``array<string>`` to turns: even positions are the User, odd ones the Assistant."""
    return F.transform(
        texts,
        lambda x, i: F.struct(
            F.when(i % 2 == 0, "User").otherwise(F.lit("Assistant")).alias("speaker"), x.alias("text")
        ),
    )


def turn_of(speaker: str, text: Column) -> Column:
    return F.struct(F.lit(speaker).alias("speaker"), text.cast("string").alias("text"))


def with_reply(history: Column, reply: Column) -> Column:
    """History turns and a final reply by the Assistant, left out when missing."""
    return F.concat(
        alternate(history),
        F.filter(F.array(turn_of("Assistant", reply)), lambda t: t["text"].isNotNull() & (t["text"] != "")),
    )


def messages_to_turns(messages: Column) -> Column:
    """``array<struct<role, content>>`` to turns; other roles and empty contents are dropped."""
    kept = F.filter(
        messages,
        lambda m: m["role"].isin("user", "assistant") & m["content"].isNotNull() & (m["content"] != ""),
    )
    return F.transform(
        kept,
        lambda m: F.struct(
            F.when(m["role"] == "user", "User").otherwise(F.lit("Assistant")).alias("speaker"),
            m["content"].alias("text"),
        ),
    )


def adjacent_pairs(texts: Column) -> Column:
    """``array<string>`` to ``array<struct<question, answer>>`` of neighbours, both non-empty."""
    n = F.greatest(F.size(texts) - 1, F.lit(0))
    both = F.zip_with(
        F.slice(texts, F.lit(1), n),
        F.slice(texts, F.lit(2), n),
        lambda q, a: F.struct(q.alias("question"), a.alias("answer")),
    )
    return F.filter(both, lambda p: (p["question"] != "") & (p["answer"] != ""))
