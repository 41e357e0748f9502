"""Token streams: positional split, packing into blocks, random windows.

Documents stand one after the other in the order of an integer key; their offsets come from
``running_total``, never from a global window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.functions.text import let
from textmill.functions.tokens import packed, packed_slice
from textmill.operators.prefix import hash_int, running_total, shuffle_key


def with_offsets(df: DataFrame, tokens: str, order: str) -> DataFrame:
    """Adds ``n_tokens`` and the document's first position ``start`` in the stream."""
    sized = df.withColumn("n_tokens", F.length(tokens).cast("bigint"))
    total = running_total(sized, F.col("n_tokens"), order, out="_end")
    return total.withColumn("start", F.col("_end") - F.col("n_tokens")).drop("_end")


def total_tokens(df: DataFrame, tokens: str) -> Column:
    """Length of the stream as a scalar subquery."""
    return df.agg(F.coalesce(F.sum(F.length(tokens)), F.lit(0)).alias("n")).scalar()


def split_tokens(df: DataFrame, tokens: str, order: str, share: float = 0.9) -> DataFrame:
    """Positional split of the stream: ``(order, train, val)`` token strings per document.

    Only the document that lies across the cut has both.
    """
    cut = F.floor(total_tokens(df, tokens) * F.lit(share))
    placed = with_offsets(df.select(order, tokens), tokens, order)
    n_train = F.least(F.greatest(cut - F.col("start"), F.lit(0)), F.col("n_tokens")).cast("int")
    return placed.withColumn("_n", n_train).select(
        order,
        F.left(F.col(tokens), F.col("_n")).alias("train"),
        F.substr(F.col(tokens), F.col("_n") + 1).alias("val"),
    )


def pack_blocks(df: DataFrame, tokens: str, order: str, block: int) -> DataFrame:
    """The stream cut into blocks of ``block`` tokens: ``(block_id, n_tokens, tokens)``.

    A document is sliced at block borders, so a block gathers at most ``block`` slices.
    """
    placed = with_offsets(df.select(order, tokens), tokens, order).filter(F.col("n_tokens") > 0)
    first, last = F.expr(f"start div {block}"), F.expr(f"(start + n_tokens - 1) div {block}")
    end = F.col("start") + F.col("n_tokens")

    def slices(data: Column) -> Column:
        def one(i: Column) -> Column:
            lo, hi = F.greatest(i * block, F.col("start")), F.least((i + 1) * block, end)
            part = packed_slice(data, lo - F.col("start"), hi - lo)
            return F.struct(i.alias("block_id"), lo.alias("_at"), part.alias("_part"))

        return F.transform(F.sequence(first, last), one)

    # The text is packed once, not once per slice.
    parts = placed.select(F.inline(let(packed(F.col(tokens)), slices)))
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("_at", "_part"))), lambda p: p["_part"])
    return (
        parts.groupBy("block_id")
        .agg(F.array_join(ordered, "").alias("tokens"))
        .select("block_id", F.length("tokens").alias("n_tokens"), "tokens")
    )


def draw_table(spark: SparkSession, steps: int, batch: int) -> DataFrame:
    """The draws of a training run: ``batch`` slots in each of ``steps`` steps."""
    i = F.col("id")
    return spark.range(steps * batch).select(F.expr(f"id div {batch}").alias("step"), (i % batch).alias("slot"))


def sample_windows(blocks: DataFrame, n: Column, block: int, *, seed: int, draws: DataFrame) -> DataFrame:
    """One random window per draw: ``(step, slot, start, x, y)`` token strings.

    ``blocks`` are the packed blocks of a stream of ``n`` tokens; ``draws`` has ``(step, slot)``, see ``draw_table``. Starts lie in [0, n - block - 1), so the last possible start is never drawn, and a
    stream of ``block + 1`` tokens or fewer gives none. y is x moved by one token.
    """
    room = n - block - 1
    draws = (
        draws.select("step", "slot")
        .filter(room > 0)
        .withColumn("start", F.pmod(hash_int(shuffle_key(seed, F.col("step"), F.col("slot"))), room))
    )
    wanted = draws.withColumn("_b", F.expr(f"start div {block}")).select(
        "step", "slot", "start", F.explode(F.array(F.col("_b"), F.col("_b") + 1)).alias("block_id")
    )
    found = wanted.join(blocks.select("block_id", "tokens"), "block_id")
    both = F.array_join(
        F.transform(F.sort_array(F.collect_list(F.struct("block_id", "tokens"))), lambda p: p["tokens"]), ""
    )
    joined = found.groupBy("step", "slot", "start").agg(both.alias("_t"))
    at = (F.col("start") % block).cast("int")
    return joined.select(
        "step", "slot", "start",
        F.substr("_t", at + 1, F.lit(block)).alias("x"), F.substr("_t", at + 2, F.lit(block)).alias("y"),
    )


def shifted_targets(tokens: str) -> tuple[Column, Column]:
    """Inputs and targets of a sequence: all but the last, all but the first token."""
    n = F.greatest(F.length(tokens) - 1, F.lit(0))
    return F.left(F.col(tokens), n), F.substr(F.col(tokens), F.lit(2))
