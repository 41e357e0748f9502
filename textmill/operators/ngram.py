"""Next-token statistics from counts: fit, evaluate, look up and draw.

The model table has one row per seen (context, next) pair, so it is bounded by the square of the
vocabulary size, whatever the size of the corpus. Context and next are token characters.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textmill.functions.tokens import code_char
from textmill.operators.bpe import pair_counts
from textmill.operators.bpe_training import DENSE, Changes, slices
from textmill.operators.prefix import hash_int, shuffle_key
from textmill.session import cut_lineage

# Sampling defaults.
TEMPERATURE = 0.3
TOP_K = 40
MIN_TEMPERATURE = 1e-5

STEPS_PER_CHECKPOINT = 8


# A code takes so many bits where a run of at most three is one number.
_CODE_BITS = 21


def count_runs(texts: list[str], order: int) -> tuple[np.ndarray, np.ndarray]:
    """The different runs of ``order + 1`` codes within a text, a row each, and their numbers."""
    codes = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    if len(codes) <= order:
        return np.zeros((0, order + 1), np.uint32), np.zeros(0, np.int64)
    present = np.flatnonzero(np.bincount(codes))
    places = np.zeros(present[-1] + 1, np.int64)
    places[present] = np.arange(len(present))
    dense, base = places[codes], len(present)
    inside = np.ones(len(codes), bool)
    ends = np.cumsum([len(t) for t in texts])
    for back in range(1, order + 1):
        inside[ends[ends >= back] - back] = False
    inside = inside[: len(codes) - order]
    if base ** (order + 1) >= 1 << 63:
        parts = np.stack([codes[i : len(inside) + i][inside] for i in range(order + 1)], axis=1)
        return np.unique(parts, axis=0, return_counts=True)
    keys = dense[: len(inside)]
    for i in range(1, order + 1):
        keys = keys * base + dense[i : len(inside) + i]
    if base ** (order + 1) <= DENSE:
        counts = np.bincount(keys[inside])
        runs = np.flatnonzero(counts)
        n = counts[runs]
    else:
        runs, n = np.unique(keys[inside], return_counts=True)
    digits = [present[runs // base**i % base] for i in range(order, -1, -1)]
    return np.stack(digits, axis=1).astype(np.uint32), n


def _run_rows(runs: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    order = runs.shape[1] - 1
    text = np.ascontiguousarray(runs[:, :-1]).tobytes().decode("utf-32-le")
    ctx = [text[i * order : (i + 1) * order] for i in range(len(n))]
    return pa.RecordBatch.from_arrays([pa.array(ctx, pa.string()), pa.array(runs[:, -1].astype(np.int32)), pa.array(n)], names=["ctx", "nxt", "n"])


def _count_runs(order: int):
    """Runs of ``order + 1`` tokens of a row, counted slice by slice and, where a run fits a number, summed per task."""
    shifts = np.arange(order, -1, -1) * _CODE_BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = Changes()
        for batch in batches:
            for part in slices(batch, column=batch.schema.names[0]):
                runs, n = count_runs(part.column(0).to_pylist(), order)
                if order <= 2:
                    sums.put((runs.astype(np.int64) << shifts).sum(axis=1), n)
                else:
                    yield _run_rows(runs, n)
        keys, n = sums.sums()
        for at in range(0, len(keys), 1 << 16):
            codes = (keys[at : at + (1 << 16), None] >> shifts) & ((1 << _CODE_BITS) - 1)
            yield _run_rows(codes.astype(np.uint32), n[at : at + (1 << 16)])

    return count


def next_counts(df: DataFrame, tokens: str, order: int = 1) -> DataFrame:
    """``(ctx, nxt, n)``: character codes of neighbours, for a longer context its text before the next code.

    Counted per task before the shuffle, whatever the order.
    """
    if order > 1:
        data = df.filter(F.length(tokens) > order).select(tokens)
        return data.mapInArrow(_count_runs(order), "ctx string, nxt int, n bigint").groupBy("ctx", "nxt").agg(F.sum("n").alias("n"))
    return pair_counts(df, tokens).select(F.col("a").alias("ctx"), F.col("b").alias("nxt"), "n")


def lm_fit(df: DataFrame, tokens: str, *, vocab_size: int, add_k: float = 1.0, order: int = 1) -> DataFrame:
    """``(ctx, nxt, n, ctx_n, logp)`` with add-k smoothing. Contexts hold at most ``vocab_size`` rows."""
    counts = next_counts(df, tokens, order)
    total = F.sum("n").over(W.partitionBy("ctx"))
    logp = F.ln((F.col("n") + F.lit(add_k)) / (F.col("ctx_n") + F.lit(add_k * vocab_size)))
    return counts.withColumn("ctx_n", total).withColumn("logp", logp)


def lm_eval(model: DataFrame, df: DataFrame, tokens: str, *, vocab_size: int, add_k: float = 1.0, order: int = 1) -> DataFrame:
    """``(n_pairs, loss)``: mean cross-entropy. Pairs are counted first, so the join is vocabulary-sized."""
    held = next_counts(df, tokens, order).withColumnRenamed("n", "_m")
    contexts = model.select("ctx", "ctx_n").distinct()
    scored = held.join(contexts, "ctx", "left").join(model.select("ctx", "nxt", "logp"), ["ctx", "nxt"], "left")
    unseen = F.ln(F.lit(add_k) / (F.coalesce("ctx_n", F.lit(0)) + F.lit(add_k * vocab_size)))
    return scored.agg(
        F.coalesce(F.sum("_m"), F.lit(0)).alias("n_pairs"),
        (F.sum(-F.coalesce("logp", unseen) * F.col("_m")) / F.sum("_m")).alias("loss"),
    )


def lm_next(model: DataFrame, *, temperature: float = TEMPERATURE, top_k: int | None = TOP_K) -> DataFrame:
    """``(ctx, nxt, p)``: temperature, the top k with ties kept, renormalised."""
    t = max(temperature, MIN_TEMPERATURE)
    rows = model
    if top_k is not None:
        w = W.partitionBy("ctx").orderBy(F.desc("logp"))
        rows = model.withColumn("_rank", F.rank().over(w)).filter(F.col("_rank") <= top_k)
    best = F.max("logp").over(W.partitionBy("ctx"))
    weight = rows.withColumn("_w", F.exp((F.col("logp") - best) / F.lit(t)))
    return weight.select("ctx", "nxt", (F.col("_w") / F.sum("_w").over(W.partitionBy("ctx"))).alias("p"))


def backoff_fit(df: DataFrame, tokens: str, *, vocab_size: int, order: int, add_k: float = 1.0) -> DataFrame:
    """``(ctx, nxt, n, ctx_n, logp)`` for contexts of ``order`` tokens and fewer, down to none; a context is its text."""
    data = df.filter(F.length(tokens) > 0).select(tokens)
    counted = [
        data.filter(F.length(tokens) > k).mapInArrow(_count_runs(k), "ctx string, nxt int, n bigint") for k in range(order + 1)
    ]
    counts = reduce(DataFrame.unionByName, counted).groupBy("ctx", "nxt").agg(F.sum("n").alias("n"))
    logp = F.ln((F.col("n") + F.lit(add_k)) / (F.col("ctx_n") + F.lit(add_k * vocab_size)))
    return counts.withColumn("ctx_n", F.sum("n").over(W.partitionBy("ctx"))).withColumn("logp", logp)


def _longest_seen(rows: DataFrame, text: str, keys: list[str], contexts: DataFrame, order: int) -> DataFrame:
    """``(keys, state)``: the longest end of each text, of ``order`` tokens at most, that is a seen context."""
    ends = F.transform(F.sequence(F.lit(0), F.least(F.length(text), F.lit(order))), lambda k: F.right(F.col(text), k))
    long = rows.select(*keys, F.explode(ends).alias("ctx"))
    return long.join(contexts, "ctx", "left_semi").groupBy(*keys).agg(F.max_by("ctx", F.length("ctx")).alias("state"))


def backoff_table(dist: DataFrame, order: int) -> DataFrame:
    """``(state, choices)``: a row per seen context with its cumulative probabilities in token order, and the context that each choice leads to.

    The context after a choice is the longest seen end of the context and the token, so a walk over these states always has the longest seen
    context of its text, and an unseen one falls back to a shorter.
    """
    contexts = dist.select("ctx").distinct()
    moves = dist.select(F.col("ctx").alias("from"), "nxt", F.concat("ctx", code_char(F.col("nxt"))).alias("text"))
    leads = _longest_seen(moves, "text", ["from", "nxt"], contexts, order).withColumnsRenamed({"from": "ctx", "state": "to"})
    w = W.partitionBy("ctx").orderBy("nxt").rowsBetween(W.unboundedPreceding, W.currentRow)
    rows = dist.withColumn("hi", F.sum("p").over(w)).join(leads, ["ctx", "nxt"])
    choices = F.sort_array(F.collect_list(F.struct("nxt", "hi", "to"))).alias("choices")
    return rows.groupBy("ctx").agg(choices).withColumnRenamed("ctx", "state")


def backoff_generate(
    prompts: DataFrame, dist: DataFrame, *, key: str, tokens: str, order: int, steps: int, seed: int, eos: str | None = None
) -> DataFrame:
    """Append ``steps`` drawn tokens to every prompt by the longest seen context of up to ``order`` tokens; a row stops at ``eos``.

    Each step is one equi-join with the table of states, one row per context. Keys are unique.
    """
    dist = cut_lineage(dist)
    table = cut_lineage(backoff_table(dist, order))
    start = _longest_seen(prompts.select(key, F.col(tokens).alias("tokens")), "tokens", [key], table.select(F.col("state").alias("ctx")), order)
    rows = prompts.select(key, F.col(tokens).alias("tokens")).join(start, key, "left").withColumn("_done", F.lit(False))
    for step in range(steps):
        live = F.when(~F.col("_done"), F.col("state"))
        rows = rows.withColumns({"state": live, "_u": uniform(seed, F.col(key), F.lit(step))}).join(table, "state", "left")
        picked = F.coalesce(
            F.get(F.filter("choices", lambda c: c["hi"] > F.col("_u")), F.lit(0)), F.try_element_at("choices", F.lit(-1))
        )
        rows = rows.withColumn("_c", picked).withColumn("_t", code_char(F.col("_c.nxt")))
        done = F.col("_t").isNull() | (F.col("_t") == eos) if eos is not None else F.col("_t").isNull()
        rows = rows.select(
            key, F.concat("tokens", F.coalesce("_t", F.lit(""))).alias("tokens"), F.col("_c.to").alias("state"), done.alias("_done")
        )
        if (step + 1) % STEPS_PER_CHECKPOINT == 0 and step + 1 < steps:
            rows = cut_lineage(rows)
    return rows.select(key, "tokens")


def choice_table(dist: DataFrame) -> DataFrame:
    """``(ctx, choices)``: one row per context with its cumulative probabilities in token order."""
    w = W.partitionBy("ctx").orderBy("nxt").rowsBetween(W.unboundedPreceding, W.currentRow)
    cumulative = dist.withColumn("hi", F.sum("p").over(w))
    return cumulative.groupBy("ctx").agg(F.sort_array(F.collect_list(F.struct("nxt", "hi"))).alias("choices"))


def uniform(seed: int, *cols: Column) -> Column:
    """Reproducible draw in [0, 1) from the row's identity."""
    return hash_int(shuffle_key(seed, *cols), 13) / F.lit(float(1 << 52))


def lm_generate(
    prompts: DataFrame, dist: DataFrame, *, key: str, tokens: str, steps: int, seed: int, eos: str | None = None
) -> DataFrame:
    """Append ``steps`` drawn tokens to every prompt; a row stops at ``eos`` or at an unseen context.

    Each step is one equi-join with the choice table, one row per context.
    """
    table = cut_lineage(choice_table(dist))
    rows = prompts.select(key, F.col(tokens).alias("tokens")).withColumn("_done", F.lit(False))
    for step in range(steps):
        ctx = F.when(~F.col("_done"), F.ascii(F.right("tokens", F.lit(1))))
        u = uniform(seed, F.col(key), F.lit(step))
        picked = F.coalesce(
            F.get(F.filter("choices", lambda c: c["hi"] > F.col("_u")), F.lit(0))["nxt"],
            F.try_element_at("choices", F.lit(-1))["nxt"],
        )
        rows = (
            rows.withColumns({"ctx": ctx, "_u": u})
            .join(table, "ctx", "left")
            .withColumn("_c", code_char(picked))
            .withColumn("tokens", F.concat("tokens", F.coalesce("_c", F.lit(""))))
            .withColumn("_done", F.col("_c").isNull() | (F.col("_c") == eos) if eos is not None else F.col("_c").isNull())
            .select(key, "tokens", "_done")
        )
        if (step + 1) % STEPS_PER_CHECKPOINT == 0 and step + 1 < steps:
            rows = cut_lineage(rows)
    return rows.select(key, "tokens")
