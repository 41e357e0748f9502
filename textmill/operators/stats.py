"""Corpus measures and guards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def corpus_size(df: DataFrame, text: str) -> DataFrame:
    """Characters, UTF-8 bytes and MiB in one pass."""
    n_bytes = F.coalesce(F.sum(F.octet_length(text)), F.lit(0))
    return df.agg(
        F.count("*").alias("n_rows"),
        F.coalesce(F.sum(F.length(text)), F.lit(0)).alias("n_chars"),
        n_bytes.alias("n_bytes"),
        (n_bytes / F.lit(1048576.0)).alias("mib"),
    )


def compression(df: DataFrame, text: str, tokens: Column) -> DataFrame:
    """Tokens and characters per token, 0 for an empty corpus."""
    sums = df.select(F.length(text).alias("c"), F.length(tokens).alias("t")).agg(
        F.coalesce(F.sum("c"), F.lit(0)).alias("n_chars"), F.coalesce(F.sum("t"), F.lit(0)).alias("n_tokens")
    )
    ratio = F.when(F.col("n_tokens") > 0, F.col("n_chars") / F.col("n_tokens")).otherwise(F.lit(0.0))
    return sums.withColumn("chars_per_token", ratio)


def preflight(df: DataFrame, tokens: str, *, block_size: int, train_share: float = 0.9) -> DataFrame:
    """One row of counts and the errors that forbid a training set."""
    n = df.agg(F.count("*").alias("n_rows"), F.coalesce(F.sum(F.length(tokens)), F.lit(0)).alias("n_tokens"))
    train = F.floor(F.col("n_tokens") * F.lit(train_share))
    sized = n.withColumns({"n_train": train, "n_val": F.col("n_tokens") - train})
    errors = F.array_compact(
        F.array(
            F.when(F.col("n_tokens") == 0, "the corpus has no tokens"),
            F.when(F.col("n_train") <= block_size, "the training part is not longer than a block"),
            F.when(F.col("n_val") <= block_size, "the validation part is not longer than a block"),
        )
    )
    return sized.withColumn("errors", F.array_join(errors, "; ")).withColumn("ok", F.size(errors) == 0)


def require_rows(df: DataFrame, message: str) -> DataFrame:
    """Raise on an empty table; reads one row."""
    if df.isEmpty():
        raise ValueError(message)
    return df
