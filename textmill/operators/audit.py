"""Checks of run configurations, as columns over a table of configurations.

A configuration row has ``vocab_size, n_embed, n_head, n_layer, block_size, tokenizer_type,
dataset_chars``; ``dataset_chars`` is null when the data set is absent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.functions.runs import memory_mib, param_count

# The bands of characters per parameter.
VERY_LITTLE = 0.1
SMALL = 0.5


def architecture_errors() -> list[Column]:
    c = F.col
    return [
        F.when((c("n_head") != 0) & (F.try_mod("n_embed", "n_head") != 0), "width is not a multiple of the heads"),
        F.when(c("n_embed") <= 0, "width is not positive"),
        F.when(c("n_head") <= 0, "heads are not positive"),
        F.when(c("n_layer") <= 0, "layers are not positive"),
        F.when(c("block_size") <= 0, "context is not positive"),
    ]


def config_audit(configs: DataFrame) -> DataFrame:
    """Adds parameters, memory, data ratio and band, errors, warnings and the verdict ``go``."""
    sized = configs.withColumn("num_params", param_count(F.col("vocab_size"), F.col("n_embed"), F.col("n_layer"), F.col("block_size")))
    ratio = F.when(
        (F.coalesce("dataset_chars", F.lit(0)) > 0) & (F.col("num_params") > 0),
        F.col("dataset_chars") / F.col("num_params"),
    )
    band = (
        F.when(F.col("ratio").isNull(), "unknown")
        .when(F.col("ratio") < VERY_LITTLE, "very little")
        .when(F.col("ratio") < SMALL, "small")
        .otherwise(F.lit("enough"))
    )
    errors = [
        *architecture_errors(),
        F.when(F.col("dataset_chars").isNull(), "the data set is absent"),
        F.when(F.coalesce("vocab_size", F.lit(0)) <= 0, "there is no tokenizer vocabulary"),
    ]
    kind = F.upper(F.coalesce("tokenizer_type", F.lit("unknown")))
    warnings = [
        F.when(kind.isin("CHAR", "CHARACTER"), "the tokenizer is character level"),
        F.when(kind == "UNKNOWN", "the tokenizer type is unknown"),
        F.when(F.col("ratio") < VERY_LITTLE, "the data set is very small for the model"),
    ]
    return (
        sized.withColumn("memory", memory_mib(F.col("num_params")))
        .withColumn("ratio", ratio)
        .withColumns({
            "band": band,
            "errors": F.array_compact(F.array(*errors)),
            "warnings": F.array_compact(F.array(*warnings)),
        })
        .withColumn("go", F.size("errors") == 0)
    )


def size_multiple(runs: DataFrame, baseline: Column) -> DataFrame:
    """Parameters of every run as a multiple of one baseline run, picked by a condition.

    The baseline is one scalar; with several matches the smallest folder counts.
    """
    base = runs.filter(baseline).agg(F.min_by("num_params", "folder")).scalar()
    return runs.select("folder", "num_params", (F.col("num_params") / base).alias("multiple"))
