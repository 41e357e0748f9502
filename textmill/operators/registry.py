"""The run registry as tables.

``runs`` has ``folder, name, version, size_tag, num_params, iteration, max_iters, config,
description, created_at, updated_at`` with ISO texts for times, and where it was read from files
``path_folder``, the folder on disk; ``folders`` has ``folder, has_weights``, one row per folder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.functions.runs import parse_folder, run_folder, size_tag


def default_description(tokenizer_type: Column, n_chars: Column) -> Column:
    """Description of a run that brings none, by the kind of its tokenizer."""
    kind = F.when(F.lower(tokenizer_type) == "bpe", "Byte-pair").otherwise(F.lit("Character-level"))
    trained = F.concat(F.lit(" model trained on "), F.format_number(n_chars, 0), F.lit(" characters of text."))
    return F.concat(kind, F.when(F.coalesce(n_chars, F.lit(0)) > 0, trained).otherwise(F.lit(" model.")))


# The descriptions a saved run gets when it brings none.
SAVED_CHARS = ("Character-level GPT trained on ", " characters of text.")
SAVED_PLAIN = "Character-level GPT trained from scratch."


def saved_description(n_chars: Column) -> Column:
    """Description written with a run that brings none; ``n_chars`` is null or 0 where it is not known."""
    return F.when(
        F.coalesce(n_chars, F.lit(0)) > 0, F.concat(F.lit(SAVED_CHARS[0]), F.format_number(n_chars, 0), F.lit(SAVED_CHARS[1]))
    ).otherwise(F.lit(SAVED_PLAIN))


def upsert_runs(old: DataFrame, new: DataFrame, now: Column) -> DataFrame:
    """New rows replace old ones of the same folder; the first ``created_at`` stays.

    ``new`` may have ``dataset_chars`` for the description of runs that bring none.
    """
    n_chars = F.col("dataset_chars") if "dataset_chars" in new.columns else F.lit(None).cast("bigint")
    new = new.withColumn("description", F.coalesce("description", saved_description(n_chars))).drop("dataset_chars")
    kept = old.select(*[F.col(c).alias(f"_o_{c}") for c in old.columns])
    both = kept.join(new, F.col("_o_folder") == F.col("folder"), "full_outer")
    fresh = F.col("folder").isNotNull()
    out = []
    for c in old.columns:
        if c == "created_at":
            value = F.coalesce(F.col("_o_created_at"), F.when(fresh, F.coalesce("created_at", now)))
        elif c == "updated_at":
            value = F.when(fresh, now).otherwise(F.col("_o_updated_at"))
        elif c == "size_tag":
            value = F.when(fresh, size_tag(F.col("num_params"))).otherwise(F.col("_o_size_tag"))
        else:
            value = F.when(fresh, F.col(c)).otherwise(F.col(f"_o_{c}"))
        out.append(value.alias(c))
    return both.select(*out)


def next_versions(folders: DataFrame) -> DataFrame:
    """``(name, next_version)`` of every name seen in folder names that match the layout."""
    parts = folders.select(parse_folder(F.col("folder")).alias("p")).filter(F.col("p.name").isNotNull())
    return parts.groupBy(F.col("p.name").alias("name")).agg((F.max("p.version") + 1).alias("next_version"))


def plan_folders(wanted: DataFrame, folders: DataFrame) -> DataFrame:
    """Folder of a new run per ``(name, num_params)`` row: the next version of its name, or 1."""
    joined = wanted.join(next_versions(folders), "name", "left")
    version = F.coalesce("next_version", F.lit(1))
    return joined.select(
        "name", version.alias("version"), run_folder(F.col("name"), version, F.col("num_params")).alias("folder")
    )


def with_info(folders: DataFrame, runs: DataFrame) -> DataFrame:
    """Folders that hold weights with what is known of them; a folder without metadata stays."""
    found_in = "path_folder" if "path_folder" in runs.columns else "folder"
    known = runs.withColumn("_at", F.col(found_in)).withColumnRenamed("folder", "info_folder")
    held = folders.filter(F.col("has_weights"))
    return held.join(known, F.col("folder") == F.col("_at"), "left").drop("_at")


def newest_first() -> list[Column]:
    """Order by the update time as text, missing last, then by folder, both descending."""
    return [F.coalesce("updated_at", F.lit("")).desc(), F.col("folder").desc()]


def list_runs(folders: DataFrame, runs: DataFrame) -> DataFrame:
    return with_info(folders, runs).select("folder", "updated_at").orderBy(*newest_first())


def latest_run(folders: DataFrame, runs: DataFrame) -> DataFrame:
    return list_runs(folders, runs).limit(1)


def latest_per_name(folders: DataFrame, runs: DataFrame) -> DataFrame:
    """The newest run of each name: one aggregate with partial results, no window."""
    order = F.struct(F.coalesce("updated_at", F.lit("")), F.col("folder"))
    info = with_info(folders, runs).filter(F.col("name").isNotNull())
    return info.groupBy("name").agg(F.max_by("folder", order).alias("folder"))


def run_details(folders: DataFrame, runs: DataFrame) -> DataFrame:
    """One display row per run; the folder stands in for a missing name."""
    d = with_info(folders, runs)
    return d.select(
        F.coalesce("info_folder", "folder").alias("name"), F.coalesce("name", "folder").alias("display_name"),
        "version", "size_tag", F.col("iteration").alias("iter"), "max_iters", "num_params", "description",
        "created_at", "updated_at",
    )


def migrate_plan(legacy: DataFrame, folders: DataFrame, name: str) -> DataFrame:
    """The registry rows a legacy checkpoint becomes; none once any run has weights.

    ``legacy`` has ``num_params, iteration``; one checkpoint is one row.
    """
    free = folders.filter(F.col("has_weights")).limit(1).agg((F.count("*") == 0).alias("free")).scalar()
    wanted = legacy.filter(free).withColumn("name", F.lit(name))
    planned = wanted.join(next_versions(folders), "name", "left")
    version = F.coalesce("next_version", F.lit(1))
    return planned.select(
        "name", version.alias("version"),
        run_folder(F.col("name"), version, F.col("num_params")).alias("folder"),
        size_tag(F.col("num_params")).alias("size_tag"), "num_params", "iteration",
    )


def vocab_mismatch(runs: DataFrame, tokenizers: DataFrame) -> DataFrame:
    """Runs whose configured vocabulary differs from their tokenizer's."""
    joined = runs.select("folder", "config.vocab_size").join(
        tokenizers.select("folder", F.col("vocab_size").alias("tokenizer_vocab")), "folder"
    )
    return joined.filter(F.col("vocab_size") != F.col("tokenizer_vocab"))
