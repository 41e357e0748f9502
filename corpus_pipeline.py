"""The training-data pipeline: each stage takes what its predecessor kept and returns the columns of documents.

Every stage reads (spark, docs, sf_dir); its result is written as Parquet and read again as the next one's docs.
Toxicity's model is trained here, so no SQL gives the rows of ``run``; ``tests/llm`` compares them with a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.catalog.base import table
from textmill.llm import decontaminate, forest, mixing, pii, toxicity
from textmill.llm.sampling import remainder
from textmill.session import cut_lineage


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose worst window is toxic go; the model learns from the same labels as the query."""
    labels = table(spark, sf_dir, "labels")
    return toxicity.keep_clean(docs, toxicity.fit(docs, labels.where(remainder(F.col("doc_id"), 3) != 1)))


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of equal or near-equal documents the one with the smallest id stays."""
    return forest.one_per_group(docs)


def reject_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; n_chars follows."""
    return pii.redact(docs, pii.fit(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to their source's target weight, in a global shuffle order."""
    return mixing.replicate(docs, mixing.tempered_rates(docs))


STAGES = [
    ("toxicity", reject_toxic),
    ("near_copies", one_of_near_copies),
    ("decontaminate", reject_contaminated),
    ("pii", mask_personal_data),
    ("mixing", mix_sources),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = cut_lineage(docs)
    return docs
