"""Run metadata files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.session import cut_lineage

SCHEMA = (
    "name string, version int, folder string, size_tag string, num_params bigint, iteration bigint, "
    "max_iters bigint, config struct<tokenizer_type:string, vocab_size:int, n_embed:int, n_head:int, "
    "n_layer:int, block_size:int, dropout:double>, description string, created_at string, updated_at string"
)


def read_runs(spark: SparkSession, root: str, name: str = "info.json") -> DataFrame:
    """All metadata files one folder below ``root``; unreadable ones are left out.

    ``path_folder`` is the folder on disk, which can differ from the recorded one.
    """
    df = (
        spark.read.schema(SCHEMA + ", _corrupt string")
        .option("columnNameOfCorruptRecord", "_corrupt")
        .json(f"{root}/*/{name}", multiLine=True, mode="PERMISSIVE")
    )
    on_disk = F.url_decode(F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/[^/]+$", 1))
    return df.withColumn("path_folder", on_disk).filter(F.col("_corrupt").isNull()).drop("_corrupt")


def write_runs(runs: DataFrame, path: str) -> None:
    """Replace a stored registry; ``runs`` may have been read from the same folder, so it is written aside first."""
    cut_lineage(runs).write.mode("overwrite").parquet(path)
