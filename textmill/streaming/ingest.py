"""Incremental ingest of documents up to a character budget."""

from __future__ import annotations

from pyspark.errors import AnalysisException, StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.functions.render import document_block
from textmill.functions.text import non_null
from textmill.operators.prefix import running_total


class _Full(Exception):
    """Ends a stream before its batch is committed."""


def ingest(
    spark: SparkSession, folder: str, schema: str, target: str, checkpoint: str, *,
    text: str, key: str, min_chars: int, budget: int | None = None, files_per_batch: int | None = None,
) -> int:
    """Clean, filter and append the files of a folder; returns the characters in the table.

    Each batch writes its own folder ``batch=N``, so a replayed batch replaces itself. The budget ends after the row, in the
    order of ``key`` within a batch, that reaches it. That batch is not committed: a run with a larger budget
    takes it again, whole, and goes on with the files after it. A run whose budget is met by what is stored changes nothing.
    """
    stream = spark.readStream.schema(schema)
    if files_per_batch is not None:
        stream = stream.option("maxFilesPerTrigger", files_per_batch)
    blocks = non_null(stream.parquet(folder), key, block=document_block(F.col(text), min_chars))

    def stored(without: int | None = None) -> int:
        try:
            table = spark.read.schema(f"{key} bigint, block string, n_chars bigint, batch bigint").parquet(target)
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return 0
        if without is not None:
            table = table.filter(F.col("batch") != without)
        return table.agg(F.coalesce(F.sum("n_chars"), F.lit(0))).first()[0]

    if budget is not None and (there := stored()) >= budget:
        return there

    # Summed once per run, without the batch that may be a replay, then carried on batch by batch.
    total: list[int] = []
    full: list[int] = []

    def append(batch: DataFrame, number: int) -> None:
        if not total:
            total.append(stored(without=number))
        rows = batch.withColumn("n_chars", F.length("block").cast("bigint"))
        if budget is not None:
            left = budget - total[0]
            rows = running_total(rows, F.col("n_chars"), key, out="_upto")
            rows = rows.filter(F.col("_upto") - F.col("n_chars") < left).drop("_upto")
        path = f"{target}/batch={number}"
        rows.write.mode("overwrite").parquet(path)
        total[0] += spark.read.parquet(path).agg(F.coalesce(F.sum("n_chars"), F.lit(0))).first()[0]
        if budget is not None and total[0] >= budget:
            full.append(number)
            raise _Full(f"{total[0]} characters of {budget}")

    query = (
        blocks.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    try:
        query.awaitTermination()
    except StreamingQueryException:
        if not full:
            raise
    return stored()
