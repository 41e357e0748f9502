"""Progress of runs from their log lines, the same columns for batch and stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

# The shapes of the log lines. The step may or may not name its goal.
STEP_PATTERN = r"step\s+(\d+)\s*(?:/\s*\d+\s*)?\|"
DOWNLOAD_PATTERN = r"DOWNLOAD_PROGRESS:([\d.]+)"


def last_match(text: Column, pattern: str) -> Column:
    """First group of the last match in a chunk; null without one."""
    return F.try_element_at(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), F.lit(-1))


def parse_lines(lines: DataFrame, text: str, max_iters: int) -> DataFrame:
    """Adds ``step``, at most ``max_iters``, and ``percent``; null where a line has none."""
    # least() skips nulls, so a line without a step would read as the last one.
    clamp = lambda v: F.when(v > max_iters, F.lit(max_iters).cast("bigint")).otherwise(v)
    return lines.withColumns({
        "step": clamp(last_match(F.col(text), STEP_PATTERN).cast("bigint")),
        "percent": last_match(F.col(text), DOWNLOAD_PATTERN).cast("double"),
    })


def latest_progress(parsed: DataFrame, run: str, seq: str) -> DataFrame:
    """Last step and last percent per run. Both are partial aggregates, in batch and stream."""
    at = lambda c: F.when(F.col(c).isNotNull(), F.col(seq))
    return parsed.groupBy(run).agg(
        F.max_by("step", at("step")).alias("step"), F.max_by("percent", at("percent")).alias("percent")
    )


def progress_metrics(it: Column, elapsed: Column, max_iters: int) -> tuple[Column, Column]:
    """Steps per second and remaining seconds, 0 where they cannot be told."""
    rate = F.when(elapsed > 0, it / F.nullif(elapsed, F.lit(0.0))).otherwise(F.lit(0.0))
    eta = F.when(rate > 0, (F.lit(max_iters) - it) / F.nullif(rate, F.lit(0.0))).otherwise(F.lit(0.0))
    return rate, eta


def is_reported(it: Column) -> Column:
    """Steps the log reports: the first and every 50th."""
    return (it == 1) | (it % 50 == 0)


def log_line(it: Column, loss: Column, rate: Column, eta: Column, max_iters: int) -> Column:
    return F.format_string(
        f"step %5d/{max_iters} | loss %.4f | %.2f steps/s | ETA %.1f min", it, loss, rate, eta / 60
    )


def progress_stream(spark: SparkSession, folder: str, *, max_iters: int, schema: str, run: str, seq: str, text: str) -> DataFrame:
    """Streaming twin of the batch query over a folder that log files arrive in."""
    lines = spark.readStream.schema(schema).parquet(folder)
    return latest_progress(parse_lines(lines, text, max_iters), run, seq)


def stage_status(events: DataFrame, run: str, seq: str, code: str) -> DataFrame:
    """Status per run by its last event: started, finished with code 0, or failed."""
    last = events.groupBy(run).agg(F.max_by(F.struct(code, "kind"), seq).alias("e"))
    status = (
        F.when(F.col("e.kind") == "start", "running")
        .when(F.col(f"e.{code}") == 0, "idle")
        .otherwise(F.lit("failed"))
    )
    return last.select(run, status.alias("status"))


def publish(live: DataFrame, folder: str, checkpoint: str) -> None:
    """Run a progress stream over what has arrived; a batch writes the runs that changed, and no others.

    Batches go to folders of their own, so a replayed batch replaces itself and a reader never sees one half written.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/batch={number}")

    query = (
        live.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def published(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    """The newest published row of each run; the first column of the schema names the run."""
    table = spark.read.schema(StructType(schema.fields + [StructField("batch", LongType())])).parquet(folder)
    run, *others = schema.names
    newest = table.groupBy(run).agg(F.max_by(F.struct(*others), "batch").alias("_last"))
    return newest.select(run, *[F.col(f"_last.{c}").alias(c) for c in others])
