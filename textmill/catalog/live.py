"""Progress, status and incremental ingest, batch and streaming."""

from __future__ import annotations

from pyspark.sql import functions as F

from textmill.catalog.base import NL, query, sql_clean, table
from textmill.session import scratch_path
from textmill.streaming import ingest as I
from textmill.streaming import progress as P

MAX_ITERS = 5000


def c(name):
    return F.col(name)


def log_lines(spark, sf):
    """Log lines of runs made of events: a step, a download percentage, or neither."""
    it = (c("event_id") * 7) % 9000 + 1
    rate, eta = P.progress_metrics(it, c("value"), MAX_ITERS)
    line = (
        F.when(c("event_type") == "error", F.concat(F.lit("DOWNLOAD_PROGRESS:"), c("value").cast("string")))
        .when(c("event_type") == "signup", F.concat(F.lit("saved checkpoint, step count "), it))
        .when(c("event_type") == "view", F.concat(F.lit("step "), it, F.lit(" | loss "), c("value")))
        .otherwise(P.log_line(it, c("value"), rate, eta, MAX_ITERS))
    )
    return table(spark, sf, "events").select(c("user_id").alias("run"), c("event_id").alias("seq"), line.alias("line"))


SQL_PROGRESS = f"""SELECT user_id AS run, arg_max(step, event_id) FILTER (WHERE step IS NOT NULL) AS step, arg_max(percent, event_id) FILTER (WHERE percent IS NOT NULL) AS percent
 FROM (SELECT user_id, event_id, CASE WHEN event_type NOT IN ('error', 'signup') THEN least((event_id * 7) % 9000 + 1, {MAX_ITERS}) END AS step,
 CASE WHEN event_type = 'error' THEN value END AS percent FROM events) GROUP BY user_id"""


@query("log_progress", SQL_PROGRESS)
def log_progress(spark, sf):
    return P.latest_progress(P.parse_lines(log_lines(spark, sf), "line", MAX_ITERS), "run", "seq")


@query("log_progress_stream", SQL_PROGRESS)
def log_progress_stream(spark, sf):
    """The same over a folder of line files, as a stream run to its end."""
    lines, out = scratch_path(spark, "lines"), scratch_path(spark, "progress")
    log_lines(spark, sf).repartition(4, "seq").write.parquet(lines)
    live = P.progress_stream(
        spark, lines, max_iters=MAX_ITERS, schema="run bigint, seq bigint, line string", run="run", seq="seq", text="line"
    )
    P.publish(live, out, scratch_path(spark, "state"))
    return P.published(spark, out, live.schema)


@query(
    "progress_eta",
    f"SELECT event_id, round(rate, 6) AS rate, round(CASE WHEN rate > 0 THEN ({MAX_ITERS} - it) / rate ELSE 0 END, 6) AS eta FROM "
    "(SELECT event_id, it, CASE WHEN value > 0 THEN it / value ELSE 0 END AS rate FROM (SELECT *, event_id + 1 AS it FROM events)) WHERE it = 1 OR it % 50 = 0",
)
def progress_eta(spark, sf):
    it = c("event_id") + 1
    rate, eta = P.progress_metrics(it, c("value"), MAX_ITERS)
    rows = table(spark, sf, "events").filter(P.is_reported(it))
    return rows.select("event_id", F.round(rate, 6).alias("rate"), F.round(eta, 6).alias("eta"))


@query(
    "stage_status",
    "SELECT user_id AS run, CASE WHEN t IN ('view', 'click') THEN 'running' WHEN t = 'purchase' THEN 'idle' ELSE 'failed' END AS status "
    "FROM (SELECT user_id, arg_max(event_type, event_id) AS t FROM events GROUP BY user_id)",
)
def stage_status(spark, sf):
    kind = F.when(c("event_type").isin("view", "click"), "start").otherwise(F.lit("end"))
    code = F.when(c("event_type") == "purchase", 0).otherwise(1)
    events = table(spark, sf, "events").select(
        c("user_id").alias("run"), c("event_id").alias("seq"), kind.alias("kind"), code.alias("code")
    )
    return P.stage_status(events, "run", "seq", "code")


LOTS = 4


def arriving(spark, sf):
    """A folder of documents arriving in four lots, and the files of a lot: as many as the scan has parts, so that a file does not grow with the table."""
    folder, docs = scratch_path(spark, "arriving"), table(spark, sf, "documents").select("doc_id", "text")
    files = -(-docs.rdd.getNumPartitions() // LOTS)
    docs.repartition(LOTS * files, "doc_id").write.parquet(folder)
    return folder, files


@query(
    "stream_ingest",
    f"SELECT doc_id, t || {NL} || {NL} AS block, (length(t) + 2)::BIGINT AS n_chars FROM (SELECT doc_id, {sql_clean('text')} AS t FROM documents) WHERE length(t) >= 40",
)
def stream_ingest(spark, sf):
    """Documents arriving in four lots of files, taken in one by one."""
    (folder, files), target = arriving(spark, sf), scratch_path(spark, "ingested")
    I.ingest(
        spark, folder, "doc_id bigint, text string", target, scratch_path(spark, "state"),
        text="text", key="doc_id", min_chars=40, files_per_batch=files,
    )
    return spark.read.parquet(target).select("doc_id", "block", "n_chars")


@query(
    "stream_ingest_budget",
    f"""SELECT doc_id, block, n_chars FROM (SELECT *, sum(n_chars) OVER (ORDER BY doc_id) AS upto FROM (SELECT doc_id, t || {NL} || {NL} AS block,
 (length(t) + 2)::BIGINT AS n_chars FROM (SELECT doc_id, {sql_clean('text')} AS t FROM documents) WHERE length(t) >= 40)) WHERE upto - n_chars < 300000""",
)
def stream_ingest_budget(spark, sf):
    """Stopped at one budget, then taken up again with a larger one."""
    (folder, _), target, state = arriving(spark, sf), scratch_path(spark, "ingested"), scratch_path(spark, "state")
    for budget in (100_000, 300_000):
        I.ingest(spark, folder, "doc_id bigint, text string", target, state, text="text", key="doc_id", min_chars=40, budget=budget)
    return spark.read.parquet(target).select("doc_id", "block", "n_chars")
