"""Caps, unions, shuffles, budgets, whole corpora and their files."""

from __future__ import annotations

from pyspark.sql import functions as F

from textmill.catalog.base import NL, query, sql_clean, sql_qa, table
from textmill.catalog.rendering import SQL_PAIRS, pairs
from textmill.functions import render as R
from textmill.operators import dialogue as D
from textmill.operators import mixture as M
from textmill.operators.prefix import hash_int, running_total, take_first
from textmill.plans.builders import union_blocks
from textmill.session import scratch_path, spread_few
from textmill.sources import sinks

BUDGET = 1_000_000


def c(name):
    return F.col(name)


# ---------------------------------------------------------------- block tables


def document_blocks(spark, sf):
    return M.as_blocks(
        spread_few(table(spark, sf, "documents").select("doc_id", "source", "text"), "doc_id"),
        F.lit("facts"), c("source"), c("doc_id"), R.document_block(c("text"), 40),
    )


def mixed_blocks(spark, sf):
    """Dialogue pairs, whole dialogues, documents and benchmark texts as one block table."""
    talk = pairs(spark, sf)
    key = F.concat_ws(":", "conv_id", "turn")
    spoken = M.as_blocks(
        talk, F.lit("language"), F.lit("talk"), key, R.qa_block(c("question"), c("answer"), "LANGUAGE")
    )
    speaker = F.when(c("role") == "user", "User").otherwise(F.lit("Assistant"))
    chats = D.conversation_blocks(table(spark, sf, "conversations"), "conv_id", "turn", speaker, c("text")).select(
        F.lit("conversation").alias("domain"), F.lit("chat").alias("source"),
        c("conv_id").cast("string").alias("row_key"), "weight", "block",
    )
    items = M.as_blocks(
        table(spark, sf, "benchmark"), F.lit("writing"), F.lit("benchmark"), c("item_id"), R.document_block(c("text"), 30)
    )
    return union_blocks([spoken, chats, document_blocks(spark, sf), items])


SQL_DOCS = f"""SELECT 'facts' AS domain, source, doc_id::VARCHAR AS row_key, t || {NL} || {NL} AS block
 FROM (SELECT doc_id, source, {sql_clean("text")} AS t FROM documents) WHERE length(t) >= 40"""
SQL_MIX = f"""(SELECT 'language' AS domain, 'talk' AS source, conv_id || ':' || turn AS row_key, {sql_qa("q", "a", "LANGUAGE")} AS block
 FROM (SELECT conv_id, turn, {sql_clean("question")} AS q, {sql_clean("answer")} AS a FROM {SQL_PAIRS}) WHERE q <> '' AND a <> ''
 UNION ALL SELECT 'conversation', 'chat', conv_id::VARCHAR,
 '[CONVERSATION]' || {NL} || string_agg(s || ': ' || t, {NL} ORDER BY turn) || {NL} || {NL}
 FROM (SELECT conv_id, turn, CASE role WHEN 'user' THEN 'User' ELSE 'Assistant' END AS s, {sql_clean("text")} AS t FROM conversations)
 WHERE t <> '' GROUP BY conv_id HAVING count(*) >= 2
 UNION ALL {SQL_DOCS}
 UNION ALL SELECT 'writing', 'benchmark', item_id::VARCHAR, t || {NL} || {NL}
 FROM (SELECT item_id, {sql_clean("text")} AS t FROM benchmark) WHERE length(t) >= 30)"""


def sql_budget(blocks: str, budget: int) -> str:
    return (
        f"(SELECT * FROM (SELECT *, (sum(length(block)) OVER (ORDER BY ord, source, row_key))::BIGINT AS running FROM "
        f"(SELECT *, md5('18:' || source || ':' || row_key) AS ord FROM {blocks})) WHERE running <= {budget})"
    )


# ---------------------------------------------------------------- operators


@query(
    "source_cap",
    "SELECT doc_id, source FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS r FROM documents "
    "WHERE lang IN ('en', 'de', 'fr')) WHERE r <= 20",
)
def source_cap(spark, sf):
    """The loader's own filter comes first, as only rows that pass it count."""
    rows = table(spark, sf, "documents").filter(c("lang").isin("en", "de", "fr"))
    return take_first(rows, 20, "doc_id", group=["source"]).select("doc_id", "source")


@query("split_cap", "SELECT doc_id FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id % 3, doc_id) AS r FROM documents) WHERE r <= 400")
def split_cap(spark, sf):
    """A cap over splits read one after another."""
    rows = table(spark, sf, "documents").withColumn("split_ord", c("doc_id") % 3)
    return take_first(rows, 400, "doc_id", major="split_ord").select("doc_id")


@query(
    "running_total",
    "SELECT o_orderkey, o_orderpriority, (sum(length(o_orderpriority)) OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey))::BIGINT AS running FROM orders",
)
def grouped_total(spark, sf):
    """A running total within a few very large groups."""
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return running_total(rows, F.length("o_orderpriority"), "o_orderkey", group=["o_orderpriority"])


@query("mix_union", f"SELECT domain, source, row_key, block FROM {SQL_MIX}")
def mix_union(spark, sf):
    return mixed_blocks(spark, sf).select("domain", "source", "row_key", "block")


@query(
    "running_total_hashed",
    """SELECT o_orderkey, (sum(length(o_orderpriority)) OVER (ORDER BY k))::BIGINT AS running FROM
 (SELECT *, ('0x' || substr(md5(o_orderkey::VARCHAR), 1, 15))::BIGINT AS k FROM orders)""",
)
def hashed_total(spark, sf):
    """One running total over all rows, ordered by a hash: keys as sparse as they come."""
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", hash_int(F.md5(c("o_orderkey").cast("string"))).alias("k"))
    return running_total(rows, F.length("o_orderpriority"), "k").select("o_orderkey", "running")


@query(
    "source_cap_hashed",
    """SELECT doc_id, source FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY
 ('0x' || substr(md5(doc_id::VARCHAR), 1, 15))::BIGINT) AS r FROM documents) WHERE r <= 20""",
)
def source_cap_hashed(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id", "source", hash_int(F.md5(c("doc_id").cast("string"))).alias("k"))
    return take_first(rows, 20, "k", group=["source"]).select("doc_id", "source")


@query("seeded_shuffle", "SELECT doc_id, source, md5('18:' || source || ':' || doc_id) AS ord FROM documents")
def seeded_shuffle(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id", "source", c("doc_id").cast("string").alias("row_key"))
    return M.seeded_order(rows).orderBy("ord").select("doc_id", "source", "ord")


@query("char_budget", f"SELECT source, row_key, running FROM {sql_budget(f'({SQL_DOCS})', 600_000)}")
def char_budget(spark, sf):
    return M.char_budget(document_blocks(spark, sf), 600_000).select("source", "row_key", "running")


@query("build_mixture", f"SELECT domain, source, row_key, running, block FROM {sql_budget(SQL_MIX, BUDGET)}")
def build_mixture(spark, sf):
    return M.char_budget(mixed_blocks(spark, sf), BUDGET).select("domain", "source", "row_key", "running", "block")


@query(
    "mixture_report",
    f"SELECT domain, source, count(*) AS examples, sum(length(block))::BIGINT AS chars FROM {sql_budget(SQL_MIX, BUDGET)} GROUP BY ROLLUP (domain, source)",
)
def mixture_report(spark, sf):
    return M.report(M.char_budget(mixed_blocks(spark, sf), BUDGET))


@query(
    "saturating_budget",
    f"""SELECT source_ord, doc_id, n FROM (SELECT *, coalesce(sum(n) OVER (ORDER BY source_ord, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
 row_number() OVER (PARTITION BY source_ord ORDER BY doc_id) AS r FROM (SELECT doc_id, substr(source, 4)::INT AS source_ord,
 CASE WHEN lang = 'en' AND length(t) >= 40 THEN length(t) + 2 ELSE 0 END AS n FROM
 (SELECT doc_id, source, lang, {sql_clean("text")} AS t FROM documents))) WHERE (before < 700000 OR r = 1 OR source_ord = 7) AND n > 0""",
)
def saturating_budget(spark, sf):
    """Sources in numbered order up to 700,000 characters; src7 is read whole. Only English rows count."""
    block = F.when(c("lang") == "en", R.document_block(c("text"), 40))
    rows = table(spark, sf, "documents").select(
        "doc_id", F.substring("source", 4, 9).cast("int").alias("source_ord"), block.alias("block")
    )
    read = M.saturating_budget(rows, 700_000, source_ord="source_ord", row_ord="doc_id", checked=c("source_ord") != 7)
    return read.select("source_ord", "doc_id", F.length("block").cast("bigint").alias("n"))


SQL_SATURATED = f"""(SELECT source, doc_id::VARCHAR AS row_key, t || {NL} || {NL} AS block FROM
 (SELECT *, coalesce(sum(n) OVER (ORDER BY source_ord, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
 row_number() OVER (PARTITION BY source_ord ORDER BY doc_id) AS r FROM
 (SELECT *, CASE WHEN length(t) >= 40 THEN length(t) + 2 ELSE 0 END AS n FROM
 (SELECT doc_id, source, substr(source, 4)::INT AS source_ord, {sql_clean("text")} AS t FROM documents)))
 WHERE (before < 700000 OR r = 1) AND n > 0)"""


@query("facts_mixture", f"SELECT source, row_key, running FROM {sql_budget(SQL_SATURATED, 700_000)}")
def facts_mixture(spark, sf):
    rows = table(spark, sf, "documents").select(
        F.lit("facts").alias("domain"), "source", c("doc_id").cast("string").alias("row_key"),
        F.substring("source", 4, 9).cast("int").alias("source_ord"), "doc_id",
        R.document_block(c("text"), 40).alias("block"),
    )
    read = M.saturating_budget(rows, 700_000, source_ord="source_ord", row_ord="doc_id")
    blocks = read.withColumn("weight", F.length("block").cast("bigint"))
    return M.char_budget(blocks, 700_000).select("source", "row_key", "running")


@query(
    "written_report",
    f"SELECT domain, source, count(*) AS examples, sum(length(block))::BIGINT AS chars FROM {sql_budget(SQL_MIX, BUDGET)} GROUP BY ROLLUP (domain, source)",
)
def written_report(spark, sf):
    """The report of a mixture, counted by the pass that writes it."""
    return sinks.write_reported(M.char_budget(mixed_blocks(spark, sf), BUDGET), scratch_path(spark, "mixture"), parts=4)


@query("write_corpus", f"SELECT rtrim(block, {NL}) AS block FROM {sql_budget(SQL_MIX, BUDGET)}")
def write_corpus(spark, sf):
    """Written as ordered text files and read back block by block."""
    path = scratch_path(spark, "mixture")
    sinks.write_corpus(M.char_budget(mixed_blocks(spark, sf), BUDGET), path, parts=4)
    return spark.read.text(path, lineSep="\n\n").withColumnRenamed("value", "block").filter(c("block") != "")
