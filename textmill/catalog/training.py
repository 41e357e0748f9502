"""Splits, blocks, windows and next-token statistics over byte tokens."""

from __future__ import annotations

from pyspark.sql import functions as F

from textmill.catalog.base import query, table
from textmill.catalog.tokens import SQL_BYTES, byte_docs, sql_pairs
from textmill.functions import tokens as K
from textmill.operators import ngram as L
from textmill.operators import windows as B
from textmill.session import cut_lineage

BLOCK = 256
SEED = 18


def c(name):
    return F.col(name)


SQL_PLACED = f"(SELECT doc_id, x, length(x) AS n, (sum(length(x)) OVER (ORDER BY doc_id) - length(x))::BIGINT AS start FROM {SQL_BYTES})"
SQL_CUT = "(SELECT floor(sum(octet_length(encode(text))) * 0.9::DOUBLE)::BIGINT AS cut FROM documents)"
SQL_SPLIT = (
    "(SELECT doc_id, substr(x, 1, k) AS train, substr(x, k + 1) AS val FROM "
    f"(SELECT *, greatest(0, least(n, cut - start))::BIGINT AS k FROM {SQL_PLACED}, {SQL_CUT}))"
)


@query("split_tokens", f"SELECT doc_id, train, val FROM {SQL_SPLIT}")
def split_tokens(spark, sf):
    return B.split_tokens(byte_docs(spark, sf), "x", "doc_id")


SQL_BLOCKS = (
    "(SELECT block_id, string_agg(part, '' ORDER BY lo) AS tokens FROM (SELECT b AS block_id, greatest(b * 256, start) AS lo, "
    "substr(x, greatest(b * 256 - start, 0) + 1, least((b + 1) * 256, start + n) - greatest(b * 256, start)) AS part "
    f"FROM (SELECT *, unnest(range(start // 256, (start + n - 1) // 256 + 1)) AS b FROM {SQL_PLACED} WHERE n > 0)) GROUP BY block_id)"
)


@query("pack_blocks", f"SELECT block_id, length(tokens) AS n_tokens, tokens FROM {SQL_BLOCKS}")
def pack_blocks(spark, sf):
    return B.pack_blocks(byte_docs(spark, sf), "x", "doc_id", BLOCK)


SQL_STARTS = (
    "(SELECT block_id // 64 AS step, block_id % 64 AS slot, ('0x' || substr(md5('18:' || block_id // 64 || ':' || block_id % 64), 1, 15))::BIGINT "
    f"% (N - 257) AS start FROM blocks, (SELECT sum(length(tokens))::BIGINT AS N FROM blocks))"
)


@query(
    "sample_windows",
    f"WITH blocks AS MATERIALIZED {SQL_BLOCKS}, d AS {SQL_STARTS} SELECT step, slot, start, substr(t, start % 256 + 1, 256) AS x, substr(t, start % 256 + 2, 256) AS y FROM "
    "(SELECT d.*, a.tokens || coalesce(b.tokens, '') AS t FROM d JOIN blocks a ON a.block_id = d.start // 256 LEFT JOIN blocks b ON b.block_id = d.start // 256 + 1)",
)
def sample_windows(spark, sf):
    """As many draws as there are blocks: batches of 64 windows."""
    d = byte_docs(spark, sf)
    blocks = cut_lineage(B.pack_blocks(d, "x", "doc_id", BLOCK))
    n = B.total_tokens(blocks, "tokens")
    draws = blocks.select(F.floor(c("block_id") / 64).alias("step"), (c("block_id") % 64).alias("slot"))
    return B.sample_windows(blocks, n, BLOCK, seed=SEED, draws=draws)


SQL_DRAWS = (
    "(SELECT i // 32 AS step, i % 32 AS slot, ('0x' || substr(md5('18:' || i // 32 || ':' || i % 32), 1, 15))::BIGINT % (N - 257) AS start "
    "FROM range(40 * 32) AS r(i), (SELECT sum(length(tokens))::BIGINT AS N FROM blocks))"
)


@query(
    "sample_windows_steps",
    f"WITH blocks AS MATERIALIZED {SQL_BLOCKS}, d AS {SQL_DRAWS} SELECT step, slot, start, substr(t, start % 256 + 1, 256) AS x, substr(t, start % 256 + 2, 256) AS y FROM "
    "(SELECT d.*, a.tokens || coalesce(b.tokens, '') AS t FROM d JOIN blocks a ON a.block_id = d.start // 256 LEFT JOIN blocks b ON b.block_id = d.start // 256 + 1)",
)
def sample_windows_steps(spark, sf):
    """A training run of 40 steps with 32 windows each."""
    blocks = cut_lineage(B.pack_blocks(byte_docs(spark, sf), "x", "doc_id", BLOCK))
    n = B.total_tokens(blocks, "tokens")
    return B.sample_windows(blocks, n, BLOCK, seed=SEED, draws=B.draw_table(spark, 40, 32))


@query("shifted_targets", f"SELECT doc_id, substr(x, 1, length(x) - 1) AS inputs, substr(x, 2) AS targets FROM {SQL_BYTES}")
def shifted_targets(spark, sf):
    x, y = B.shifted_targets("x")
    return byte_docs(spark, sf).select("doc_id", x.alias("inputs"), y.alias("targets"))


@query("truncate_context", f"SELECT doc_id, right(x, 256) AS tokens FROM {SQL_BYTES}")
def truncate_context(spark, sf):
    return byte_docs(spark, sf).select("doc_id", K.last_tokens(c("x"), BLOCK).alias("tokens"))


# ---------------------------------------------------------------- next-token statistics


def model_and_split(spark, sf):
    parts = B.split_tokens(byte_docs(spark, sf), "x", "doc_id")
    return L.lm_fit(parts, "train", vocab_size=256), parts


SQL_COUNTS = "SELECT unicode(p)::INT AS ctx, unicode(substr(p, 2, 1))::INT AS nxt, count(*) AS n FROM {0} GROUP BY p"
SQL_FIT = (
    f"s AS MATERIALIZED {SQL_SPLIT}, "
    f"cnt AS MATERIALIZED ({SQL_COUNTS.format(sql_pairs('(SELECT doc_id, train AS x FROM s)'))}), "
    "model AS MATERIALIZED (SELECT *, ln((n + 1.0::DOUBLE) / (ctx_n + 256.0::DOUBLE)) AS logp FROM "
    "(SELECT *, (sum(n) OVER (PARTITION BY ctx))::BIGINT AS ctx_n FROM cnt))"
)


@query("lm_fit", f"WITH {SQL_FIT} SELECT ctx, nxt, n, ctx_n, round(logp, 9) AS logp FROM model")
def lm_fit(spark, sf):
    return model_and_split(spark, sf)[0].withColumn("logp", F.round("logp", 9))


def _sql_eval(part: str) -> str:
    return (
        f"SELECT '{part}' AS part, sum(m)::BIGINT AS n_pairs, round(sum(-coalesce(logp, ln(1.0::DOUBLE / (coalesce(ctx_n, 0) + 256.0::DOUBLE))) * m) / sum(m), 6) AS loss FROM "
        f"(SELECT ctx, nxt, n AS m FROM ({SQL_COUNTS.format(sql_pairs(f'(SELECT doc_id, {part} AS x FROM s)'))})) h "
        "LEFT JOIN (SELECT DISTINCT ctx, ctx_n FROM model) USING (ctx) LEFT JOIN (SELECT ctx, nxt, logp FROM model) USING (ctx, nxt)"
    )


@query("lm_eval", f"WITH {SQL_FIT} {_sql_eval('train')} UNION ALL {_sql_eval('val')}")
def lm_eval(spark, sf):
    model, parts = model_and_split(spark, sf)
    model = cut_lineage(model)
    out = [
        L.lm_eval(model, parts, p, vocab_size=256).select(F.lit(p).alias("part"), "n_pairs", F.round("loss", 6).alias("loss"))
        for p in ("train", "val")
    ]
    return out[0].unionByName(out[1])


SQL_TRIPLES = (
    "(SELECT substr(x, i, 2) AS ctx, unicode(substr(x, i + 2, 1))::INT AS nxt FROM (SELECT x, unnest(range(1, length(x) - 1)) AS i FROM {0}))"
)
SQL_FIT2 = (
    f"s AS MATERIALIZED {SQL_SPLIT}, model AS MATERIALIZED (SELECT *, ln((n + 1.0::DOUBLE) / (ctx_n + 256.0::DOUBLE)) AS logp FROM "
    "(SELECT *, (sum(n) OVER (PARTITION BY ctx))::BIGINT AS ctx_n FROM (SELECT ctx, nxt, count(*) AS n FROM "
    f"{SQL_TRIPLES.format('(SELECT train AS x FROM s)')} GROUP BY ALL)))"
)


@query("lm_fit_order2", f"WITH {SQL_FIT2} SELECT ctx, nxt, n, ctx_n, round(logp, 9) AS logp FROM model")
def lm_fit_order2(spark, sf):
    parts = B.split_tokens(byte_docs(spark, sf), "x", "doc_id")
    return L.lm_fit(parts, "train", vocab_size=256, order=2).withColumn("logp", F.round("logp", 9))


@query(
    "lm_eval_order2",
    f"WITH {SQL_FIT2} SELECT count(*) AS n_pairs, round(avg(-coalesce(logp, ln(1.0::DOUBLE / (coalesce(ctx_n, 0) + 256.0::DOUBLE)))), 6) AS loss FROM "
    f"{SQL_TRIPLES.format('(SELECT val AS x FROM s)')} LEFT JOIN (SELECT DISTINCT ctx, ctx_n FROM model) USING (ctx) LEFT JOIN (SELECT ctx, nxt, logp FROM model) USING (ctx, nxt)",
)
def lm_eval_order2(spark, sf):
    parts = B.split_tokens(byte_docs(spark, sf), "x", "doc_id")
    model = cut_lineage(L.lm_fit(parts, "train", vocab_size=256, order=2))
    return L.lm_eval(model, parts, "val", vocab_size=256, order=2).select("n_pairs", F.round("loss", 6).alias("loss"))


SQL_NEXT = (
    "nx AS MATERIALIZED (SELECT ctx, nxt, w / sum(w) OVER (PARTITION BY ctx) AS p FROM (SELECT *, exp((logp - max(logp) OVER (PARTITION BY ctx)) / {0}::DOUBLE) AS w FROM "
    "(SELECT * FROM (SELECT *, rank() OVER (PARTITION BY ctx ORDER BY logp DESC) AS r FROM model) WHERE r <= 40)))"
)


@query("lm_next", f"WITH {SQL_FIT}, {SQL_NEXT.format(0.3)} SELECT ctx, nxt, round(p, 9) AS p FROM nx")
def lm_next(spark, sf):
    return L.lm_next(model_and_split(spark, sf)[0]).withColumn("p", F.round("p", 9))


STEPS = 6
_SQL_GEN = []
for _k in range(1, STEPS + 1):
    _SQL_GEN.append(
        f"g{_k} AS MATERIALIZED (SELECT conv_id, turn, t || coalesce(chr(nxt), '') AS t FROM (SELECT conv_id, turn, t, "
        f"coalesce(min(nxt) FILTER (WHERE hi > u), max(nxt)) AS nxt FROM (SELECT *, ('0x' || substr(md5('18:' || conv_id || '-' || turn || ':{_k - 1}'), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u "
        f"FROM g{_k - 1}) q LEFT JOIN cum ON cum.ctx = unicode(right(t, 1)) GROUP BY conv_id, turn, t))"
    )


@query(
    "lm_generate",
    f"WITH {SQL_FIT}, {SQL_NEXT.format(1.0)}, cum AS MATERIALIZED (SELECT ctx, nxt, sum(p) OVER (PARTITION BY ctx ORDER BY nxt) AS hi FROM nx), "
    "g0 AS (SELECT conv_id, turn, array_to_string(list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda h: chr(('0x' || h)::INT)), '') AS t "
    f"FROM conversations WHERE text <> ''), {', '.join(_SQL_GEN)} SELECT conv_id, turn, t AS tokens FROM g{STEPS}",
)
def lm_generate(spark, sf):
    """All turns continued by a few tokens at temperature 1."""
    dist = L.lm_next(model_and_split(spark, sf)[0], temperature=1.0)
    said = table(spark, sf, "conversations").filter(c("text") != "")
    prompts = said.select(F.concat_ws("-", "conv_id", "turn").alias("k"), K.byte_tokens(c("text")).alias("t"))
    done = L.lm_generate(prompts, dist, key="k", tokens="t", steps=STEPS, seed=SEED)
    parts = F.split("k", "-")
    return done.select(parts[0].cast("bigint").alias("conv_id"), parts[1].cast(dict(said.dtypes)["turn"]).alias("turn"), "tokens")


def _sql_counts(k: int) -> str:
    return f"SELECT substr(x, i, {k}) AS ctx, unicode(substr(x, i + {k}, 1))::INT AS nxt FROM (SELECT x, unnest(range(1, length(x) - {k} + 1)) AS i FROM (SELECT train AS x FROM s))"


SQL_BACKOFF = (
    f"s AS MATERIALIZED {SQL_SPLIT}, model AS MATERIALIZED (SELECT *, ln((n + 1.0::DOUBLE) / (ctx_n + 256.0::DOUBLE)) AS logp FROM "
    f"(SELECT *, (sum(n) OVER (PARTITION BY ctx))::BIGINT AS ctx_n FROM (SELECT ctx, nxt, count(*) AS n FROM ({' UNION ALL '.join(map(_sql_counts, range(3)))}) GROUP BY ALL)))"
)
_SQL_GEN2 = []
for _k in range(1, STEPS + 1):
    _SQL_GEN2.append(
        f"g{_k} AS MATERIALIZED (SELECT conv_id, turn, t || coalesce(chr(nxt), '') AS t FROM (SELECT conv_id, turn, t, coalesce(min(nxt) FILTER (WHERE hi > u), max(nxt)) AS nxt FROM "
        f"(SELECT q.*, coalesce(b.ctx, a.ctx, '') AS state, ('0x' || substr(md5('18:' || conv_id || '-' || turn || ':{_k - 1}'), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u "
        f"FROM g{_k - 1} q LEFT JOIN seen b ON length(t) > 1 AND b.ctx = right(t, 2) LEFT JOIN seen a ON a.ctx = right(t, 1)) JOIN cum ON cum.ctx = state GROUP BY conv_id, turn, t))"
    )


@query(
    "lm_generate_order2",
    f"WITH {SQL_BACKOFF}, {SQL_NEXT.format(1.0)}, cum AS MATERIALIZED (SELECT ctx, nxt, sum(p) OVER (PARTITION BY ctx ORDER BY nxt) AS hi FROM nx), seen AS MATERIALIZED (SELECT DISTINCT ctx FROM nx), "
    "g0 AS (SELECT conv_id, turn, array_to_string(list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda h: chr(('0x' || h)::INT)), '') AS t "
    f"FROM conversations WHERE text <> ''), {', '.join(_SQL_GEN2)} SELECT conv_id, turn, t AS tokens FROM g{STEPS}",
)
def lm_generate_order2(spark, sf):
    """All turns continued at temperature 1 by the longest context of up to two tokens that the documents have."""
    parts = B.split_tokens(byte_docs(spark, sf), "x", "doc_id")
    dist = L.lm_next(L.backoff_fit(parts, "train", vocab_size=256, order=2), temperature=1.0)
    said = table(spark, sf, "conversations").filter(c("text") != "")
    prompts = said.select(F.concat_ws("-", "conv_id", "turn").alias("k"), K.byte_tokens(c("text")).alias("t"))
    done = L.backoff_generate(prompts, dist, key="k", tokens="t", order=2, steps=STEPS, seed=SEED)
    split = F.split("k", "-")
    return done.select(split[0].cast("bigint").alias("conv_id"), split[1].cast(dict(said.dtypes)["turn"]).alias("turn"), "tokens")
