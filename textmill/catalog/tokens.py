"""Characters, bytes, byte-pair tokens, and corpus measures."""

from __future__ import annotations

from pyspark.sql import functions as F

from textmill.catalog.base import query, table
from textmill.functions import tokens as K
from textmill.operators import bpe, chartok, stats
from textmill.session import scratch_path, spread_few
from textmill.sources import sinks
from textmill.sources import tokenizers as TS

N_MERGES = 8
MANY_MERGES = 512


def c(name):
    return F.col(name)


def docs(spark, sf):
    return spread_few(table(spark, sf, "documents").select("doc_id", "text"), "doc_id")


def trained(spark, sf, merges=N_MERGES):
    """A tokenizer of a few merges learned from the documents."""
    size = bpe.BYTES + merges + len(bpe.SPECIALS)
    return bpe.bpe_train(docs(spark, sf), "text", "doc_id", vocab_size=size)


def worded(spark, sf):
    """A tokenizer of the default size, of the documents' most frequent words with the blank before them."""
    word = F.explode(F.regexp_extract_all("text", F.lit(r" ?[^\s]+"), F.lit(0))).alias("w")
    counts = table(spark, sf, "documents").select(word).groupBy("w").count().orderBy(F.desc("count"), "w")
    tok = bpe.word_tokenizer([r["w"] for r in counts.limit(bpe.VOCAB_SIZE).collect()])
    return bpe.make_tokenizer(tok.merges[: bpe.VOCAB_SIZE - bpe.BYTES - len(bpe.SPECIALS)])


# ---------------------------------------------------------------- SQL fragments

SQL_BYTES = (
    "(SELECT doc_id, text, coalesce(array_to_string(list_transform(regexp_extract_all(hex(encode(text)), '..'), "
    "lambda h: chr(('0x' || h)::INT)), ''), '') AS x FROM documents)"
)


def sql_pairs(source: str) -> str:
    """Neighbours of token strings, one row each: doc_id, pos, p."""
    return (
        f"(SELECT doc_id, unnest(range(1, len(l))) AS pos, unnest(list_transform(range(1, len(l)), lambda i: l[i] || l[i + 1])) AS p "
        f"FROM (SELECT doc_id, regexp_extract_all(x, '(?s).') AS l FROM {source}))"
    )


def sql_training(n: int) -> str:
    """CTEs t0..tn of token strings and p1..pn of chosen pairs."""
    parts = [f"t0 AS MATERIALIZED (SELECT doc_id, text, x FROM {SQL_BYTES})"]
    for k in range(1, n + 1):
        parts.append(
            f"p{k} AS MATERIALIZED (SELECT p, count(*) AS n, min(doc_id * 100000000 + pos) AS first FROM {sql_pairs(f't{k - 1}')} "
            f"GROUP BY p ORDER BY n DESC, first LIMIT 1)"
        )
        parts.append(f"t{k} AS MATERIALIZED (SELECT doc_id, text, replace(x, p, chr({255 + k})) AS x FROM t{k - 1}, p{k})")
    return "WITH " + ", ".join(parts)


SQL_LOG = " UNION ALL ".join(
    f"SELECT {k} AS step, unicode(p)::INT AS left_id, unicode(substr(p, 2, 1))::INT AS right_id, n AS frequency, "
    f"(SELECT sum(length(x))::BIGINT FROM t{k}) AS tokens_left FROM p{k}"
    for k in range(1, N_MERGES + 1)
)
SQL_ENCODED = f"{sql_training(N_MERGES)} "
LAST = f"t{N_MERGES}"


# ---------------------------------------------------------------- measures


@query(
    "corpus_size",
    "SELECT count(*) AS n_rows, sum(length(text))::BIGINT AS n_chars, sum(octet_length(encode(text)))::BIGINT AS n_bytes, "
    "sum(octet_length(encode(text))) / 1048576.0::DOUBLE AS mib FROM documents",
)
def corpus_size(spark, sf):
    return stats.corpus_size(docs(spark, sf), "text")


SQL_VOCAB = "(SELECT ch, (row_number() OVER (ORDER BY unicode(ch)) - 1)::INT AS id FROM (SELECT DISTINCT unnest(regexp_extract_all(text, '(?s).')) AS ch FROM documents))"


@query("char_vocab", f"SELECT ch, id FROM {SQL_VOCAB}")
def char_vocab(spark, sf):
    return chartok.char_vocab(docs(spark, sf), "text")


@query(
    "char_encode",
    f"WITH v AS (SELECT map_from_entries(list(ROW(ch, id))) AS m FROM {SQL_VOCAB}) SELECT doc_id, md5(array_to_string("
    "list_transform(regexp_extract_all(text, '(?s).'), lambda ch: m[ch]::VARCHAR), ' ')) AS ids FROM documents, v",
)
def char_encode(spark, sf):
    d = docs(spark, sf)
    tok = chartok.CharTokenizer.of(chartok.char_vocab(d, "text"))
    ids = tok.encode(c("text"))
    return d.select("doc_id", F.md5(F.array_join(ids.cast("array<string>"), " ")).alias("ids"))


@query("char_decode", "SELECT doc_id, text FROM documents")
def char_decode(spark, sf):
    d = docs(spark, sf)
    tok = chartok.CharTokenizer.of(chartok.char_vocab(d, "text"))
    encoded = d.select("doc_id", tok.encode(c("text")).alias("t"))
    return encoded.select("doc_id", tok.decode(c("t")).alias("text"))


@query(
    "byte_ids",
    "SELECT doc_id, octet_length(encode(text)) AS n, array_to_string(list_transform(regexp_extract_all(hex(encode(text)), '..'), "
    "lambda h: (('0x' || h)::INT)::VARCHAR), ' ') AS ids FROM documents",
)
def byte_ids(spark, sf):
    ids = K.token_ids(K.byte_tokens(c("text")))
    return docs(spark, sf).select(
        "doc_id", F.octet_length("text").alias("n"), F.array_join(ids.cast("array<string>"), " ").alias("ids")
    )


def byte_docs(spark, sf):
    return docs(spark, sf).select("doc_id", "text", K.byte_tokens(c("text")).alias("x"))


@query(
    "pair_counts",
    f"SELECT unicode(p)::INT AS a, unicode(substr(p, 2, 1))::INT AS b, count(*) AS n FROM {sql_pairs(SQL_BYTES)} GROUP BY p",
)
def pair_counts(spark, sf):
    return bpe.pair_counts(byte_docs(spark, sf), "x")


@query("top_pair", f"{sql_training(1)} SELECT unicode(p)::INT AS a, unicode(substr(p, 2, 1))::INT AS b, n FROM p1")
def top_pair(spark, sf):
    """The most frequent pair; among equals the one met first."""
    pair, n = bpe.top_pairs(byte_docs(spark, sf), "x", "doc_id")[0]
    return spark.createDataFrame([(ord(pair[0]), ord(pair[1]), n)], "a int, b int, n bigint")


@query("merge_pair", f"SELECT doc_id, replace(x, 'th', chr(256)) AS x FROM {SQL_BYTES}")
def merge_pair(spark, sf):
    return byte_docs(spark, sf).select("doc_id", F.replace("x", F.lit("th"), F.lit(K.char_of(256))).alias("x"))


@query("bpe_train", f"{SQL_ENCODED} {SQL_LOG}")
def bpe_train(spark, sf):
    return training_log(spark, trained(spark, sf))


def training_log(spark, tok):
    return spark.createDataFrame(tok.log, "step int, left_id int, right_id int, frequency bigint, tokens_left bigint")


@query("bpe_train_large")
def bpe_train_large(spark, sf):
    """Far more merges than SQL can spell out; unit tests compare them with a plain loop."""
    return training_log(spark, trained(spark, sf, MANY_MERGES))


@query("bpe_encode", f"{SQL_ENCODED} SELECT doc_id, length(x) AS n_tokens, x AS tokens FROM {LAST}")
def bpe_encode(spark, sf):
    encoded = docs(spark, sf).select("doc_id", bpe.encode_text(c("text"), trained(spark, sf)).alias("tokens"))
    return encoded.select("doc_id", F.length("tokens").cast("bigint").alias("n_tokens"), "tokens")


@query(
    "compression",
    f"{SQL_ENCODED} SELECT sum(length(text))::BIGINT AS n_chars, sum(length(x))::BIGINT AS n_tokens, "
    f"round(sum(length(text))::DOUBLE / sum(length(x)), 9) AS chars_per_token FROM {LAST}",
)
def compression(spark, sf):
    tok = trained(spark, sf)
    out = stats.compression(docs(spark, sf), "text", bpe.encode_text(c("text"), tok))
    return out.withColumn("chars_per_token", F.round("chars_per_token", 9))


def marked(spark, sf):
    """Documents with literal special tokens put between their lines."""
    return docs(spark, sf).select("doc_id", F.replace("text", F.lit("\n"), F.lit("<EOS>")).alias("text"))


@query(
    "encode_specials",
    "SELECT doc_id, (length(text) - length(replace(text, chr(10), '')))::BIGINT AS n_eos, replace(text, chr(10), '') AS text FROM documents",
)
def encode_specials(spark, sf):
    tok = trained(spark, sf)
    eos = K.char_of(tok.specials["<EOS>"])
    rows = marked(spark, sf).select("doc_id", bpe.encode_with_specials(c("text"), tok).alias("t"))
    n = F.length("t") - F.length(F.replace("t", F.lit(eos), F.lit("")))
    return rows.select("doc_id", n.cast("bigint").alias("n_eos"), bpe.decode_tokens(c("t"), tok).alias("text"))


@query("add_bos_eos", f"{SQL_ENCODED} SELECT doc_id, chr({256 + N_MERGES + 2}) || x || chr({256 + N_MERGES + 3}) AS tokens FROM {LAST}")
def add_bos_eos(spark, sf):
    tok = trained(spark, sf)
    return docs(spark, sf).select("doc_id", bpe.with_bos_eos(bpe.encode_text(c("text"), tok), tok).alias("tokens"))


@query("bpe_decode", "SELECT doc_id, text FROM documents")
def bpe_decode(spark, sf):
    tok = trained(spark, sf)
    encoded = docs(spark, sf).select("doc_id", bpe.encode_text(c("text"), tok).alias("t"))
    return encoded.select("doc_id", bpe.decode_tokens(c("t"), tok).alias("text"))


@query("bpe_decode_large", "SELECT doc_id, text FROM documents")
def bpe_decode_large(spark, sf):
    """Encoded and decoded at the default vocabulary size."""
    tok = worded(spark, sf)
    encoded = docs(spark, sf).select("doc_id", bpe.encode_text(c("text"), tok).alias("t"))
    return encoded.select("doc_id", bpe.decode_tokens(c("t"), tok).alias("text"))


@query("bpe_encode_large")
def bpe_encode_large(spark, sf):
    """Token ids at the default vocabulary size; unit tests compare them with a plain loop."""
    tok = worded(spark, sf)
    encoded = docs(spark, sf).select("doc_id", bpe.encode_text(c("text"), tok).alias("tokens"))
    return encoded.select("doc_id", F.length("tokens").cast("bigint").alias("n_tokens"), "tokens")


@query("round_trip_large", "SELECT 0 AS failures, count(*) AS n_rows FROM documents")
def round_trip_large(spark, sf):
    failed = bpe.round_trip_failures(docs(spark, sf), "text", worded(spark, sf)).agg(F.count("*").alias("failures"))
    return failed.select("failures", table(spark, sf, "documents").agg(F.count("*")).scalar().alias("n_rows"))


@query("decode_join", "SELECT doc_id, md5(text) AS h FROM documents")
def decode_join(spark, sf):
    """Ids to bytes by the vocabulary table instead of a literal array."""
    return decoded_by_table(spark, sf, trained(spark, sf))


@query("decode_join_large", "SELECT doc_id, md5(text) AS h FROM documents")
def decode_join_large(spark, sf):
    return decoded_by_table(spark, sf, worded(spark, sf))


def decoded_by_table(spark, sf, tok):
    """Encoded by the tokenizer, decoded by its vocabulary table alone."""
    encoded = docs(spark, sf).select("doc_id", bpe.encode_text(c("text"), tok).alias("t"))
    return encoded.select("doc_id", F.md5(bpe.decode_by_table(c("t"), tok.tables(spark)[0])).alias("h"))


@query(
    "present_pairs",
    f"{SQL_ENCODED}, m AS ({SQL_LOG}), c AS (SELECT unicode(p)::INT AS a, unicode(substr(p, 2, 1))::INT AS b, count(*) AS n FROM {sql_pairs('t0')} GROUP BY p) "
    'SELECT (step - 1)::INT AS rank, a AS "left", b AS "right", n FROM m JOIN c ON left_id = a AND right_id = b',
)
def present_pairs(spark, sf):
    merges = trained(spark, sf).tables(spark)[1]
    return bpe.present_pairs(byte_docs(spark, sf), "x", merges)


@query("round_trip", "SELECT 0 AS failures, count(*) AS n_rows FROM documents")
def round_trip(spark, sf):
    failed = bpe.round_trip_failures(docs(spark, sf), "text", trained(spark, sf)).agg(F.count("*").alias("failures"))
    return failed.select("failures", table(spark, sf, "documents").agg(F.count("*")).scalar().alias("n_rows"))


@query(
    "vocab_info",
    f"{SQL_ENCODED}, n AS (SELECT count(*) AS m FROM ({SQL_LOG})) SELECT 'bpe_vocab_size' AS item, 256 + m AS value FROM n UNION ALL SELECT 'merges', m FROM n "
    "UNION ALL SELECT 'specials', 4 UNION ALL SELECT 'vocab_size', 260 + m FROM n UNION ALL SELECT '<PAD>', 256 + m FROM n UNION ALL SELECT '<UNK>', 257 + m FROM n "
    "UNION ALL SELECT '<BOS>', 258 + m FROM n UNION ALL SELECT '<EOS>', 259 + m FROM n",
)
def vocab_info(spark, sf):
    """Sizes of the learned tokenizer's tables, and its special ids."""
    tok = trained(spark, sf)
    vocab, merges, specials = tok.tables(spark)
    counts = [
        df.agg(F.count("*").alias("value")).select(F.lit(name).alias("item"), c("value").cast("bigint"))
        for name, df in (("bpe_vocab_size", vocab), ("merges", merges), ("specials", specials))
    ]
    ids = specials.select(c("token").alias("item"), c("id").cast("bigint").alias("value"))
    total = spark.createDataFrame([("vocab_size", tok.vocab_size)], "item string, value bigint")
    return counts[0].unionByName(counts[1]).unionByName(counts[2]).unionByName(total).unionByName(ids)


@query("save_tokenizer", f"{SQL_ENCODED} SELECT step - 1 AS rank, left_id, right_id FROM ({SQL_LOG})")
def save_tokenizer(spark, sf):
    """Saved as a JSON artifact and read back: the merges."""
    path = scratch_path(spark, "tokenizer")
    TS.save_tokenizer(spark, trained(spark, sf), path)
    doc = spark.read.schema(TS.SCHEMA).json(path, multiLine=True)
    return TS.tokenizer_tables(doc)[1].select("rank", c("left").alias("left_id"), c("right").alias("right_id"))


@query("load_tokenizer", f"{SQL_ENCODED} SELECT doc_id, x AS tokens FROM {LAST}")
def load_tokenizer(spark, sf):
    """The documents encoded by a tokenizer that was saved and loaded."""
    path = scratch_path(spark, "tokenizer")
    TS.save_tokenizer(spark, trained(spark, sf), path)
    tok = TS.load_tokenizer(spark, path)
    return docs(spark, sf).select("doc_id", bpe.encode_text(c("text"), tok).alias("tokens"))


@query(
    "detect_tokenizer",
    f"SELECT 'char' AS kind, count(*)::INT AS vocab_size FROM {SQL_VOCAB} UNION ALL SELECT 'subword', {bpe.BYTES + N_MERGES + 4}",
)
def detect_tokenizer(spark, sf):
    """Both kinds of artifacts made from the documents, written below one folder and told apart."""
    root = scratch_path(spark, "artifacts")
    TS.save_tokenizer(spark, trained(spark, sf), f"{root}/bpe")
    chars = chartok.char_vocab(docs(spark, sf), "text")
    TS.char_json(chars).coalesce(1).write.text(f"{root}/char")
    return TS.detect_tokenizers(spark, root).select("kind", "vocab_size")


@query(
    "tokenise_report",
    f"{SQL_ENCODED} SELECT count(*) AS n_rows, sum(length(text))::BIGINT AS n_chars, sum(length(x))::BIGINT AS n_tokens, true AS timed FROM {LAST}",
)
def tokenise_report(spark, sf):
    """Encoding the documents: rows, characters and tokens counted by the pass that writes the ids, which also gives the rate."""
    tok = trained(spark, sf)
    ids = docs(spark, sf).select("doc_id", F.length("text").alias("n"), bpe.encode_text(c("text"), tok).alias("tokens"))
    path = scratch_path(spark, "ids")
    done = sinks.observed(
        ids, lambda df: df.select("doc_id", "tokens").write.parquet(path),
        n_rows=F.count("*"), n_chars=F.coalesce(F.sum("n"), F.lit(0)), n_tokens=F.coalesce(F.sum(F.length("tokens")), F.lit(0)),
    )
    row = (*(done.metrics[k] for k in ("n_rows", "n_chars", "n_tokens")), done.rate("n_tokens") > 0 or not done.metrics["n_tokens"])
    return spark.createDataFrame([row], "n_rows long, n_chars long, n_tokens long, timed boolean")


@query(
    "preflight_failing",
    "SELECT cut, n_rows, n_tokens, floor(n_tokens * 0.9::DOUBLE)::BIGINT AS n_train, (n_tokens - floor(n_tokens * 0.9::DOUBLE))::BIGINT AS n_val, "
    "concat_ws('; ', CASE WHEN n_tokens = 0 THEN 'the corpus has no tokens' END, CASE WHEN floor(n_tokens * 0.9::DOUBLE) <= n_tokens // 2 + cut THEN 'the training part is not longer than a block' END, "
    "CASE WHEN n_tokens - floor(n_tokens * 0.9::DOUBLE) <= n_tokens // 2 + cut THEN 'the validation part is not longer than a block' END) AS errors, false AS ok "
    "FROM (SELECT 0 AS cut, count(*) AS n_rows, sum(octet_length(encode(text)))::BIGINT AS n_tokens FROM documents UNION ALL SELECT 1, count(*), 0 FROM documents)",
)
def preflight_failing(spark, sf):
    """Two corpora that cannot be trained on: a block of half the documents' tokens, and documents without a token."""
    rows = byte_docs(spark, sf)
    n = rows.agg(F.sum(F.length("x"))).first()[0]
    long = stats.preflight(rows, "x", block_size=n // 2).withColumn("cut", F.lit(0))
    return long.unionByName(stats.preflight(rows.withColumn("x", F.lit("")), "x", block_size=1).withColumn("cut", F.lit(1)))


@query(
    "preflight",
    "SELECT n_rows, n_tokens, floor(n_tokens * 0.9::DOUBLE)::BIGINT AS n_train, (n_tokens - floor(n_tokens * 0.9::DOUBLE))::BIGINT AS n_val, '' AS errors, true AS ok "
    "FROM (SELECT count(*) AS n_rows, sum(octet_length(encode(text)))::BIGINT AS n_tokens FROM documents)",
)
def preflight(spark, sf):
    return stats.preflight(byte_docs(spark, sf), "x", block_size=256)
