"""The dealt operators as registered queries, with SQL twins where SQL can express them."""

from __future__ import annotations

from pyspark.sql import functions as F

from textmill.catalog.base import table
from textmill.llm import decontaminate, divergence, fim, forest, langid, minhash, mixing, packing, pii, quality, secrets, toxicity, warc
from textmill.llm.registry import query
from textmill.llm.sampling import remainder
from textmill.session import scratch_path

MIX_SQL = """
WITH n AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
t AS (SELECT sum(n) AS total, sum(n ** 0.5) AS w FROM n),
r AS (SELECT source, total * n ** 0.5 / w / n AS rate FROM n, t),
c AS (SELECT source, k, sum(exp(-rate + k * ln(rate) - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS cdf
      FROM r, range(0, 1000) AS g(k)),
u AS (SELECT *, ('0x' || substr(md5('mix:' || doc_id), 1, 13))::BIGINT / 4503599627370496.0 AS u FROM documents),
q AS (SELECT u.*, (SELECT count(*) FROM c WHERE c.source IS NOT DISTINCT FROM u.source AND c.cdf <= u.u) AS q FROM u)
SELECT doc_id, text, lang, source, n_chars, copy, md5('mix:' || doc_id || ':' || copy) AS shuffle_key
FROM (SELECT *, unnest(range(1, q + 1)) AS copy FROM q)
"""


@query("op8_mixing", MIX_SQL)
def op8(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    return mixing.replicate(docs, mixing.tempered_rates(docs))


def _base32(digest: str) -> str:
    parts = " || ".join(f"lpad(to_base(('0x' || substr({digest}, {1 + 5 * i}, 5))::BIGINT, 32), 4, '0')" for i in range(8))
    return f"translate({parts}, '{warc._DIGITS}', '{warc._BASE32}')"


WARC_SQL = f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
d AS (SELECT page_id, octet_length(body) AS payload_bytes, {_base32("sha1(body)")} AS payload_digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM f
"""


@query("op9_warc", WARC_SQL)
def op9(spark, folder):
    path = scratch_path(spark, "warc")
    warc.write_archives(warc.resolve(warc.headers_of(table(spark, folder, "pages"))), path)
    found = warc.follow_revisits(warc.read_archives(spark, path, payloads=False))
    return found.select(F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def _sql_kind(i: int, kind: str, pattern: str) -> str:
    p = "'" + pattern.replace("'", "''") + "'"
    value = f"regexp_extract(hit, {p}, 2)" if kind == "assign" else "hit"
    return f"""k{i} AS (SELECT doc_id, source, {i} AS rank, '{kind}' AS kind, sum(length(gap) + length(hit)) OVER
  (PARTITION BY doc_id ORDER BY n) AS stop, length(hit) AS size, {value} AS value
  FROM (SELECT doc_id, source, unnest(string_split_regex(text, {p})) AS gap, unnest(regexp_extract_all(text, {p}, 0)) AS hit,
        generate_subscripts(string_split_regex(text, {p}), 1) AS n FROM documents) WHERE hit IS NOT NULL)"""


SECRETS_SQL = f"""
WITH {", ".join(_sql_kind(i, k, p) for i, (k, p) in enumerate(secrets.KINDS.items()))},
a AS ({" UNION ALL ".join(f"SELECT * FROM k{i}" for i in range(len(secrets.KINDS)))}),
f AS (SELECT *, stop - size AS start FROM a WHERE kind <> 'assign' OR length(value) >= {secrets.MIN_ASSIGNED}),
o AS (SELECT value, count(DISTINCT source) + max((source IS NULL)::INT) AS owners, (SELECT count(*) FROM (SELECT DISTINCT doc_id, source FROM f g WHERE g.value = f.value)) AS repos
  FROM f GROUP BY value),
s AS (SELECT f.*, repos, owners <= {secrets.LIVE_OWNERS} AND repos <= {secrets.LIVE_REPOS} AS live FROM f JOIN o USING (value)),
g AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
  count(*) FILTER (kind = 'hex') AS n_hex,
  coalesce(string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) FILTER (rank < 3), '') AS base,
  coalesce(string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) FILTER (rank < 3 OR live), '') AS spans,
  count(*) FILTER (live) AS n_live, count(*) FILTER (NOT live AND rank < 3) AS n_copied, max(repos) FILTER (rank < 3 OR live) AS most_repos FROM s GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live,
  coalesce(n_copied, 0) AS n_copied, coalesce(most_repos, 0) AS most_repos
FROM documents LEFT JOIN g USING (doc_id)
"""


@query("op6_secrets", SECRETS_SQL)
def op6(spark, folder):
    return secrets.digest(secrets.scan(table(spark, folder, "documents")))


@query("op1_langid")
def op1(spark, folder):
    docs = table(spark, folder, "documents")
    held_out = remainder(F.col("doc_id"), 3) == 1
    model = langid.fit(docs.where(~held_out))
    found = langid.predict(docs, model)
    return found.select(F.col("key").alias("doc_id"), held_out_of("key", 3, 1), "lang_pred", "score", "bits_per_byte")


def held_out_of(key: str, modulus: int, fold: int):
    return (remainder(F.col(key), modulus) == fold).alias("held_out")


def _scored(found, modulus: int, fold: int):
    predicted = F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted")
    return found.select(F.col("key").alias("doc_id"), held_out_of("key", modulus, fold), "score", predicted)


@query("op3_toxicity")
def op3(spark, folder):
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = toxicity.fit(docs, labels.where(remainder(F.col("doc_id"), 3) != 1))
    return _scored(toxicity.predict(docs, model), 3, 1)


@query("op7_quality")
def op7(spark, folder):
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    forest = quality.fit(docs, labels.where(remainder(F.col("doc_id"), 4) != 2))
    return _scored(quality.predict(docs, forest), 4, 2)


@query("op4_fingerprints")
def op4(spark, folder):
    return minhash.compare_neighbours(table(spark, folder, "documents")).withColumnRenamed("key", "doc_id")


FOREST_SQL = """
WITH RECURSIVE w AS (SELECT doc_id, md5(coalesce(text, '')) AS t,
  list_filter(string_split_regex(coalesce(text, ''), '[ \\t\\n\\v\\f\\r]+'), lambda x: x <> '') AS w FROM documents),
c AS (SELECT t, min(doc_id) AS first, count(*) AS n_copies, any_value(w) AS w FROM w GROUP BY t),
s AS (SELECT DISTINCT first, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3),
  lambda i: array_to_string(w[i:i+4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM c),
n AS (SELECT first, count(*) AS n FROM s GROUP BY first),
p AS (SELECT a.first AS a, b.first AS b, count(*) AS shared FROM s a JOIN s b USING (g) WHERE a.first <> b.first GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.first = a JOIN n y ON y.first = b WHERE shared >= 0.8 * (x.n + y.n - shared) - 1e-9),
r AS (SELECT first AS id, first AS top FROM c UNION SELECT l.b, r.top FROM r JOIN l ON l.a = r.id),
k AS (SELECT id, min(top) AS class_id FROM r GROUP BY id),
d AS (SELECT a, count(*) AS n_links, sum(n_copies)::BIGINT AS n_link_docs FROM l JOIN c ON c.first = l.b GROUP BY a)
SELECT doc_id, class_id, first AS copy_of, n_copies, coalesce(n_links, 0) AS n_links, coalesce(n_link_docs, 0) AS n_link_docs
FROM w JOIN c USING (t) JOIN k ON k.id = first LEFT JOIN d ON d.a = first
"""


@query("op10_jaccard_join", FOREST_SQL)
def op10(spark, folder):
    return forest.similar_texts(table(spark, folder, "documents")).withColumnRenamed("key", "doc_id")


@query("op5_decontaminate")
def op5(spark, folder):
    found = decontaminate.find_passages(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.withColumnsRenamed({"key": "doc_id", "item": "item_id"})


@query("op2_pii")
def op2(spark, folder):
    docs = table(spark, folder, "documents")
    found = pii.scan(docs, pii.fit(docs))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")

    base = F.filter("spans", lambda s: s["base"])

    def n(kind):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [n(k) for k in pii.KINDS]
    n_added = (F.size("spans") - F.size(base)).cast("long").alias("n_added")
    return found.select(F.col("key").alias("doc_id"), *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"), n_added)


@query("op11_packing")
def op11(spark, folder):
    import public_tokenizers

    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        definition = f.read()
    found = packing.pack(table(spark, folder, "documents"), definition)
    return found.select(F.col("key").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def _sql_draw(i: int) -> str:
    return f"('0x' || substr(sha256('{fim.SEED}:' || coalesce(doc_id::VARCHAR, '')), {1 + 8 * i}, 8))::BIGINT"


FIM_SQL = f"""
WITH l AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS l,
  {", ".join(f"{_sql_draw(i)} AS h{i + 1}" for i in range(4))} FROM documents),
c AS (SELECT *, len(l) AS n, least(h1 % (len(l) + 1), h2 % (len(l) + 1)) AS a, greatest(h1 % (len(l) + 1), h2 % (len(l) + 1)) AS b FROM l),
p AS (SELECT *, array_to_string(l[1:a], '') AS prefix, array_to_string(l[a + 1:b], '') AS middle, array_to_string(l[b + 1:], '') AS suffix,
  CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= {fim.FIM_SHARE} THEN 'plain'
       WHEN h4 % 100 < {fim.SPM_SHARE} THEN 'spm' ELSE 'psm' END AS form FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
         ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(text) AS restored_sha256
FROM p
"""


@query("op12_fill_in_middle", FIM_SQL)
def op12(spark, folder):
    found = fim.transform(table(spark, folder, "documents"))
    return found.select(
        F.col("key").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256")
    )


def _sql_p(count: str, total: str) -> str:
    return f"(1 + {divergence.SCALE}::HUGEINT * ({count} + {divergence.ALPHA}) // ({total} + {divergence.ALPHA} * v))::BIGINT"


DIVERGENCE_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
o AS (SELECT id, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*) AS lang_n FROM o GROUP BY ALL HAVING count(DISTINCT id) >= {divergence.MIN_DOCS}),
v AS (SELECT lang, count(*) AS v, sum(lang_n) AS lang_total FROM k GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM o SEMI JOIN k USING (lang, term) GROUP BY ALL),
t AS (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL),
a AS (SELECT g.lang, g.source, k.term, coalesce(n, 0) AS n, {_sql_p("coalesce(n, 0)", "coalesce(total, 0)")} AS p, {_sql_p("lang_n", "lang_total")} AS q
  FROM g JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN t USING (lang, source) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
s AS (SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p))::BIGINT AS value FROM a x JOIN a y USING (lang, term) GROUP BY ALL),
r AS (SELECT g.lang, g.source, 'pair' AS part, h.source AS item, coalesce(value, 0) AS value FROM g JOIN g h ON h.lang = g.lang AND h.source <> g.source
    LEFT JOIN s ON s.lang = g.lang AND s.source = g.source AND s.item = h.source
  UNION ALL SELECT lang, source, 'term', term, p - q FROM a WHERE n > 0 AND p > q)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM r)
WHERE part = 'pair' OR rank <= {divergence.TOP_TERMS}
"""


@query("op13_source_divergence", DIVERGENCE_SQL)
def op13(spark, folder):
    return divergence.audit(table(spark, folder, "documents"))
