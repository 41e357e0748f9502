"""Sources, cleaning and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from textmill.catalog.base import NL, query, sql_clean, table
from textmill.functions import render as R
from textmill.functions import text as X
from textmill.session import scratch_path
from textmill.sources import readers as S

# The first line of a document stands for its title.
SQL_TITLE = f"string_split(text, {NL})[1]"


def titled_documents(spark, sf):
    return table(spark, sf, "documents").withColumn("title", F.split("text", "\n")[0])


@query("read_source", "SELECT doc_id, source, n_chars FROM documents")
def read_source(spark, sf):
    registry = {"docs": S.Source(f"{sf}/documents.parquet")}
    return S.read_source(spark, registry, "docs").select("doc_id", "source", "n_chars")


def documents_by_split(spark, sf):
    """Three splits of the documents, written and read as a source with splits."""
    docs = table(spark, sf, "documents")
    frames = {n: docs.filter(F.col("doc_id") % 3 == i) for i, n in enumerate(("train", "validation", "test"))}
    return S.union_splits(frames)


SQL_SPLITS = (
    "(SELECT *, doc_id % 3 AS split_ord, CASE doc_id % 3 WHEN 0 THEN 'train' WHEN 1 THEN 'validation' ELSE 'test' END AS split "
    "FROM documents)"
)


@query("all_splits", f"SELECT doc_id, split, split_ord::INT AS split_ord FROM {SQL_SPLITS}")
def all_splits(spark, sf):
    return documents_by_split(spark, sf).select("doc_id", "split", "split_ord")


@query("one_split", f"SELECT doc_id, text FROM {SQL_SPLITS} WHERE split = 'train'")
def one_split(spark, sf):
    return S.one_split(documents_by_split(spark, sf), "train").select("doc_id", "text")


@query(
    "skip_missing_source",
    "SELECT 'read' AS status, 'docs' AS source, count(*) AS n_rows FROM documents UNION ALL SELECT 'skipped', 'absent', 0",
)
def skip_missing_source(spark, sf):
    registry = {"docs": S.Source(f"{sf}/documents.parquet"), "absent": S.Source(f"{sf}/no_such_table.parquet")}
    frames, status = S.read_all(spark, registry, ["docs", "absent"])
    counts = None
    for name, df in frames.items():
        c = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("source"), "n")
        counts = c if counts is None else counts.unionByName(c)
    return status.join(counts, "source", "left").select("status", "source", F.coalesce("n", F.lit(0)).alias("n_rows"))


@query("read_corpus", "SELECT count(*) AS n_lines, sum(length(text))::BIGINT AS n_chars FROM (SELECT unnest(string_split(text, chr(10))) AS text FROM documents)")
def read_corpus(spark, sf):
    """Documents written as text files, read back line by line and counted."""
    path = scratch_path(spark, "corpus")
    table(spark, sf, "documents").select("text").write.text(path)
    lines = S.read_corpus(spark, path, "\n")
    return lines.agg(F.count("*").alias("n_lines"), F.sum(F.length("value")).alias("n_chars"))


@query("clean_text", f"SELECT doc_id, {sql_clean('text')} AS clean FROM documents")
def clean_text(spark, sf):
    return table(spark, sf, "documents").select("doc_id", X.clean_text(F.col("text")).alias("clean"))


@query("clean_pages", f"SELECT page_id, {sql_clean('html')} AS clean FROM pages")
def clean_pages(spark, sf):
    return table(spark, sf, "pages").select("page_id", X.clean_text(F.col("html")).alias("clean"))


@query("required_fields", f"SELECT doc_id, title FROM (SELECT doc_id, text, {SQL_TITLE} AS title FROM documents) WHERE title <> '' AND text <> ''")
def required_fields(spark, sf):
    return titled_documents(spark, sf).filter(X.required(F.col("title"), F.col("text"))).select("doc_id", "title")


@query("min_length", f"SELECT doc_id, length(c) AS n FROM (SELECT doc_id, {sql_clean('text')} AS c FROM documents) WHERE length(c) >= 200")
def min_length(spark, sf):
    long = X.let(X.clean_text(F.col("text")), lambda t: F.when(X.min_length(t, 200), F.length(t).cast("bigint")))
    return X.non_null(table(spark, sf, "documents"), "doc_id", n=long)


@query("truncate_clean", f"SELECT doc_id, {sql_clean('substr(c, 1, 4000)')} AS cut FROM (SELECT doc_id, {sql_clean('text')} AS c FROM documents)")
def truncate_clean(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", X.truncate_clean(X.clean_text(F.col("text")), 4000).alias("cut")
    )


@query("lang_filter", "SELECT doc_id, text FROM documents WHERE lang = 'en'")
def lang_filter(spark, sf):
    return table(spark, sf, "documents").filter(F.col("lang") == "en").select("doc_id", "text")


@query("role_filter", "SELECT conv_id, turn, text FROM conversations WHERE role IN ('user', 'assistant')")
def role_filter(spark, sf):
    return table(spark, sf, "conversations").filter(F.col("role").isin("user", "assistant")).select("conv_id", "turn", "text")


@query("label_filter", "SELECT d.doc_id, d.source, l.quality FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality = 1")
def label_filter(spark, sf):
    labels = table(spark, sf, "labels").filter(F.col("quality") == 1)
    return table(spark, sf, "documents").join(labels, "doc_id").select("doc_id", "source", "quality")


# Syllables of the invented prose, so that the filter has something to find.
TERMS = ["thes", "onn", "atio", "quantum", "ell"]


@query(
    "keyword_any",
    f"SELECT doc_id, title FROM (SELECT doc_id, {SQL_TITLE} AS title FROM documents) WHERE "
    + " OR ".join(f"contains(lower(title), '{t}')" for t in TERMS),
)
def keyword_any(spark, sf):
    return titled_documents(spark, sf).filter(X.contains_any(F.col("title"), TERMS)).select("doc_id", "title")


@query(
    "science_terms",
    "SELECT doc_id FROM (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN text || ' Quantum ' || lang WHEN doc_id % 7 = 0 THEN 'PHYSICS' || text ELSE text END AS text FROM documents) WHERE "
    + " OR ".join(f"contains(lower(text), '{t}')" for t in R.SCIENCE_TERMS),
)
def science_terms(spark, sf):
    """Terms in any case, within words too; some documents are given one."""
    text, key = F.col("text"), F.col("doc_id")
    some = F.when(key % 5 == 0, F.concat(text, F.lit(" Quantum "), "lang")).when(key % 7 == 0, F.concat(F.lit("PHYSICS"), text)).otherwise(text)
    return table(spark, sf, "documents").filter(X.contains_any(some, R.SCIENCE_TERMS)).select("doc_id")


@query(
    "first_nonempty",
    "SELECT p_partkey, coalesce(nullif(CASE WHEN p_size % 3 = 0 THEN '' ELSE p_name END, ''), "
    "nullif(CASE WHEN p_size % 2 = 0 THEN NULL ELSE p_brand END, ''), nullif(p_type, '')) AS v FROM part",
)
def first_nonempty(spark, sf):
    name = F.when(F.col("p_size") % 3 == 0, "").otherwise(F.col("p_name"))
    brand = F.when(F.col("p_size") % 2 != 0, F.col("p_brand"))
    return table(spark, sf, "part").select("p_partkey", X.first_nonempty(name, brand, F.col("p_type")).alias("v"))


@query(
    "nested_first",
    "SELECT p_partkey, CASE WHEN p_size % 4 > 0 THEN p_brand END AS first_answer, p_type AS answer_value FROM part",
)
def nested_first(spark, sf):
    names = F.slice(F.array("p_brand", "p_type", "p_name"), F.lit(1), F.col("p_size") % 4)
    nested = table(spark, sf, "part").select(
        "p_partkey", F.struct(names.alias("text")).alias("answers"), F.struct(F.col("p_type").alias("value")).alias("answer")
    )
    return nested.select(
        "p_partkey", F.get("answers.text", F.lit(0)).alias("first_answer"), F.col("answer.value").alias("answer_value")
    )


@query(
    "map_speaker",
    "SELECT conv_id, turn, CASE WHEN role = 'user' THEN 'User' ELSE 'Assistant' END AS speaker, "
    "CASE WHEN role = 'user' THEN 'User' WHEN role = 'assistant' THEN 'Assistant' END AS strict_speaker, "
    "'Person' || turn AS person FROM conversations",
)
def map_speaker(spark, sf):
    role = F.col("role")
    return table(spark, sf, "conversations").select(
        "conv_id", "turn", X.speaker_of(role, user="user").alias("speaker"),
        X.speaker_of(role, user="user", other="assistant").alias("strict_speaker"), X.person(F.col("turn")).alias("person"),
    )


@query(
    "title_text",
    "SELECT page_id, CASE WHEN title IS NULL OR title = '' THEN html ELSE title || chr(10) || html END AS text "
    "FROM (SELECT page_id, html, CASE WHEN page_id % 4 = 0 THEN NULL WHEN page_id % 4 = 1 THEN '' ELSE url END AS title FROM pages)",
)
def title_text(spark, sf):
    n = F.col("page_id") % 4
    title = F.when(n == 1, "").when(n > 1, F.col("url"))
    return table(spark, sf, "pages").select("page_id", X.titled(title, F.col("html")).alias("text"))


@query(
    "join_list",
    "SELECT p_partkey, p_brand || ' ' || p_type AS spaced, p_brand || ', ' || p_type || ', ' || p_name AS listed FROM part",
)
def join_list(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", F.array_join(F.array("p_brand", "p_type"), " ").alias("spaced"),
        F.array_join(F.array("p_brand", "p_type", "p_name"), ", ").alias("listed"),
    )


