"""Tokenizer artifacts: JSON documents in, JSON documents out, detection of their kind."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.operators.bpe import Tokenizer

# The artifact's type name and the versions that can be read.
BPE_TYPE = "byte_bpe"
VERSIONS = (1, 2)

SCHEMA = (
    "type string, version int, vocab_size int, vocab map<string,array<int>>, "
    "merges array<array<int>>, special_tokens map<string,int>"
)


def tokenizer_json(tok: Tokenizer) -> str:
    """The artifact document, version 2; ``vocab_size`` counts the special tokens too."""
    return json.dumps({
        "type": BPE_TYPE, "version": 2, "vocab_size": tok.vocab_size,
        "vocab": {str(i): list(b) for i, b in tok.vocab.items()},
        "merges": [list(p) for p in tok.merges], "special_tokens": tok.specials,
    })


def save_tokenizer(spark: SparkSession, tok: Tokenizer, path: str) -> None:
    """Write the artifact as one JSON file; its size is bounded by the vocabulary."""
    one = spark.createDataFrame([(tokenizer_json(tok),)], "value string").coalesce(1)
    one.write.mode("overwrite").text(path)


def tokenizer_tables(doc: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Vocabulary, merges and special tokens of parsed artifact documents."""
    vocab = doc.select(F.explode("vocab").alias("k", "v")).select(
        F.col("k").cast("int").alias("id"),
        F.unhex(F.array_join(F.transform("v", lambda b: F.lpad(F.hex(b), 2, "0")), "")).alias("bytes"),
    )
    merges = doc.select(F.posexplode("merges").alias("rank", "p")).select(
        "rank", F.col("p")[0].alias("left"), F.col("p")[1].alias("right")
    )
    return vocab, merges, doc.select(F.explode("special_tokens").alias("token", "id"))


def load_tokenizer(spark: SparkSession, path: str) -> Tokenizer:
    """Read an artifact of version 1 (no special tokens) or 2; anything else is an error."""
    doc = spark.read.schema(SCHEMA).json(path, multiLine=True)
    head = doc.select("type", "version").head(2)
    if len(head) != 1 or head[0]["type"] != BPE_TYPE:
        raise ValueError(f"{path} is not a {BPE_TYPE} tokenizer")
    if head[0]["version"] not in VERSIONS:
        raise ValueError(f"tokenizer version {head[0]['version']} is not supported")
    vocab, merges, specials = tokenizer_tables(doc)
    # All three are bounded by the vocabulary size.
    return Tokenizer(
        [(r["left"], r["right"]) for r in merges.orderBy("rank").collect()],
        {r["id"]: bytes(r["bytes"]) for r in vocab.orderBy("id").collect()},
        {r["token"]: r["id"] for r in specials.collect()},
    )


def detect_tokenizers(spark: SparkSession, path: str) -> DataFrame:
    """``(path, kind, vocab_size)`` of every artifact below a path, one row per file.

    Merges or a vocabulary make it subword, a character table char, a model part subword too.
    """
    raw = spark.read.text(path, wholetext=True, recursiveFileLookup=True).select(
        F.col("_metadata.file_path").alias("path"), "value"
    )
    return raw.select("path", *detected(F.col("value")))


def detected(value):
    part = lambda name: F.get_json_object(value, f"$.{name}")
    kind = (
        F.when(part("merges").isNotNull() | part("vocab").isNotNull(), "subword")
        .when(part("stoi").isNotNull(), "char")
        .when(part("model").isNotNull(), "subword")
        .otherwise(F.lit("unknown"))
    )
    keys = lambda name: F.size(F.from_json(part(name), "map<string,string>"))
    size = F.coalesce(part("vocab_size").cast("int"), keys("vocab"), keys("stoi"), F.lit(0))
    return kind.alias("kind"), size.alias("vocab_size")


def char_table(spark: SparkSession, path: str) -> DataFrame:
    """``(ch, id)`` of a character tokenizer artifact."""
    doc = spark.read.schema("stoi map<string,int>").json(path, multiLine=True)
    return doc.select(F.explode("stoi").alias("ch", "id"))


def char_json(vocab: DataFrame) -> DataFrame:
    """The artifact of a character vocabulary as one JSON value."""
    entries = F.map_from_entries(F.collect_list(F.struct("ch", "id")))
    return vocab.agg(F.to_json(F.struct(entries.alias("stoi"))).alias("value"))


def open_tokenizer(spark: SparkSession, path: str) -> tuple[str, Tokenizer | DataFrame]:
    """Subword first, then char; one error naming both when neither fits."""
    errors = []
    try:
        return "subword", load_tokenizer(spark, path)
    except ValueError as error:
        errors.append(f"subword: {error}")
    table = char_table(spark, path)
    if not table.isEmpty():
        return "char", table
    errors.append("char: no character table")
    raise ValueError("; ".join(errors))
