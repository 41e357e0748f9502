"""Character vocabulary and character-level tokens."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def char_vocab(df: DataFrame, text: str) -> DataFrame:
    """``(ch, id)``: distinct characters numbered by code point from 0.

    The final window runs over distinct characters only, at most 1,114,112 rows.
    """
    chars = df.select(F.explode(F.array_distinct(F.split(F.col(text), ""))).alias("ch"))
    distinct = chars.filter(F.col("ch") != "").distinct()
    return distinct.withColumn("id", F.row_number().over(W.orderBy(F.ascii("ch"))) - 1)


class CharTokenizer:
    """A character vocabulary held by the driver: at most all 1,114,112 code points, as an array by code point.

    Tokens are ``array<int>``; texts are looked up in Arrow batches, whatever the size of the vocabulary.
    """

    def __init__(self, stoi: dict[str, int]):
        if not stoi:
            raise ValueError("a character vocabulary has one entry at least")
        self._ids = np.full(0x110000, -1, np.int32)
        self._ids[[ord(c) for c in stoi]] = list(stoi.values())
        self._codes = np.full(max(stoi.values()) + 1, -1, np.int64)
        self._codes[list(stoi.values())] = [ord(c) for c in stoi]
        self.vocab_size = len(stoi)

    @classmethod
    def of(cls, vocab: DataFrame) -> CharTokenizer:
        """From a ``(ch, id)`` table, bounded by the number of code points."""
        return cls({r["ch"]: r["id"] for r in vocab.select("ch", "id").collect()})

    def encode(self, text: Column) -> Column:
        """Text to ids; a character outside the vocabulary is an error."""
        ids = self._ids

        def look_up(texts: pa.Array) -> pa.Array:
            rows = texts.to_pylist()
            codes = np.frombuffer("".join(t or "" for t in rows).encode("utf-32-le"), np.uint32)
            found = ids[codes]
            if len(found) and found.min() < 0:
                raise ValueError("character not in the vocabulary")
            ends = np.cumsum([0] + [len(t or "") for t in rows]).astype(np.int32)
            return pa.ListArray.from_arrays(pa.array(ends), pa.array(found), mask=pa.array([t is None for t in rows]))

        return F.arrow_udf(look_up, "array<int>")(text)

    def decode(self, tokens: Column) -> Column:
        """Ids to text; an unknown id is an error."""
        codes = self._codes

        def look_up(lists: pa.Array) -> pa.Array:
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            if len(flat) and (flat.min() < 0 or flat.max() >= len(codes) or codes[flat].min() < 0):
                raise ValueError("unknown token id")
            text = codes[flat].astype("<u4").tobytes().decode("utf-32-le")
            ends = np.cumsum([0] + [n or 0 for n in pa.compute.list_value_length(lists).to_pylist()])
            valid = lists.is_valid().to_pylist()
            rows = [text[a:b] if ok else None for ok, a, b in zip(valid, ends[:-1], ends[1:], strict=True)]
            return pa.array(rows, pa.string())

        return F.arrow_udf(look_up, "string")(tokens)
