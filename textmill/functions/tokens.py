"""Token sequences as strings whose characters are the token ids.

Bytes 0-255 come from UTF-8 through ISO-8859-1; a learned id k is the character k, with the
surrogate range skipped. Merging is then ``replace`` and slicing is ``substring``, all native.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SURROGATES_START = 0xD800
SURROGATES_SIZE = 0x800
MAX_ID = 0xFFFF - SURROGATES_SIZE


def char_of(token: int) -> str:
    if not 0 <= token <= MAX_ID:
        raise ValueError(f"token id {token} is outside 0..{MAX_ID}")
    return chr(token if token < SURROGATES_START else token + SURROGATES_SIZE)


def id_of(char: str) -> int:
    code = ord(char)
    return code if code < SURROGATES_START else code - SURROGATES_SIZE


def byte_tokens(text: Column) -> Column:
    """UTF-8 bytes of a text as a token string."""
    return F.decode(F.encode(text, "UTF-8"), "ISO-8859-1")


def code_id(code: Column) -> Column:
    """Character code to token id."""
    return F.when(code < SURROGATES_START, code).otherwise(code - SURROGATES_SIZE)


def token_id(char: Column) -> Column:
    return code_id(F.ascii(char))


def token_ids(tokens: Column) -> Column:
    """Token string to ``array<int>``; the empty string gives an empty array."""
    parts = F.transform(F.split(tokens, ""), token_id)
    return F.when(F.length(tokens) > 0, parts).otherwise(F.array().cast("array<int>"))


def code_char(code: Column) -> Column:
    """Character of a code up to 65,535. Spark's chr() wraps at 256, so it goes through two bytes."""
    return F.decode(F.unhex(F.lpad(F.hex(code), 4, "0")), "UTF-16BE")


def id_char(token: Column) -> Column:
    """Token id to its character."""
    return code_char(F.when(token < SURROGATES_START, token).otherwise(token + SURROGATES_SIZE))


def tokens_from_ids(ids: Column) -> Column:
    return F.array_join(F.transform(ids, id_char), "")


def packed(tokens: Column) -> Column:
    """Two bytes per token: slices cost their own length, wherever they lie in a long text."""
    return F.encode(tokens, "UTF-16BE")


def packed_slice(data: Column, start: Column, n: Column) -> Column:
    """``n`` tokens from 0-based ``start`` of packed data, as a token string."""
    part = F.substr(data, (start * 2 + 1).cast("int"), (n * 2).cast("int"))
    return F.decode(part, "UTF-16BE")


def adjacent(tokens: Column) -> Column:
    """All overlapping two-token substrings: 'aaa' gives 'aa' twice."""
    return F.regexp_extract_all(tokens, F.lit("(?s)(?=(..))"), F.lit(1))


def last_tokens(tokens: Column, n: int) -> Column:
    """The last ``n`` tokens; an empty prompt is an error."""
    tail = F.right(tokens, F.lit(n))
    return F.when(F.length(tokens) > 0, tail).otherwise(F.raise_error(F.lit("the prompt is empty")))


def bytes_to_text(data: Column) -> Column:
    """UTF-8 bytes to text with replacement characters for invalid parts."""
    return F.make_valid_utf8(data.cast("string"))
