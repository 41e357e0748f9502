"""Cleaning and falsiness rules as native column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The characters a Unicode-aware strip removes.
SPACE = "".join(
    chr(c)
    for c in (
        *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
        0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
    )
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def non_null(df: DataFrame, *keep: str | Column, **value: Column) -> DataFrame:
    """Select ``keep`` and one new column, without rows where it is null.

    A filter on a computed column would compute it twice, in the filter and in the projection.
    """
    ((name, column),) = value.items()
    return df.select(*keep, F.explode(F.array_compact(F.array(column))).alias(name))


def clean_text(c: Column) -> Column:
    """Delete CR and NUL, strip every line, drop empty lines; null becomes ''."""
    plain = F.replace(F.replace(F.coalesce(c, F.lit("")), F.lit("\r"), F.lit("")), F.lit("\x00"), F.lit(""))
    lines = F.transform(F.split(plain, "\n"), lambda x: F.btrim(x, F.lit(SPACE)))
    return F.array_join(F.filter(lines, lambda x: x != ""), "\n")


def is_missing(c: Column) -> Column:
    """Null or empty string. A blank string is present."""
    return c.isNull() | (c == "")


def is_empty_list(c: Column) -> Column:
    return F.coalesce(F.size(c), F.lit(0)) <= 0


def first_nonempty(*cols: Column) -> Column:
    """The first column that is neither null nor ''."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cols])


def required(*cols: Column) -> Column:
    """Filter condition: every column is present."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & ~is_missing(c)
    return cond


def min_length(c: Column, n: int) -> Column:
    return F.length(c) >= n


def truncate_clean(c: Column, n: int) -> Column:
    """First ``n`` characters, cleaned again because a cut can expose a blank end."""
    return clean_text(F.substring(c, 1, n))


def contains_any(c: Column, terms: list[str]) -> Column:
    """Lower-cased text contains any of the terms as a substring."""
    low = F.lower(c)
    cond = F.lit(False)
    for t in terms:
        cond = cond | low.contains(t)
    return cond


def speaker_of(role: Column, *, user: str, other: str | None = None) -> Column:
    """``user`` role becomes User; others Assistant, or null when ``other`` names the only second role."""
    second = F.lit("Assistant") if other is None else F.when(role == other, "Assistant")
    return F.when(role == user, F.lit("User")).otherwise(second)


def person(idx: Column) -> Column:
    return F.concat(F.lit("Person"), F.coalesce(idx.cast("string"), F.lit("None")))


def titled(title: Column, text: Column) -> Column:
    """Title line above the text; the text alone when there is no title."""
    return F.when(is_missing(title), text).otherwise(F.concat(title, F.lit("\n"), text))
