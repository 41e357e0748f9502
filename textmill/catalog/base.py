"""Registration of queries and the SQL fragments their twins share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


SQL_SPACE = "||".join(
    f"chr({c})"
    for c in [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
)


def sql_clean(c: str) -> str:
    """Line by line, as the rule is stated."""
    lines = f"string_split(replace(coalesce({c}, ''), chr(13), ''), chr(10))"
    kept = f"list_filter(list_transform({lines}, lambda x: trim(x, {SQL_SPACE})), lambda x: x <> '')"
    return f"coalesce(array_to_string({kept}, chr(10)), '')"


def sql_qa(q: str, a: str, tag: str) -> str:
    """Block of two columns that are clean already; callers filter out the empty ones."""
    return f"'[{tag}]' || chr(10) || 'User: ' || {q} || chr(10) || 'Assistant: ' || {a} || chr(10) || chr(10)"


def sql_qa_query(key: str, q: str, a: str, tag: str, source: str) -> str:
    """SELECT key, block over a source."""
    return (
        f"SELECT {key}, {sql_qa('q', 'a', tag)} AS block FROM (SELECT {key}, {sql_clean(q)} AS q, {sql_clean(a)} AS a "
        f"FROM {source}) WHERE q <> '' AND a <> ''"
    )


NL = "chr(10)"
