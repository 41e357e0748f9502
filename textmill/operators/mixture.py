"""Order, cap, cut and report text blocks of many sources.

A block table has ``domain, source, row_key, weight, block``; ``(source, row_key)`` identifies a block and ``weight`` is its length
in characters. A budget takes the leading part of the shuffled order, and only about that part is ever rendered.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textmill.functions.text import non_null
from textmill.operators.prefix import ONE_WINDOW, hash_int, shuffle_key, take_budget, take_until
from textmill.session import cut_lineage

# The seed of the shuffle and the character budgets.
SEED = 18
BUDGET_MIXED = 12_000_000
BUDGET_FACTS = 10_000_000
BUDGET_WRITING = 8_000_000

# The order is 60 bits long. A first stretch of it is to hold this share of the budget, by Spark's own estimate of the size; the next are made with
# some room, or many times longer while fewer than _SURE_ROWS rows are known.
_ORDER = 1 << 60
_FIRST_SHARE, _ROOM, _SURE_ROWS, _FEW = 0.75, 1.25, 30, 32.0


def as_blocks(df: DataFrame, domain: Column, source: Column, row_key: Column, block: Column) -> DataFrame:
    """A block table; rows with a null block are dropped."""
    keys = domain.alias("domain"), source.alias("source"), row_key.cast("string").alias("row_key")
    return non_null(df, *keys, block=block).select(
        "domain", "source", "row_key", F.length("block").cast("bigint").alias("weight"), "block"
    )


def seeded_order(blocks: DataFrame, seed: int = SEED) -> DataFrame:
    """Adds ``ord``, the md5 order of the seeded shuffle, and its integer form ``ord_key``."""
    return blocks.withColumn("ord", shuffle_key(seed, F.col("source"), F.col("row_key"))).withColumn(
        "ord_key", hash_int(F.col("ord"))
    )


def order_slices(blocks: DataFrame, budget: int, seed: int = SEED) -> Iterator[tuple[DataFrame, int, int, bool]]:
    """(blocks, rows, characters, whether these are all) of the leading part of the shuffled order, one stretch after the other, each written once.

    The order is a hash of the keys, so a share of it is about that share of the characters: after a first small stretch the next is
    as long as the budget asks for. What lies behind is never rendered.
    """
    ordered = seeded_order(blocks, seed)
    total = float(ordered._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    share, low, rows, chars = max(2.0**-40, min(1.0, _FIRST_SHARE * budget / max(1.0, total))), 0, 0, 0
    while True:
        high = _ORDER if share >= 1 else int(share * _ORDER)
        # The filter is on the keys alone, so it is applied before texts are rendered.
        part = cut_lineage(ordered.filter((F.col("ord_key") >= F.lit(low)) & (F.col("ord_key") < F.lit(high))))
        found = part.agg(F.count("*").alias("n"), F.coalesce(F.sum("weight"), F.lit(0)).alias("c")).first()
        rows, chars = rows + found["n"], chars + found["c"]
        yield part, rows, chars, high >= _ORDER
        # Few rows tell little of the rest.
        share *= max(2.0, _ROOM * budget / chars) if rows >= _SURE_ROWS and chars else _FEW
        low = high


def char_budget(blocks: DataFrame, budget: int, seed: int = SEED) -> DataFrame:
    """Blocks in shuffled order until the first that does not fit; adds ``ord``, ``ord_key`` and ``running``."""
    parts = []
    for part, rows, chars, whole in order_slices(blocks, budget, seed):  # noqa: B007
        parts.append(part)
        if whole or chars > budget:
            break
    near = reduce(DataFrame.unionByName, parts)
    # Texts stay out of the window.
    narrow = near.select("source", "row_key", "weight", "ord", "ord_key")
    chosen = take_budget(narrow, F.col("weight"), budget, "ord_key", ties=["ord", "source", "row_key"], rows=rows)
    return near.join(chosen.select("source", "row_key", "running"), ["source", "row_key"])


def saturating_sizes(
    sizes: DataFrame, limit: int, *, source_ord: str, row_ord: str, size: str, checked: Column | None = None, rows: int | None = None
) -> DataFrame:
    """Of a narrow table of all rows, those that are read until ``limit`` characters are met.

    A source stops after the row that reaches the limit, so each later one still gives its first row. Sources not
    ``checked`` are read whole. ``rows`` is the number of rows where it is known.
    """
    if rows is not None and rows <= ONE_WINDOW:
        before = F.coalesce(F.sum(size).over(W.orderBy(source_ord, row_ord).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
        place = F.row_number().over(W.partitionBy(source_ord).orderBy(row_ord))
        read = (F.col("_before") < limit) | (F.col("_place") == 1)
        if checked is not None:
            read = read | ~checked
        return sizes.withColumns({"_before": before, "_place": place}).filter(read).drop("_before", "_place")
    firsts = cut_lineage(sizes.groupBy(source_ord).agg(F.min(row_ord).alias("_first")))
    marked = sizes.join(firsts, source_ord)
    always = F.col(row_ord) == F.col("_first")
    if checked is not None:
        always = always | ~checked
    read = take_until(marked, F.coalesce(size, F.lit(0)), limit, row_ord, major=source_ord, always=always)
    return read.drop("_first")


def saturating_budget(
    rows: DataFrame, limit: int, *, source_ord: str, row_ord: str, block: str = "block", checked: Column | None = None
) -> DataFrame:
    """Read ordered sources until ``limit`` characters are met; returns the rows with a block.

    Rows with a null block are read and add nothing. What is read is decided on a written table of lengths.
    """
    keys = cut_lineage(rows.select(source_ord, row_ord, F.length(block).alias("_chars"), (F.lit(True) if checked is None else checked).alias("_checked")))
    read = saturating_sizes(keys, limit, rows=keys.count(), source_ord=source_ord, row_ord=row_ord, size="_chars", checked=F.col("_checked"))
    chosen = read.filter(F.col("_chars").isNotNull()).select(source_ord, row_ord)
    return rows.join(chosen, [source_ord, row_ord], "left_semi")


def report(blocks: DataFrame) -> DataFrame:
    """Examples and characters per source, per domain and in total (null names a total)."""
    return blocks.rollup("domain", "source").agg(
        F.count("weight").alias("examples"), F.sum("weight").alias("chars")
    )
