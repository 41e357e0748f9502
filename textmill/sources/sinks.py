"""Writers of corpora."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Written:
    """What a write counted while it ran, and how long it took."""

    metrics: dict
    seconds: float

    def rate(self, name: str) -> float:
        """A metric per second."""
        return (self.metrics[name] or 0) / self.seconds


def observed(df: DataFrame, write: Callable[[DataFrame], None], **metrics: Column) -> Written:
    """Write a table and count aggregates of its rows in the same pass.

    Counts are taken where the table ends, so nothing between may run twice, as the sampling of a range shuffle does.
    """
    counts = Observation()
    begin = time.perf_counter()
    write(df.observe(counts, *[c.alias(name) for name, c in metrics.items()]))
    return Written(counts.get, time.perf_counter() - begin)


def write_reported(blocks: DataFrame, path: str, *, parts: int = 200) -> DataFrame:
    """Write ordered blocks as ``write_corpus`` does; returns ``(domain, source, examples, chars)`` of what was written, nulls naming totals.

    Sources are as few as recipes, so each has its own two counters in the pass that writes.
    """
    names = sorted((r["domain"], r["source"]) for r in blocks.select("domain", "source").distinct().collect())
    metrics = {}
    for i, (domain, source) in enumerate(names):
        own = F.col("domain").eqNullSafe(domain) & F.col("source").eqNullSafe(source)
        metrics |= {f"n{i}": F.count_if(own), f"c{i}": F.coalesce(F.sum(F.when(own, F.col("weight"))), F.lit(0))}
    metrics = metrics or {"n": F.count("*")}
    # Behind the shuffle, whose borders are sampled by a pass of their own.
    found = observed(ordered_parts(blocks, parts), lambda df: _write_text(df, path), **metrics).metrics
    rows = [(domain, source, found[f"n{i}"], found[f"c{i}"]) for i, (domain, source) in enumerate(names)]
    each = blocks.sparkSession.createDataFrame(rows, "domain string, source string, examples long, chars long")
    return each.rollup("domain", "source").agg(F.sum("examples").alias("examples"), F.sum("chars").alias("chars"))


def ordered_parts(blocks: DataFrame, parts: int) -> DataFrame:
    """Blocks range-partitioned and sorted in shuffled order; the parts read one after another."""
    return blocks.repartitionByRange(parts, "ord", "source", "row_key").sortWithinPartitions("ord", "source", "row_key")


def write_corpus(blocks: DataFrame, path: str, *, parts: int = 200, single_file: bool = False) -> None:
    """Write ordered blocks as UTF-8 text, so that the files joined in name order are the corpus.

    A block ends in a line feed, which the text writer adds; the other characters are the value.
    ``single_file`` sends everything through one task and is for small corpora only.
    """
    _write_text(ordered_parts(blocks, 1 if single_file else parts), path)


def _write_text(rows: DataFrame, path: str) -> None:
    rows.select(F.expr("left(block, length(block) - 1)").alias("value")).write.mode("overwrite").text(path)


def write_blocks(blocks: DataFrame, path: str, *, parts: int = 200) -> None:
    """The same order kept as columns."""
    ordered_parts(blocks, parts).write.mode("overwrite").parquet(path)


def write_lines(lines: DataFrame, path: str, *, parts: int = 200) -> None:
    """Write parts of blocks ``(ord, source, row_key, turn, part)`` in order, without putting blocks together.

    The text is that of ``write_corpus``; a block of any length is dealt to many tasks.
    """
    keys = ["ord", "source", "row_key", "turn"]
    rows = lines.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    rows.select(F.expr("left(part, length(part) - 1)").alias("value")).write.mode("overwrite").text(path)
