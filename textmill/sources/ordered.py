"""Sources in an order, read a growing leading part at a time, so that a reader may stop before the end."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from textmill.sources.readers import list_files

# Rows of the first part of a key range, and how much longer each next part is.
FIRST_ROWS, GROWTH = 1 << 12, 4


class OrderedFiles:
    """Files whose names are in row order: one, then two, four and so on are opened, those behind the reader's stop never.

    Their columns are those of the first file.
    """

    def __init__(self, spark: SparkSession, path: str, fmt: str = "parquet", pattern: str = "*.parquet", change: Callable[[DataFrame], DataFrame] | None = None):
        self.spark, self.format, self.change = spark, fmt, change or (lambda df: df)
        self.paths = sorted(r["path"] for r in list_files(spark, path, pattern).select("path").collect())
        if not self.paths:
            raise FileNotFoundError(f"no files {pattern} in {path}")

    def mapped(self, change: Callable[[DataFrame], DataFrame]) -> OrderedFiles:
        """The same files, each part changed."""
        out = object.__new__(OrderedFiles)
        out.spark, out.format, out.paths = self.spark, self.format, self.paths
        out.change = lambda df: change(self.change(df))
        return out

    def _load(self, a: int, b: int) -> DataFrame:
        schema = self.spark.read.format(self.format).load(self.paths[0]).schema
        return self.change(self.spark.read.format(self.format).schema(schema).load(self.paths[a:b]))

    def parts(self, order: str) -> Iterator[DataFrame]:
        at, n = 0, 1
        while at < len(self.paths):
            yield self._load(at, at + n)
            at, n = at + n, 2 * n

    def upto(self, n_parts: int) -> DataFrame:
        return self._load(0, (1 << n_parts) - 1)

    def whole(self) -> DataFrame:
        return self._load(0, len(self.paths))


class KeyRanges:
    """A table read by growing ranges of its order key; the range reaches the scan."""

    def __init__(self, df: DataFrame):
        self.df, self.bounds, self.facts, self.order = df, [], None, None

    def mapped(self, change: Callable[[DataFrame], DataFrame]) -> KeyRanges:
        return KeyRanges(change(self.df))

    def parts(self, order: str) -> Iterator[DataFrame]:
        self.order, self.bounds, k = order, [], F.col(order).cast("bigint")
        facts = self.facts or key_extents([self.df], order)[0]
        if not facts["n"]:
            return
        low, share = facts["lo"], FIRST_ROWS / facts["n"]
        while low <= facts["hi"]:
            high = facts["hi"] if share >= 0.5 else min(facts["hi"], facts["lo"] + int((facts["hi"] - facts["lo"]) * share))
            self.bounds.append(high)
            yield self.df.filter((k >= F.lit(low)) & (k <= F.lit(high)))
            low, share = high + 1, share * GROWTH

    def upto(self, n_parts: int) -> DataFrame:
        """The first parts as one table."""
        if not n_parts or not self.bounds:
            return self.df.filter(F.lit(False))
        return self.df.filter(F.col(self.order).cast("bigint") <= F.lit(self.bounds[n_parts - 1]))

    def whole(self) -> DataFrame:
        return self.df


def key_extents(frames: list[DataFrame], order: str) -> list[Row]:
    """(lo, hi, n) of the order keys of each table, all in one job."""
    k = F.col(order).cast("bigint")
    rows = [df.agg(F.min(k).alias("lo"), F.max(k).alias("hi"), F.count(k).alias("n")).withColumn("i", F.lit(i)) for i, df in enumerate(frames)]
    return sorted(reduce(DataFrame.unionByName, rows).collect(), key=lambda r: r["i"]) if rows else []


Source = DataFrame | OrderedFiles


def ordered(source: Source) -> OrderedFiles | KeyRanges:
    return source if isinstance(source, OrderedFiles) else KeyRanges(source)


def measure(sources: list[OrderedFiles | KeyRanges], order: str) -> None:
    """Look up the extents of the tables among the sources together, before they are read."""
    ranges = [s for s in sources if isinstance(s, KeyRanges)]
    for s, facts in zip(ranges, key_extents([s.df for s in ranges], order), strict=True):
        s.facts = facts


def whole(source: Source) -> DataFrame:
    return source.whole() if isinstance(source, OrderedFiles) else source
