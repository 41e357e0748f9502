"""Readers: named sources, splits, whole corpora, guards."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Source:
    """Where a named source lies. ``splits`` maps split names, in order, to paths."""

    path: str | None = None
    format: str = "parquet"
    splits: Mapping[str, str] | None = None


def read_source(spark: SparkSession, registry: Mapping[str, Source], name: str) -> DataFrame:
    """Read a source by name, all its splits unioned when it has splits."""
    s = registry[name]
    if s.splits is not None:
        return all_splits(spark, s.splits, s.format)
    return spark.read.format(s.format).load(s.path)


def all_splits(spark: SparkSession, splits: Mapping[str, str], fmt: str = "parquet") -> DataFrame:
    """Every split with its name in ``split`` and its position in ``split_ord``."""
    return union_splits({n: spark.read.format(fmt).load(p) for n, p in splits.items()})


def union_splits(frames: Mapping[str, DataFrame]) -> DataFrame:
    tagged = [
        df.withColumns({"split": F.lit(name), "split_ord": F.lit(i)}) for i, (name, df) in enumerate(frames.items())
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def one_split(df: DataFrame, name: str) -> DataFrame:
    return df.filter(F.col("split") == name)


def try_source(spark: SparkSession, registry: Mapping[str, Source], name: str, *, needed: bool = False) -> tuple[DataFrame | None, str | None]:
    """The source, or None and the reason why it cannot be read; a needed one raises."""
    try:
        df = read_source(spark, registry, name)
        df.schema  # noqa: B018 - analysis is what fails for a missing source
        return df, None
    except (AnalysisException, KeyError) as error:
        if needed:
            raise
        return None, str(error).splitlines()[0]


def read_all(spark: SparkSession, registry: Mapping[str, Source], names: list[str]) -> tuple[dict[str, DataFrame], DataFrame]:
    """The readable sources and a table ``(source, status, error)`` of all of them."""
    frames, status = {}, []
    for name in names:
        df, error = try_source(spark, registry, name)
        if df is not None:
            frames[name] = df
        status.append((name, "read" if df is not None else "skipped", error))
    return frames, spark.createDataFrame(status, "source string, status string, error string")


def read_corpus(spark: SparkSession, path: str, separator: str | None = None) -> DataFrame:
    """Text files as ``(path, value)``; an absent or empty corpus is an error.

    With a separator a row is what stands between two of them, and a file of any size is read by many tasks. Without,
    a row is a whole file, for files that fit a row.
    """
    how = {"wholetext": True} if separator is None else {"lineSep": separator}
    df = spark.read.text(path, **how).select(F.col("_metadata.file_path").alias("path"), "value")
    if df.filter(F.length("value") > 0).isEmpty():
        raise ValueError(f"the corpus at {path} is empty")
    return df


def list_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Files below a folder with sizes; contents are not read. Spark's scan leaves out empty files."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path)
    )
    return files.select("path", "length", "modificationTime")


def require(spark: SparkSession, path: str, what: str) -> str:
    """The path, or a clear error when nothing is there."""
    jvm = spark._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    if not hpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hpath):
        raise FileNotFoundError(f"{what} is missing: {path}")
    return path
