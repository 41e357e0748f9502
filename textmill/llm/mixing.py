"""Mixing sources to target weights by Poisson replication.

Each document is repeated a Poisson number of times whose mean is the target repetition rate of its source; the
number is the quantile of a uniform value hashed from a seed and the key, so that a rerun gives the same mix.

Defined results: a null source is a source of its own; a null key is hashed as the empty string; rows that repeat a
key get the same count each; an empty table gives an empty mix. ``copy`` and ``shuffle_key`` replace columns of those
names; every other column is carried as it is, text included (null and very long texts alike).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.session import cut_lineage

MAX_BROADCAST_SOURCES = 10_000  # beyond it the rates are joined by a shuffle
_SOURCE, _RATE, _BASE, _CDF, _COUNT = "__mix_source", "__mix_rate", "__mix_base", "__mix_cdf", "__mix_count"


def poisson_table(rate: float) -> tuple[int, list[float]]:
    """First count and cumulative probabilities from there on; what is cut off on either side is below 1e-20."""
    if not rate > 0:
        return 0, [1.0]
    low = max(0, math.floor(rate - 12 * math.sqrt(rate) - 30))
    k = np.arange(low, math.ceil(rate + 12 * math.sqrt(rate) + 30) + 1)
    log = -rate + k * math.log(rate) - np.array([math.lgamma(x + 1) for x in k])
    return low, np.cumsum(np.exp(log)).tolist()


def _tables(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rates in batches:
        made = [poisson_table(x) for x in rates[_RATE]]
        yield pd.DataFrame({_SOURCE: rates[_SOURCE], _BASE: [x[0] for x in made], _CDF: [x[1] for x in made]})


def uniform(seed: str, *keys: Column) -> Column:
    """A double in [0, 1) of 52 bits, the same on every cluster."""
    return F.conv(F.substring(_digest(seed, *keys), 1, 13), 16, 10).cast("double") / float(2**52)


def _digest(seed: str, *keys: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(seed), *(F.coalesce(k.cast("string"), F.lit("")) for k in keys)))


def tempered_rates(docs: DataFrame, source: str = "source", power: float = 0.5) -> DataFrame:
    """Repetition rates for weights ``n ** power``, scaled so that the mix is as large as the input.

    One row per source: (source, rate). Only counts leave the map side.
    """
    counts = cut_lineage(docs.groupBy(F.col(source).alias("source")).agg(F.count(F.lit(1)).alias("n")))
    all_n, weight = counts.agg(F.sum("n"), F.sum(F.col("n") ** power)).first()
    return counts.select("source", (F.lit(all_n) * F.col("n") ** power / F.lit(weight) / F.col("n")).cast("double").alias("rate"))


def replicate(docs: DataFrame, rates: DataFrame, key: str = "doc_id", source: str = "source", seed: str = "mix") -> DataFrame:
    """The mix: each row ``copy`` = 1.. times, in a global order by ``shuffle_key`` within and across partitions.

    ``rates`` has (source, rate); sources without a row are left out. The rates are broadcast up to
    MAX_BROADCAST_SOURCES sources, else joined by a shuffle in which a hot source is split at run time.
    The global shuffle deals rows by the hash of a random key, so that no source gathers anywhere.
    """
    tables = cut_lineage(
        rates.select(F.col("source").alias(_SOURCE), F.col("rate").cast("double").alias(_RATE))
        .mapInPandas(_tables, f"{_SOURCE} {dict(rates.dtypes)['source']}, {_BASE} long, {_CDF} array<double>")
    )
    if tables.count() <= MAX_BROADCAST_SOURCES:
        tables = F.broadcast(tables)
    u = uniform(seed, docs[key])
    joined = docs.join(tables, docs[source].eqNullSafe(F.col(_SOURCE)))
    counted = joined.withColumn(_COUNT, F.col(_BASE) + F.size(F.filter(_CDF, lambda c: c <= u)))
    copies = counted.where(F.col(_COUNT) > 0).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), _COUNT)))
    keyed = copies.withColumn("shuffle_key", _digest(seed, F.col(key), F.col("copy"))).drop(_SOURCE, _BASE, _CDF, _COUNT)
    return keyed.repartition("shuffle_key").sortWithinPartitions("shuffle_key")
