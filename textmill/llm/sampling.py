"""Bounded samples of rows to fit classifiers on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(key: Column, modulus: int) -> Column:
    """The remainder of the CRC-32 of the key's text: the fold of a row (a null key is in fold 0)."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")), F.lit(0)) % modulus


def bounded(rows: DataFrame, group: str, key: str, limit: float, weight: Column | None = None) -> DataFrame:
    """About ``limit`` rows (or ``limit`` of the weight) of each group, chosen by a hash of the key, the row of the least hash always.

    So a group of a few large rows is never sampled to nothing. The totals are one small row per group (classes or languages), all that reaches the driver.
    """
    total = F.sum(weight) if weight is not None else F.count(F.lit(1))
    digits = F.conv(F.substring(F.md5(F.concat(F.lit("sample:"), F.coalesce(F.col(key).cast("string"), F.lit("")))), 1, 13), 16, 10)
    u = digits.cast("double") / float(2**52)
    totals = rows.groupBy(group).agg(total.cast("double").alias("t"), F.min(u).alias("first")).collect()
    share, first = F.lit(0.0), F.lit(-1.0)
    for r in totals:
        own = F.col(group).eqNullSafe(F.lit(r[0]))
        share = F.when(own, F.lit(min(1.0, limit / r["t"] if r["t"] else 1.0))).otherwise(share)
        first = F.when(own, F.lit(r["first"])).otherwise(first)
    return rows.where((u < share) | (u == first))
