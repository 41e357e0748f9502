"""Running totals, caps and budgets without a global window.

Rows carry an integer order ``key`` that is unique within their group. The key's high bits are the row's bucket; how many low bits
a bucket spans is read from the keys, so that row numbers, time stamps and hashes alike give buckets of some
thousand rows. Bucket totals are summed up level by level, each in windows of at most 1,024 buckets, and every bucket then gets its
offset as one extra header row. One shuffle of the data, no join.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textmill.session import cut_lineage

# Rows of a bucket where keys are densest, and bits from one level to the next.
BUCKET_ROWS = 2048
LEVEL_BITS = 10
# Caps up to this many rows are found by ordering as many keys.
SELECTED = 1 << 18
# Rows of a narrow table up to which one ordered window is used.
ONE_WINDOW = 1 << 16
_QUANTILES = 256


def key_shifts(df: DataFrame, key: str) -> tuple[int, ...]:
    return key_facts(df, key)[0]


def key_facts(df: DataFrame, key: str) -> tuple[tuple[int, ...], int]:
    """Bits below the bucket for each level, and the number of rows, from one small aggregate over the keys.

    The densest of _QUANTILES equal shares of the rows decides the finest level; levels go up until one window holds the rest.
    """
    k = F.col(key).cast("bigint")
    at = [i / _QUANTILES for i in range(_QUANTILES + 1)]
    found = df.agg(F.percentile_approx(k, at, 10 * _QUANTILES).alias("q"), F.min(k).alias("lo"), F.max(k).alias("hi"), F.count(k).alias("n")).first()
    if not found["n"]:
        return (0,), 0
    # Quantiles pass through doubles, so the exact ends are not among them: a rounding error is no gap.
    q = sorted(set(found["q"]))
    gap = min((b - a for a, b in zip(q, q[1:], strict=False)), default=1)
    shift = max(0, math.floor(math.log2(max(1.0, BUCKET_ROWS * gap * _QUANTILES / found["n"]))))
    shifts = [min(shift, 62)]
    while (found["hi"] >> shifts[-1]) - (found["lo"] >> shifts[-1]) >= 1 << LEVEL_BITS:
        shifts.append(shifts[-1] + LEVEL_BITS)
    return tuple(shifts), found["n"]


def shuffle_key(seed: int, *cols: Column) -> Column:
    """Reproducible pseudo-random 32-digit order key of a row."""
    parts = [c.cast("string") for c in cols]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *parts))


def hash_int(md5_hex: Column, digits: int = 15) -> Column:
    """Leading digits of an md5 as a non-negative bigint."""
    return F.conv(F.substring(md5_hex, 1, digits), 16, 10).cast("bigint")


def _levels(key: str, shifts: Sequence[int], major: str | None) -> dict[str, Column]:
    """Bucket columns from fine to coarse."""
    levels = {f"_b{s}": F.shiftright(F.col(key).cast("bigint"), s) for s in shifts}
    if major is not None:
        levels["_major"] = F.col(major)
    return levels


def _offsets(totals: DataFrame, group: list[str], levels: list[str]) -> DataFrame:
    """Sum of all totals before each bucket, as column ``_off``."""
    fine, coarse = levels[0], levels[1:]
    if not coarse:
        w = W.partitionBy(*group).orderBy(fine).rowsBetween(W.unboundedPreceding, -1)
        return totals.withColumn("_off", F.coalesce(F.sum("_size").over(w), F.lit(0))).drop("_size")
    upper = totals.groupBy(*group, *coarse).agg(F.sum("_size").alias("_size"))
    heads = _offsets(upper, group, coarse).withColumnRenamed("_off", "_size")
    w = (
        W.partitionBy(*group, *coarse)
        .orderBy(F.col("_head").desc(), fine)
        .rowsBetween(W.unboundedPreceding, -1)
    )
    return (
        totals.withColumn("_head", F.lit(False))
        .unionByName(heads.withColumn("_head", F.lit(True)), allowMissingColumns=True)
        .withColumn("_off", F.sum("_size").over(w))
        .filter(~F.col("_head"))
        .drop("_head", "_size")
    )


def bucket_offsets(
    df: DataFrame, size: Column, key: str, group: Sequence[str], shifts: Sequence[int], major: str | None
) -> DataFrame:
    levels = _levels(key, shifts, major)
    keyed = df.select(*group, *[c.alias(n) for n, c in levels.items()], size.cast("bigint").alias("_size"))
    totals = keyed.groupBy(*group, *levels).agg(F.sum("_size").alias("_size"))
    return _offsets(totals, list(group), list(levels))


def _accumulate(
    df: DataFrame, offsets: DataFrame, size: Column, key: str, group: Sequence[str],
    shifts: Sequence[int], major: str | None, ties: Sequence[str], out: str,
) -> DataFrame:
    levels = _levels(key, shifts, major)
    bucket = next(iter(levels))
    names = [bucket] + (["_major"] if major is not None else [])
    rows = df.withColumns({n: levels[n] for n in names} | {"_size": size.cast("bigint"), "_head": F.lit(False)})
    heads = offsets.select(*group, *names, F.col("_off").alias("_size"), F.lit(True).alias("_head"))
    w = (
        W.partitionBy(*group, *names)
        .orderBy(F.col("_head").desc(), key, *ties)
        .rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    return (
        rows.unionByName(heads, allowMissingColumns=True)
        .withColumn(out, F.sum("_size").over(w))
        .filter(~F.col("_head"))
        .drop("_head", "_size", *names)
    )


def running_total(
    df: DataFrame, size: Column, key: str, *, group: Sequence[str] = (), major: str | None = None,
    ties: Sequence[str] = (), shifts: Sequence[int] | None = None, out: str = "running",
) -> DataFrame:
    """Inclusive running total of ``size`` within ``group`` in the order (``major``, ``key``).

    Equal to a plain ordered window; ``major`` is a short leading order column such as the
    position of a source.
    """
    shifts = shifts or key_shifts(df, key)
    off = bucket_offsets(df, size, key, group, shifts, major)
    return _accumulate(df, off, size, key, group, shifts, major, ties, out)


def take_budget(
    df: DataFrame, size: Column, budget: int, key: str, *, ties: Sequence[str] = (),
    shifts: Sequence[int] | None = None, out: str = "running", rows: int | None = None,
) -> DataFrame:
    """Rows in order up to the first that would pass ``budget``.

    A first job sums the buckets. The last one that can hold such a row is a single number, so in
    the second pass all later rows leave at the scan and only the chosen part is shuffled. ``rows`` is the number of rows where it
    is known; ONE_WINDOW of them need no buckets.
    """
    if rows is not None and rows <= ONE_WINDOW:
        w = W.orderBy(key, *ties).rowsBetween(W.unboundedPreceding, W.currentRow)
        return df.withColumn(out, F.sum(size.cast("bigint")).over(w)).filter(F.col(out) <= budget)
    shifts = shifts or key_shifts(df, key)
    off = bucket_offsets(df, size, key, (), shifts, None)
    bucket = f"_b{shifts[0]}"
    open_buckets = cut_lineage(off.filter(F.col("_off") < budget))
    last = open_buckets.agg(F.max(bucket).alias("b")).first()["b"]
    near = df.filter(F.shiftright(F.col(key).cast("bigint"), shifts[0]) <= F.lit(last))
    done = _accumulate(near, open_buckets, size, key, (), shifts, None, ties, out)
    return done.filter(F.col(out) <= budget)


def take_until(
    df: DataFrame, size: Column, limit: int, key: str, *, major: str, always: Column,
    shifts: Sequence[int] | None = None,
) -> DataFrame:
    """Rows before which the total is still below ``limit``, plus the rows marked ``always``.

    A first job sums the buckets; rows beyond the last open one leave before the shuffle unless
    they are marked.
    """
    shifts = shifts or key_shifts(df, key)
    off = bucket_offsets(df, size, key, (), shifts, major)
    open_buckets = cut_lineage(off.filter(F.col("_off") < limit))
    bucket = f"_b{shifts[0]}"
    here = F.struct(F.col(major).alias("_major"), F.shiftright(F.col(key).cast("bigint"), shifts[0]).alias(bucket))
    last = _last_bucket(open_buckets, ["_major", bucket])
    marked = df.withColumns({"_always": always, "_open": F.coalesce(here <= last, F.lit(False))})
    near = marked.filter(F.col("_always") | F.col("_open"))
    done = _accumulate(near, open_buckets, size, key, (), shifts, major, (), "_running")
    before = F.col("_running") - size
    return done.filter(F.col("_always") | (F.col("_open") & (before < limit))).drop("_always", "_open", "_running")


def take_first(
    df: DataFrame, n: int, key: str, *, group: Sequence[str] = (), major: str | None = None,
    shifts: Sequence[int] | None = None,
) -> DataFrame:
    """The first ``n`` rows of every group in order; a table of no more rows is returned as it is.

    Without groups, and for caps of SELECTED rows, the key of the n-th row is found and the rest is a filter that reaches the scan. Else
    a first job counts the buckets, and those that start at or beyond the cap stay out of the shuffle:
    the limit is a single value, or one row per group.
    """
    if shifts is None:
        if not group and major is None and n <= SELECTED:
            last = nth_key(df, n, key)
            return df if last is None else df.filter(F.col(key) <= F.lit(last))
        shifts, rows = key_facts(df, key)
        if rows <= n:
            return df
    off = bucket_offsets(df, F.lit(1), key, group, shifts, major)
    open_buckets = cut_lineage(off.filter(F.col("_off") < n))
    levels = _levels(key, shifts, major)
    bucket = next(iter(levels))
    names = (["_major"] if major is not None else []) + [bucket]
    here = F.struct(*[levels[c].alias(c) for c in names])
    if group:
        cuts = open_buckets.groupBy(*group).agg(F.max(F.struct(*names)).alias("_last"))
        near = _semi_bounded(df.withColumn("_here", here), cuts, group)
    else:
        near = df.filter(here <= _last_bucket(open_buckets, names))
    done = _accumulate(near, open_buckets, F.lit(1), key, group, shifts, major, (), "_rank")
    return done.filter(F.col("_rank") <= n).drop("_rank")


def nth_key(df: DataFrame, n: int, key: str) -> int | None:
    """The key of the n-th row, None where there are no more rows than n. Only a leading part of the keys is ordered."""
    k = F.col(key).cast("bigint")
    facts = df.agg(F.min(k).alias("lo"), F.max(k).alias("hi"), F.count(k).alias("n")).first()
    if facts["n"] <= n:
        return None
    if n <= 0:
        return facts["lo"] - 1
    upto, width = facts["lo"], max(1, facts["hi"] - facts["lo"])
    share = 2.0 * n / facts["n"]
    while True:
        # Even keys hold n rows in half of this; where they lie more thinly, a longer part is taken.
        upto = min(facts["hi"], facts["lo"] + int(width * min(1.0, share)))
        near = df.select(k.alias("k")).filter(F.col("k") <= upto)
        found = near.orderBy("k").limit(n).agg(F.max("k").alias("k"), F.count("*").alias("n")).first()
        if found["n"] >= n or upto >= facts["hi"]:
            return found["k"]
        share *= 16


def take_while(
    df: DataFrame, counts: Column, n: int, key: str, *, major: str | None = None, shifts: Sequence[int] | None = None
) -> DataFrame:
    """Rows in order up to the ``n``-th that counts, and those before it; all rows when fewer count."""
    if shifts is None:
        shifts, rows = key_facts(df, key)
        if rows <= n:
            return df
    one = F.coalesce(counts, F.lit(False)).cast("bigint")
    off = bucket_offsets(df, one, key, (), shifts, major)
    open_buckets = cut_lineage(off.filter(F.col("_off") < n))
    levels = _levels(key, shifts, major)
    names = (["_major"] if major is not None else []) + [next(iter(levels))]
    near = df.filter(F.struct(*[levels[x].alias(x) for x in names]) <= _last_bucket(open_buckets, names))
    done = _accumulate(near, open_buckets, one, key, (), shifts, major, (), "_count")
    return done.filter(F.col("_count") - one < n).drop("_count")


def _last_bucket(open_buckets: DataFrame, names: Sequence[str]) -> Column:
    """The greatest open bucket as a literal struct; null, which keeps nothing, when there is none."""
    row = open_buckets.agg(F.max(F.struct(*names)).alias("m")).first()["m"]
    types = {f.name: f.dataType for f in open_buckets.schema}
    return F.struct(*[F.lit(None if row is None else row[c]).cast(types[c]).alias(c) for c in names])


def _semi_bounded(df: DataFrame, cuts: DataFrame, group: Sequence[str]) -> DataFrame:
    """Keep rows whose ``_here`` is at most their group's ``_last``; null groups match."""
    cuts = cuts.select(*[F.col(g).alias(f"_g_{g}") for g in group], "_last")
    cond = F.col("_here") <= F.col("_last")
    for g in group:
        cond = cond & F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    return df.join(cuts, cond, "left_semi").drop("_here")
