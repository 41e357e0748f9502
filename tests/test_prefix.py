import random

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textmill.operators import prefix as P


@pytest.fixture(scope="module")
def rows(spark):
    """A third of all rows in one group; keys dense, sparse, negative and very large."""
    rnd = random.Random(1)
    keys = rnd.sample(range(-200, 1500), 600) + [2**40 + i * 5000 for i in range(50)]
    data = [(k, rnd.choice(["hot", "hot", "b", "c", None]), rnd.randrange(3), rnd.randrange(0, 9)) for k in keys]
    return spark.createDataFrame(data, "k long, g string, m int, s int").repartition(5)


@pytest.mark.parametrize("shifts", [(2, 5), (4,), (12, 24), (1, 3, 6, 12), None])
@pytest.mark.parametrize("group,major", [((), None), (("g",), None), ((), "m"), (("g",), "m")])
def test_running_total_is_the_plain_window(rows, shifts, group, major):
    order = ([major] if major else []) + ["k"]
    want = rows.withColumn("w", F.sum("s").over(W.partitionBy(*group).orderBy(*order)))
    got = P.running_total(rows, F.col("s"), "k", group=group, major=major, shifts=shifts)
    assert sorted((r.k, r.running) for r in got.collect()) == sorted((r.k, r.w) for r in want.collect())


@pytest.mark.parametrize("parts", [1, 4, 64])
def test_budget_stops_at_the_first_overflow(spark, rows, parts):
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        ordered = sorted(rows.select("k", "s").collect())
        for budget in (0, 1, 40, 1000, 10**6):
            got = sorted(r.k for r in P.take_budget(rows, F.col("s"), budget, "k", shifts=(3,) if parts > 1 else None).collect())
            want, total = [], 0
            for k, s in ordered:
                if total + s > budget:
                    break
                total += s
                want.append(k)
            # Rows of size 0 cost nothing, so they never overflow.
            assert [k for k in got if dict(ordered)[k]] == [k for k in want if dict(ordered)[k]]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


@pytest.mark.parametrize("shifts", [(2, 5), (12, 24), None])
def test_first_rows_per_group(rows, shifts):
    data = rows.select("g", "m", "k").collect()
    for n in (0, 1, 7, 10_000):
        got = P.take_first(rows, n, "k", group=["g"], shifts=shifts).select("g", "k").collect()
        want = []
        for g in {r.g for r in data}:
            want += [(g, k) for k in sorted(r.k for r in data if r.g == g)[:n]]
        assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, want))
    got = P.take_first(rows, 100, "k", major="m", shifts=shifts).collect()
    assert {r.k for r in got} == {r.k for r in sorted(data, key=lambda r: (r.m, r.k))[:100]}


def test_hash_buckets_are_the_md5_order(spark):
    df = spark.range(500).withColumn("h", P.shuffle_key(18, F.lit("s"), F.col("id"))).withColumn("k", P.hash_int(F.col("h")))
    got = P.running_total(df, F.lit(1), "k", ties=["h"]).collect()
    assert [r.running for r in sorted(got, key=lambda r: r.h)] == list(range(1, 501))
    import hashlib

    assert {r.id: r.h for r in got} == {i: hashlib.md5(f"18:s:{i}".encode()).hexdigest() for i in range(500)}


def test_levels_follow_the_keys(spark):
    """No window without a partition ever holds more than a thousand buckets, and no bucket most of the rows."""
    n = 20_000
    for key in (F.col("id"), F.xxhash64("id"), F.shiftleft(F.lit(1_700_000_000), 22) + F.col("id"), F.col("id") * 10**12):
        df = spark.range(n).select(key.alias("k"))
        shifts = P.key_shifts(df, "k")
        buckets = df.groupBy(F.shiftright("k", shifts[0])).count()
        assert buckets.agg(F.max("count")).first()[0] <= 8 * P.BUCKET_ROWS
        assert df.select(F.shiftright("k", shifts[-1])).distinct().count() <= 1024
    assert P.key_shifts(spark.range(0).withColumnRenamed("id", "k"), "k") == (0,)


def test_rows_up_to_the_nth_that_counts(spark, rows):
    data = sorted((r.k, r.s) for r in rows.collect())
    for n in (1, 5, 10**6):
        want, seen = [], 0
        for k, s in data:
            if seen >= n:
                break
            want.append(k)
            seen += s > 5
        assert sorted(r.k for r in P.take_while(rows, F.col("s") > 5, n, "k").collect()) == want
