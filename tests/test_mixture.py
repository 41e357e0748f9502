import random

from pyspark.sql import functions as F

from textmill.operators import mixture as M
from textmill.sources import sinks


def blocks(spark, sizes, source="s"):
    df = spark.createDataFrame([(source, i, "x" * n) for i, n in enumerate(sizes)], "s string, i long, t string")
    return M.as_blocks(df, F.lit("d"), F.col("s"), F.col("i"), F.col("t"))


def plain_saturating(sources, limit, unchecked=()):
    """Sources are lists of block sizes, None for a row that gives nothing."""
    total, taken = 0, []
    for s, rows in enumerate(sources):
        for r, size in enumerate(rows):
            if size is not None:
                total += size
                taken.append((s, r))
            if s not in unchecked and total >= limit:
                break
    return taken


def test_saturating_budget_equals_the_loop(spark):
    rnd = random.Random(9)
    for case in range(6):
        sources = [[rnd.choice([None, 1, 2, 5, 9]) for _ in range(rnd.randrange(0, 12))] for _ in range(5)]
        limit = rnd.choice([1, 7, 20, 60, 1000])
        data = [(s, r, None if n is None else "x" * n) for s, rows in enumerate(sources) for r, n in enumerate(rows)]
        if not data:
            continue
        df = spark.createDataFrame(data, "so int, ro long, block string")
        got = M.saturating_budget(df, limit, source_ord="so", row_ord="ro", checked=F.col("so") != 2)
        assert sorted((r.so, r.ro) for r in got.collect()) == plain_saturating(sources, limit, unchecked=(2,)), case


def test_budget_takes_nothing_behind_an_overflow(spark):
    df = blocks(spark, [4, 5, 7, 1, 3, 2, 8])
    order = [int(r.row_key) for r in M.seeded_order(df).orderBy("ord").collect()]
    sizes = [4, 5, 7, 1, 3, 2, 8]
    for budget in (0, 3, 9, 17, 30, 99):
        want, total = [], 0
        for i in order:
            if total + sizes[i] > budget:
                break
            total += sizes[i]
            want.append(i)
        got = M.char_budget(df, budget).orderBy("running").collect()
        assert [int(r.row_key) for r in got] == want


def test_written_corpus_is_the_concatenation(spark, tmp_path):
    texts = ["one\n\n", "two\nlines\n\n", "drei é\n\n", "four\n\n"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, t string")
    mixed = M.char_budget(M.as_blocks(df, F.lit("d"), F.lit("s"), F.col("i"), F.col("t")), 1000)
    want = "".join(r.block for r in mixed.orderBy("ord").collect())
    sinks.write_corpus(mixed, str(tmp_path / "c"), parts=3)
    files = sorted((tmp_path / "c").glob("part-*"))
    assert "".join(f.read_text(encoding="utf-8") for f in files) == want
    sinks.write_corpus(mixed, str(tmp_path / "one"), single_file=True)
    assert [f.read_text(encoding="utf-8") for f in (tmp_path / "one").glob("part-*")] == [want]
    sinks.write_blocks(mixed, str(tmp_path / "b"), parts=2)
    assert spark.read.parquet(str(tmp_path / "b")).count() == 4


def test_only_about_the_budget_is_rendered(spark):
    """Rows rendered are counted by an accumulator in the block itself."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def block(i):
        seen.add(1)
        return "x" * 100

    spread = spark.range(20_000).repartition(4)
    df = M.as_blocks(spread, F.lit("d"), F.lit("s"), F.col("id"), block(F.col("id")))
    got = M.char_budget(df, 200_000).count()
    assert got == 2000 and seen.value <= 3 * got


def test_slices_reach_any_budget(spark):
    df = blocks(spark, [3] * 50)
    for budget in (0, 1, 3, 100, 150, 10**9):
        assert M.char_budget(df, budget).count() == min(50, budget // 3)


def test_cap_by_the_nth_key(spark):
    from textmill.operators.prefix import nth_key, take_first

    keys = [5, 9, -3, 10**15, 10**15 + 1, 10**15 + 7, 2**61]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    for n in range(9):
        assert sorted(r.k for r in take_first(df, n, "k").collect()) == sorted(keys)[:n]
    assert nth_key(df, 7, "k") is None and nth_key(df.limit(0), 3, "k") is None
