from pyspark.sql import functions as F

from textmill import catalog
from textmill.catalog import live
from textmill.streaming import ingest as I
from textmill.streaming import progress as P

LINES = [
    (1, 1, "step     1/5000 | loss 4.1"), (1, 2, "step 50 | loss"), (1, 3, "nothing"), (2, 4, "DOWNLOAD_PROGRESS:42.5"),
    (2, 5, "DOWNLOAD_PROGRESS:1 DOWNLOAD_PROGRESS:99.9"), (1, 6, "step 7 | x\nstep 9000/5000 | y"), (3, 7, "step count 5"),
]


def test_lines_of_both_forms(spark):
    df = spark.createDataFrame(LINES, "run long, seq long, line string")
    parsed = {r.seq: (r.step, r.percent) for r in P.parse_lines(df, "line", 5000).collect()}
    assert parsed == {1: (1, None), 2: (50, None), 3: (None, None), 4: (None, 42.5), 5: (None, 99.9), 6: (5000, None), 7: (None, None)}
    got = {r.run: (r.step, r.percent) for r in P.latest_progress(P.parse_lines(df, "line", 5000), "run", "seq").collect()}
    assert got == {1: (5000, None), 2: (None, 99.9), 3: (None, None)}


def test_stream_equals_batch_and_goes_on(spark, tmp_path):
    df = spark.createDataFrame(LINES, "run long, seq long, line string")
    folder, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    schema = "run long, seq long, line string"

    def run():
        live = P.progress_stream(spark, folder, max_iters=5000, schema=schema, run="run", seq="seq", text="line")
        P.publish(live, out, state)
        return sorted(map(str, P.published(spark, out, live.schema).collect()))

    for part in (F.col("seq") <= 4, F.col("seq") > 4):
        df.filter(part).write.mode("append").parquet(folder)
        seen = spark.read.parquet(folder)
        want = P.latest_progress(P.parse_lines(seen, "line", 5000), "run", "seq")
        assert run() == sorted(map(str, want.collect()))


def test_rates(spark):
    df = spark.createDataFrame([(50, 10.0), (50, 0.0), (1, 2.0)], "it long, t double")
    rate, eta = P.progress_metrics(F.col("it"), F.col("t"), 100)
    assert [tuple(r) for r in df.select(rate, eta).collect()] == [(5.0, 10.0), (0.0, 0.0), (0.5, 198.0)]
    line = P.log_line(F.col("it"), F.lit(2.1234), rate, eta, 100)
    assert df.select(line.alias("l")).first().l == "step    50/100 | loss 2.1234 | 5.00 steps/s | ETA 0.2 min"
    assert [r[0] for r in df.select(P.is_reported(F.col("it"))).collect()] == [True, True, True]


def test_ingest_stops_at_its_budget(spark, tmp_path):
    folder, target, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    for i in range(5):
        spark.createDataFrame([(i * 2, "x" * 48), (i * 2 + 1, "short")], "k long, t string").coalesce(1).write.mode("append").parquet(folder)
    args = {"text": "t", "key": "k", "min_chars": 40}
    assert I.ingest(spark, folder, "k long, t string", target, state, budget=120, **args) == 150
    rows = spark.read.parquet(target).collect()
    assert len(rows) == 3 and all(r.n_chars == 50 and r.block == "x" * 48 + "\n\n" for r in rows)
    # A smaller budget takes nothing back.
    assert I.ingest(spark, folder, "k long, t string", target, state, budget=40, **args) == 150
    assert sorted(r.k for r in spark.read.parquet(target).collect()) == sorted(r.k for r in rows)
    # The same budget adds nothing; a larger one gets what is left, row for row.
    assert I.ingest(spark, folder, "k long, t string", target, state, budget=120, **args) == 150
    assert I.ingest(spark, folder, "k long, t string", target, state, budget=160, **args) == 200
    assert I.ingest(spark, folder, "k long, t string", target, state, **args) == 250
    assert sorted(r.k for r in spark.read.parquet(target).collect()) == [0, 2, 4, 6, 8]


def test_ingest_stops_at_its_budget_file_by_file(spark, tmp_path):
    folder, target, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    for i in range(5):
        spark.createDataFrame([(i, "x" * 48)], "k long, t string").coalesce(1).write.mode("append").parquet(folder)
    args = {"text": "t", "key": "k", "min_chars": 40, "files_per_batch": 1}
    assert I.ingest(spark, folder, "k long, t string", target, state, budget=100, **args) == 100
    assert I.ingest(spark, folder, "k long, t string", target, state, budget=10**6, **args) == 250


def test_ingest_without_budget_takes_all(spark, tmp_path):
    folder, target, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    spark.createDataFrame([(i, "x" * 48) for i in range(9)], "k long, t string").repartition(3).write.parquet(folder)
    assert I.ingest(spark, folder, "k long, t string", target, state, text="t", key="k", min_chars=40) == 450


def test_arriving_files_do_not_grow_with_the_table(spark, tmp_path):
    rows = spark.range(4000).selectExpr("id as doc_id", "concat('text ', id) as text").repartition(40)
    rows.write.parquet(str(tmp_path / "documents.parquet"))
    spark.conf.set("spark.sql.files.openCostInBytes", "128m")
    try:
        folder, files = live.arriving(spark, str(tmp_path))
        got = catalog.queries()["stream_ingest"](spark, str(tmp_path))
        assert files == 10 and len(spark.read.parquet(folder).inputFiles()) == 40
        assert got.count() == 0 and spark.read.parquet(folder).count() == 4000
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
