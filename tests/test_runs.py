import json
import random

import pytest
from pyspark.sql import functions as F

from textmill.functions import runs as N
from textmill.operators import audit
from textmill.operators import registry as G
from textmill.sources.runs import SCHEMA, read_runs

# Recorded shapes and sizes: vocabulary, width, heads, layers, context, parameters.
RECORDED = [
    (65, 128, 4, 4, 128, 826368),
    (65, 256, 8, 16, 256, 12735488),
    (65, 128, 4, 8, 256, 1635840),
    (181, 128, 4, 8, 256, 1665536),
    (4096, 256, 8, 16, 256, 14799360),
]


def test_parameter_counts(spark):
    df = spark.createDataFrame(RECORDED, "v int, e int, h int, l int, b int, p long")
    got = df.select("p", N.param_count(F.col("v"), F.col("e"), F.col("l"), F.col("b")).alias("q"), N.size_tag(F.col("p")).alias("t"))
    rows = got.collect()
    assert [r.p for r in rows] == [r.q for r in rows]
    assert [r.t for r in rows] == ["826.4K", "12.7M", "1.6M", "1.7M", "14.8M"]


def plain_tag(n, digits):
    if n is None:
        return "?"
    for p, u in ((9, "B"), (6, "M"), (3, "K")):
        if n >= 10**p:
            return f"{n / 10**p:.{digits}f}{u}"
    return str(n)


@pytest.mark.parametrize("digits", [1, 2])
def test_size_tags_round_like_printf(spark, digits):
    rnd = random.Random(4)
    ns = [None, 0, 999, 1000, 999_949, 999_950, 999_999, 1250, 1350, 1750, 10**12, 2_500_000_000]
    ns += [rnd.randrange(10**k) for k in range(1, 13) for _ in range(60)]
    ns += [rnd.randrange(1, 99999) * 10 ** rnd.randrange(0, 8) + h for _ in range(600) for h in (0, 5, 50, 50_000, 5_000_000)]
    got = spark.createDataFrame([(n,) for n in ns], "n long").select("n", N.size_tag(F.col("n"), digits).alias("t")).collect()
    assert [r.t for r in got] == [plain_tag(r.n, digits) for r in got]


def test_folder_names(spark):
    rows = [("a-v1-0.8M",), ("a b 0.1-v2-v12-3.2K",), ("a-v1-?",), ("a2-12.7M",), ("-v1-5",), ("a-v3-900",)]
    got = spark.createDataFrame(rows, "f string").select(N.parse_folder(F.col("f")).alias("p")).collect()
    assert [tuple(r.p) for r in got] == [
        ("a", 1, "0.8M"), ("a b 0.1-v2", 12, "3.2K"), (None, None, None), (None, None, None), (None, None, None), ("a", 3, "900"),
    ]


def info(folder, name, version, updated, created="c0", params=1000):
    return (name, version, folder, None, params, 5, None, ("bpe", 300, 8, 2, 1, 4, 0.1), "d", created, updated)


def registry(spark):
    runs = spark.createDataFrame(
        [info("a-v1-1.0K", "a", 1, "2024"), info("b-v4-2.0K", "b", 4, None), info("x y", "a", 9, "2025")], SCHEMA
    )
    folders = spark.createDataFrame(
        [("a-v1-1.0K", True), ("b-v4-2.0K", True), ("bare", True), ("zz", True), ("x y", False)], "folder string, has_weights boolean"
    )
    return folders, runs


def test_listing_order_and_details(spark):
    folders, runs = registry(spark)
    assert [r.folder for r in G.list_runs(folders, runs).collect()] == ["a-v1-1.0K", "zz", "bare", "b-v4-2.0K"]
    assert [r.folder for r in G.latest_run(folders, runs).collect()] == ["a-v1-1.0K"]
    d = {r.name: r for r in G.run_details(folders, runs).collect()}
    assert d["bare"].display_name == "bare" and d["bare"].version is None
    assert d["b-v4-2.0K"].display_name == "b"
    assert G.latest_run(folders.limit(0), runs).count() == 0


def test_versions(spark):
    folders, _ = registry(spark)
    got = G.plan_folders(spark.createDataFrame([("a", 1500), ("new", None)], "name string, num_params long"), folders)
    assert {r.name: (r.version, r.folder) for r in got.collect()} == {"a": (2, "a-v2-1.5K"), "new": (1, "new-v1-?")}


def test_migration_only_without_runs(spark):
    folders, _ = registry(spark)
    legacy = spark.createDataFrame([(826368, 3000)], "num_params long, iteration long")
    assert G.migrate_plan(legacy, folders, "a").count() == 0
    row = G.migrate_plan(legacy, folders.withColumn("has_weights", F.lit(False)), "a").first()
    assert (row.version, row.folder, row.size_tag) == (2, "a-v2-826.4K", "826.4K")
    assert G.migrate_plan(legacy.limit(0), folders.limit(0), "a").count() == 0


def test_upsert_keeps_the_first_creation_time(spark):
    _, runs = registry(spark)
    new = spark.createDataFrame([info("a-v1-1.0K", "a", 1, None, None, 2000), info("n-v1-1.0K", "n", 1, None, None)], SCHEMA)
    got = {r.folder: r for r in G.upsert_runs(runs, new, F.lit("now")).collect()}
    assert (got["a-v1-1.0K"].created_at, got["a-v1-1.0K"].updated_at, got["a-v1-1.0K"].size_tag) == ("c0", "now", "2.0K")
    assert (got["n-v1-1.0K"].created_at, got["n-v1-1.0K"].updated_at) == ("now", "now")
    assert (got["x y"].updated_at, len(got)) == ("2025", 4)


def test_descriptions_name_the_tokenizer(spark):
    df = spark.createDataFrame([("BPE", 1234567), ("char", 0), (None, None)], "t string, n long")
    got = [r[0] for r in df.select(G.default_description(F.col("t"), F.col("n"))).collect()]
    assert got == ["Byte-pair model trained on 1,234,567 characters of text.", "Character-level model.", "Character-level model."]


def test_vocabulary_mismatch(spark):
    _, runs = registry(spark)
    toks = spark.createDataFrame([("a-v1-1.0K", 300), ("b-v4-2.0K", 304)], "folder string, vocab_size int")
    assert [tuple(r) for r in G.vocab_mismatch(runs, toks).collect()] == [("b-v4-2.0K", 300, 304)]


def test_reading_metadata_files(spark, tmp_path):
    good = {"name": "a", "version": 1, "folder": "other", "num_params": 5, "max_iters": None, "config": {"vocab_size": 65}}
    for folder, text in (("a b 0.1", json.dumps(good, indent=2)), ("bad", "{not json"), ("c", json.dumps(good))):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "info.json").write_text(text)
    (tmp_path / "empty").mkdir()
    got = {r.path_folder: r for r in read_runs(spark, str(tmp_path)).collect()}
    assert set(got) == {"a b 0.1", "c"}
    assert got["c"].folder == "other" and got["c"].config.vocab_size == 65
    # The folder on disk decides, not the recorded one.
    folders = spark.createDataFrame([("c", True)], "folder string, has_weights boolean")
    row = G.run_details(folders, read_runs(spark, str(tmp_path))).first()
    assert (row.name, row.display_name) == ("other", "a")


def test_audit(spark):
    rows = [
        (65, 128, 4, 4, 128, "bpe", 10**6), (65, 130, 4, 4, 128, "char", 1000), (0, 0, 0, 0, 0, None, None),
        (65, 128, 4, 4, 128, "bpe", 300_000),
    ]
    df = spark.createDataFrame(
        rows, "vocab_size int, n_embed int, n_head int, n_layer int, block_size int, tokenizer_type string, dataset_chars long"
    )
    got = audit.config_audit(df).collect()
    assert [(r.go, r.band) for r in got] == [(True, "enough"), (False, "very little"), (False, "unknown"), (True, "small")]
    assert got[0].errors == [] and got[0].warnings == []
    assert got[1].errors == ["width is not a multiple of the heads"] and len(got[1].warnings) == 2
    assert len(got[2].errors) == 6
    assert abs(got[0].memory.total - 826368 * 16 / 1048576) < 1e-9
    runs = spark.createDataFrame([("a", 100), ("b", 250)], "folder string, num_params long")
    assert {r.folder: r.multiple for r in audit.size_multiple(runs, F.col("folder") == "a").collect()} == {"a": 1.0, "b": 2.5}
