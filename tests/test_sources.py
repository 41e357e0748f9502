import json

import pandas as pd
import pytest

from textmill.operators import bpe
from textmill.sources import readers as S
from textmill.sources import tokenizers as TS


def test_sources_and_splits(spark, tmp_path):
    spark.createDataFrame([(1, "a")], "i int, x string").write.parquet(str(tmp_path / "train"))
    spark.createDataFrame([(2, "b")], "i int, y string").write.parquet(str(tmp_path / "test"))
    spark.createDataFrame([(3,)], "i int").write.json(str(tmp_path / "j"))
    registry = {
        "both": S.Source(splits={"train": str(tmp_path / "train"), "test": str(tmp_path / "test")}),
        "j": S.Source(str(tmp_path / "j"), "json"), "gone": S.Source(str(tmp_path / "gone")),
    }
    both = S.read_source(spark, registry, "both")
    assert sorted(tuple(r) for r in both.select("i", "split", "split_ord").collect()) == [(1, "train", 0), (2, "test", 1)]
    assert S.one_split(both, "test").first().x is None
    frames, status = S.read_all(spark, registry, ["both", "j", "gone", "unknown"])
    assert set(frames) == {"both", "j"}
    assert {r.source: r.status for r in status.collect()} == {"both": "read", "j": "read", "gone": "skipped", "unknown": "skipped"}
    with pytest.raises(Exception):
        S.try_source(spark, registry, "gone", needed=True)


def test_whole_corpora_and_guards(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one\n\ntwo", encoding="utf-8")
    (tmp_path / "empty.txt").write_text("")
    assert S.read_corpus(spark, str(tmp_path / "a.txt")).first().value == "one\n\ntwo"
    with pytest.raises(ValueError, match="empty"):
        S.read_corpus(spark, str(tmp_path / "empty.txt"))
    files = {r.path.rsplit("/", 1)[1]: r.length for r in S.list_files(spark, str(tmp_path), "*.txt").collect()}
    assert files == {"a.txt": 8}
    assert S.require(spark, str(tmp_path / "empty.txt"), "the corpus")
    assert S.require(spark, str(tmp_path / "a.txt"), "the corpus") == str(tmp_path / "a.txt")
    with pytest.raises(FileNotFoundError, match="the corpus"):
        S.require(spark, str(tmp_path / "b.txt"), "the corpus")


def test_tokenizer_artifacts(spark, tmp_path):
    tok = bpe.make_tokenizer([(97, 98), (256, 99)])
    TS.save_tokenizer(spark, tok, str(tmp_path / "t"))
    back = TS.load_tokenizer(spark, str(tmp_path / "t"))
    assert (back.merges, back.vocab, back.specials) == (tok.merges, tok.vocab, tok.specials)
    doc = json.loads(TS.tokenizer_json(tok))
    assert (doc["vocab_size"], len(doc["vocab"]), doc["vocab"]["257"]) == (262, 258, [97, 98, 99])

    def saved(name, **changes):
        d = {k: v for k, v in (doc | changes).items() if v is not None}
        (tmp_path / name).write_text(json.dumps(d, indent=1))
        return str(tmp_path / name)

    old = TS.load_tokenizer(spark, saved("v1.json", version=1, special_tokens=None))
    assert old.specials == {} and old.merges == tok.merges
    with pytest.raises(ValueError, match="version 3"):
        TS.load_tokenizer(spark, saved("v3.json", version=3))
    with pytest.raises(ValueError, match="not a"):
        TS.load_tokenizer(spark, saved("other.json", type="wordpiece"))


def test_kinds_of_artifacts(spark, tmp_path):
    docs = {
        "a": {"merges": [], "vocab": {"0": [0], "1": [1]}}, "b": {"vocab_size": 9, "vocab": {"0": [0]}}, "c": {"stoi": {"x": 0, "y": 1, "z": 2}},
        "d": {"model": {"type": "x"}}, "e": {"else": 1},
    }
    for name, d in docs.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "tokenizer.json").write_text(json.dumps(d, indent=2))
    got = {r.path.split("/")[-2]: (r.kind, r.vocab_size) for r in TS.detect_tokenizers(spark, str(tmp_path)).collect()}
    assert got == {"a": ("subword", 2), "b": ("subword", 9), "c": ("char", 3), "d": ("subword", 0), "e": ("unknown", 0)}
    kind, table = TS.open_tokenizer(spark, str(tmp_path / "c" / "tokenizer.json"))
    assert kind == "char" and table.count() == 3
    with pytest.raises(ValueError, match="subword: .*; char: "):
        TS.open_tokenizer(spark, str(tmp_path / "e" / "tokenizer.json"))


def test_a_large_file_is_read_by_many_tasks(spark, tmp_path):
    from textmill.sources.readers import read_corpus

    blocks = [f"block {i} " + "x" * 900 for i in range(3000)]
    (tmp_path / "c.txt").write_text("\n\n".join(blocks) + "\n\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")
    try:
        df = read_corpus(spark, str(tmp_path / "c.txt"), "\n\n")
        assert df.rdd.getNumPartitions() > 4
        assert sorted(r.value for r in df.collect()) == sorted(blocks)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_files_behind_the_stop_are_never_opened(spark, tmp_path):
    """Files whose bytes are no Parquet at all stand behind the cut of both sources."""
    from textmill.plans.builders import build_corpus, read_until_full
    from textmill.plans.recipes import RECIPES
    from textmill.sources.ordered import OrderedFiles

    for key in ("F1", "F2"):
        (tmp_path / key).mkdir()
        for f in range(12):
            path = tmp_path / key / f"part-{f:03}.parquet"
            if f < 3:
                rows = pd.DataFrame({"row_id": range(f * 10, f * 10 + 10), "title": [""] * 10, "text": ["x" * 48] * 10})
                rows.to_parquet(path, row_group_size=5)
            else:
                path.write_bytes(b"not a table")
    frames = {key: OrderedFiles(spark, str(tmp_path / key)) for key in ("F1", "F2")}
    # 20 rows of 50 characters lie in the first two files of F1; F2 gives its first row all the same.
    sizes = read_until_full([(RECIPES[k], f) for k, f in frames.items()], 1000)[1]
    assert sorted((r.source, r.row_key) for r in sizes.collect()) == sorted([("F1:wikipedia", f"train:{i}") for i in range(20)] + [("F2:open_web_math", "train:0")])
    assert build_corpus("facts", frames, budget=1000).count() == 20


def test_leading_key_ranges_cover_each_row_once(spark, monkeypatch):
    from textmill.sources import ordered
    from textmill.sources.ordered import KeyRanges, OrderedFiles

    monkeypatch.setattr(ordered, "FIRST_ROWS", 50)
    keys = [*range(-50, 5000), *range(10**12, 10**12 + 3000), 2**60]
    source = KeyRanges(spark.createDataFrame([(k,) for k in keys], "row_id long"))
    parts = [[r.row_id for r in p.collect()] for p in source.parts("row_id")]
    assert sorted(k for p in parts for k in p) == keys and all(max(a) < min(b) for a, b in zip(parts, parts[1:]) if a and b)
    assert len(parts) > 2 and sorted(r.row_id for r in source.upto(2).collect()) == sorted(parts[0] + parts[1]) and source.upto(0).count() == 0
    assert list(KeyRanges(spark.createDataFrame([], "row_id long")).parts("row_id")) == []
    with pytest.raises(FileNotFoundError):
        OrderedFiles(spark, "/root/testdata/sf0.001", pattern="*.none")
