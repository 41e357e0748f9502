"""Nulls, empty and very long texts, repeated rows, clashing names and empty tables for every operator and stage."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from textmill.llm import decontaminate, forest, langid, minhash, mixing, pii, quality, secrets, toxicity, warc


def by_key(df, key="key"):
    out = {}
    for r in df.collect():
        out.setdefault(r[key], []).append(r)
    return out


def test_langid(odd, none):
    got = by_key(langid.predict(odd, langid.fit(odd)))
    assert sum(map(len, got.values())) == 15
    assert {got[k][0].lang_pred for k in (0, 1, 2, 11)} == {"und"} and got[0][0].score == 0 and got[5][0].lang_pred == "en"
    assert {r.lang_pred for r in langid.predict(odd, langid.fit(none)).collect()} == {"und"}
    assert langid.predict(none, langid.fit(odd)).count() == 0


@pytest.mark.parametrize("operator,label", [(toxicity, "toxic"), (quality, "quality")])
def test_classifiers(odd, none, labels, operator, label):
    got = operator.predict(odd, operator.fit(odd, labels)).collect()
    assert len(got) == 15 and all(0 <= r.score <= 1 for r in got)
    assert {round(r.score, 6) for r in operator.predict(odd, operator.fit(odd, labels.limit(0))).collect()} == {0.5}
    assert operator.predict(none, operator.fit(none, labels)).count() == 0


def test_pii(odd, none):
    model = pii.fit(odd)
    got = by_key(pii.scan(odd, model))
    assert [s.kind for s in got[8][0].spans if s.base] == ["email", "phone"] and got[0][0].spans == []
    masked = by_key(pii.redact(odd, model), "doc_id")
    assert masked[8][0].text == "mail <EMAIL> or <PHONE>, password = Zx81aaaBBBcc99 ok" and masked[8][0].n_chars == len(masked[8][0].text)
    assert masked[0][0].text is None and masked[7][0].text.startswith("word0x0") and pii.redact(odd, model).columns == odd.columns
    assert pii.scan(none, pii.fit(none)).count() == 0


def test_fingerprints(odd, none):
    got = by_key(minhash.compare_neighbours(odd))
    assert sum(map(len, got.values())) == 15 and got[5][0].fingerprint == got[6][0].fingerprint and got[0][0].n_chars == 0
    assert minhash.compare_neighbours(none).count() == 0 and minhash.fingerprints(odd).count() == 15
    one = odd.filter("doc_id = 8")
    row = minhash.compare_neighbours(one).first()
    assert row.near_next == 1.0


def test_classes(odd, none):
    for operator in (forest.similar_texts, minhash.near_duplicates):
        got = by_key(operator(odd))
        assert sum(map(len, got.values())) == 15 and got[6][0].copy_of == 5 and got[6][0].n_copies == 3 and got[5][0].n_links == 0
        assert got[0][0].class_id == got[1][0].class_id == 0 and got[None][0].class_id is None
        assert operator(none).count() == 0


def test_one_per_group(odd, none):
    kept = by_key(forest.one_per_group(odd), "doc_id")
    assert sorted(k for k in kept if k is not None) == [0, 2, 3, 4, 5, 7, 8, 9, 10, 11]
    assert len(kept[5]) == 1 and len(kept[None]) == 2 and forest.one_per_group(none).count() == 0


def test_decontamination(spark, odd, none):
    items = spark.createDataFrame([(1, "the same text of some words here"), (2, None), (3, ""), (4, "five"), (5, "one"), (1, "the same text of some words here")], "item_id long, text string")
    got = {(r.key, r.item) for r in decontaminate.find_passages(odd, items).collect()}
    assert got == {(5, 1), (6, 1), (4, 5)}
    kept = {r.doc_id for r in decontaminate.drop_contaminated(odd, items).collect()}
    assert kept == {0, 1, 2, 3, 7, 8, 9, 10, 11, None}
    assert decontaminate.find_passages(none, items).count() == decontaminate.find_passages(odd, items.limit(0)).count() == 0
    assert decontaminate.drop_contaminated(odd, items.limit(0)).count() == 15


def test_secrets(odd, none):
    got = by_key(secrets.scan(odd))
    assert sum(map(len, got.values())) == 15 and [s.kind for s in got[8][0].spans] == ["assign"]
    assert secrets.scan(none).count() == 0


def test_mixing(odd, none):
    got = mixing.replicate(odd, mixing.tempered_rates(odd)).collect()
    assert all(r["copy"] >= 1 for r in got) and mixing.replicate(none, mixing.tempered_rates(odd)).count() == 0
    assert mixing.replicate(none, mixing.tempered_rates(none)).count() == 0
    twice = odd.filter("doc_id = 5")
    assert len({r["copy"] for r in mixing.replicate(twice, mixing.tempered_rates(twice)).collect()}) * 2 == mixing.replicate(twice, mixing.tempered_rates(twice)).count()


def test_warc(spark, odd, none, tmp_path):
    pages = odd.withColumnsRenamed({"doc_id": "page_id", "text": "html"}).withColumn("url", F.col("value"))
    for name, df, n in (("odd", pages, 15), ("none", pages.limit(0), 0)):
        path = str(tmp_path / name)
        warc.write_archives(warc.resolve(warc.headers_of(df)), path)
        got = warc.follow_revisits(warc.read_archives(spark, path)).collect()
        assert len(got) == n and all(r.payload_bytes is not None for r in got)
    kinds = {r.key: (r.record_type, r.refers_to) for r in warc.resolve(warc.headers_of(pages)).collect()}
    assert kinds[6] == ("revisit", 5) and kinds[1] == ("revisit", 0) and kinds[5] == ("response", None)


def test_stages(spark, odd, none, labels, tmp_path):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "the same text of some words here")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES:
        for df in (odd, none):
            got = stage(spark, df, str(tmp_path))
            assert set(odd.columns) <= set(got.columns) and got.count() >= 0
            if name != "mixing":
                assert got.columns == odd.columns
