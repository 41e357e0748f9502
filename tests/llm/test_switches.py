"""Results that must mean the same at every size: samples of few large rows, calibration, rare personal data, copied keys."""

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from textmill.llm import langid, pii, secrets, toxicity
from textmill.llm.arrow import flat
from textmill.llm.sampling import bounded


def test_a_language_of_one_large_text_is_learned(spark):
    german = "der hund und die katze sind im garten und schlafen nicht " * 2000
    english = [(i, "the dog and the cat are in the garden and do not sleep " * 20, "en") for i in range(49)]
    docs = spark.createDataFrame([(99, german, "de"), *english], "doc_id long, text string, lang string")
    model = langid.fit(docs, sample_bytes=3_000)
    assert sorted(model.langs) == ["de", "en"]
    asked = spark.createDataFrame([(1, "die katze und der hund schlafen"), (2, "the cat and the dog sleep")], "doc_id long, text string")
    assert {r.key: r.lang_pred for r in langid.predict(asked, model).collect()} == {1: "de", 2: "en"}


def test_samples_have_a_row_of_each_group(spark):
    rows = spark.createDataFrame([(i, f"g{i % 3}" if i % 3 else None, 10**6) for i in range(60)], "k long, g string, w long")
    got = bounded(rows, "g", "k", 1, F.col("w")).groupBy("g").count().collect()
    assert {(r.g, r["count"]) for r in got} == {(None, 1), ("g1", 1), ("g2", 1)}


def scored_plainly(text: str, model: toxicity.Model) -> float:
    """The score by its definition: words, windows, n-grams of distinct words one by one."""
    folded = bytes(toxicity._FOLD[np.frombuffer(text.encode(), np.uint8)])
    words = [w for w in folded.split(b" ") if w]
    best = -np.inf
    for shift in toxicity.SHIFTS:
        first = toxicity.WINDOW - shift
        windows = [words[:first]] + [words[i : i + toxicity.WINDOW] for i in range(first, len(words), toxicity.WINDOW)]
        for window in windows:
            total, n = 0.0, 0
            for word in set(window):
                body = b" " + word + b" "
                for size in range(toxicity.MIN_N, toxicity.MAX_N + 1):
                    for i in range(len(body) - size + 1):
                        h = 0
                        for byte in body[i : i + size]:
                            h = (h * 0x01000193 + byte + 1) & 0xFFFFFFFF
                        h = ((h ^ (h >> 15)) * 0x85EBCA6B & 0xFFFFFFFF) >> (32 - toxicity.BITS)
                        total, n = total + float(model.weights[h]), n + 1
            best = max(best, model.bias + total / max(toxicity.FLOOR, n))
    return 1 / (1 + np.exp(-np.clip(best, -60, 60)))


def test_scores_equal_a_plain_scorer(spark, sf_dir):
    rng = np.random.default_rng(5)
    model = toxicity.Model(rng.normal(0, 4, 1 << toxicity.BITS), -0.3)
    texts = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    texts = [t for t in texts if t is not None and len(t) < 4000] + ["", " ", "ab", "Ä ö ß", "one-two_three", "a " * 300, "same same same " * 40]
    got = model.score(*flat(pa.array(texts)))
    assert np.allclose(got, [scored_plainly(t, model) for t in texts], atol=2e-5)


def test_words_on_either_side_of_a_border_lie_in_one_window():
    weights = np.zeros(1 << toxicity.BITS)
    model = toxicity.Model(weights, 0.0)
    for word in ("zqxwv", "kjhgf"):
        folded, _ = toxicity.marked(np.frombuffer(word.encode(), np.uint8), np.array([0, len(word)]))
        for bucket, inner in toxicity.ngrams(folded, np.ones(len(folded), bool)):
            model.weights[bucket[inner]] = 100
    words = [f"w{i}" for i in range(100)]
    scores = []
    for at in range(30, 60):
        text = " ".join([*words[:at], "zqxwv", "kjhgf", *words[at:]])
        scores.append(float(model.odds(*flat(pa.array([text])))[0].max()))
    assert min(scores) > 0.9 * max(scores)


def labelled(n, rng):
    bad, words = ["blarg", "snorf", "gruk"], [f"word{i}" for i in range(200)]
    label = (np.arange(n) % 4 == 0).astype(float)
    texts = [" ".join([*rng.choice(words, 30), *(rng.choice(bad, 10) if x else []), *rng.choice(words, 30)]) for x in label]
    return flat(pa.array(texts)), label


def test_the_threshold_is_set_alike_at_every_size():
    """Of rows never seen, few clean ones reach 0.7 however little was learned from; with enough to learn from, the toxic ones do."""
    rng = np.random.default_rng(3)
    asked, truth = labelled(400, rng)
    caught = []
    for n in (40, 200, 800):
        rows, label = labelled(n, rng)
        said = toxicity.train(*rows, label).score(*asked) >= toxicity.THRESHOLD
        assert (said & (truth == 0)).sum() <= 4
        caught.append(int((said & (truth == 1)).sum()))
    assert caught[1] >= 80 and caught[2] >= 95


def test_rare_personal_data_is_learned_from(spark):
    """One text in 400 has an address, and the bounded sample of texts has none of those."""
    words = "some plain words without any data in them "
    rows = [(i, words * 3 + (f"write to user{i}@mail.example.org now" if i % 400 == 7 else "")) for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    drawn = bounded(docs.withColumn("g", F.lit(1)), "g", "doc_id", 20).collect()
    assert drawn and not any("@" in r.text for r in drawn)
    assert np.abs(pii.fit(docs, sample_rows=20).weights).sum() > 0
    assert np.abs(pii.fit(docs.where("text not like '%@%'"), sample_rows=20).weights).sum() == 0


def test_a_key_pasted_in_many_documents_of_one_owner_is_copied(spark):
    vendor, own = "ghp_" + "a1B2" * 9, "ghp_" + "Zz09" * 9
    rows = [(i, f"see {vendor} here", "hot") for i in range(50)] + [(60, f"see {own} here", "hot"), (61, f"and {own}", "hot")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.key: [(s.kind, s.n_repos, s.n_owners) for s in r.spans] for r in secrets.scan(docs).collect()}
    assert got[0] == [] and got[60] == got[61] == [("vendor", 2, 1)]
    both = secrets.digest(secrets.scan(docs, live_repos=50)).collect()
    assert {r.doc_id: r.most_repos for r in both}[0] == 50 and all(re.fullmatch(r"vendor:\d+:\d+", r.spans) for r in both)
