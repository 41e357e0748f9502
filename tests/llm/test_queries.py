"""The registered queries: against SQL where there is one, else against a plain version."""

import hashlib
import math
import re
import zlib

import duckdb
import pytest

import __spark_entry__ as entry
from textmill.llm import minhash, pii

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in "documents pages benchmark labels conversations".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


@pytest.fixture(scope="module")
def docs(spark):
    return sorted(spark.read.parquet(f"{FOLDER}/documents.parquet").collect())


def run(spark, name):
    return entry.queries()[name](spark, FOLDER).collect()


@pytest.mark.parametrize("name", ["op6_secrets", "op8_mixing", "op9_warc", "op10_jaccard_join", "op12_fill_in_middle", "op13_source_divergence"])
def test_query_equals_sql(spark, duck, name):
    got = entry.queries()[name](spark, FOLDER)
    cur = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(got.columns)
    want = sorted(tuple(str(r[names.index(c)]) for c in sorted(names)) for r in cur.fetchall())
    assert sorted(tuple(str(r[c]) for c in sorted(names)) for r in got.collect()) == want


def test_every_operator_is_registered():
    names = entry.queries()
    assert {int(m[1]) for n in names if (m := re.match(r"op(\d+)_", n))} == set(range(1, 14))
    assert "pipeline" in names


def test_langid(spark, docs):
    got = {r.doc_id: r for r in run(spark, "op1_langid")}
    assert len(got) == len(docs)
    right = [got[d.doc_id].lang_pred == d.lang for d in docs if got[d.doc_id].held_out]
    assert sum(right) / len(right) > 0.95
    assert all(r.held_out == (zlib.crc32(str(k).encode()) % 3 == 1) and 0 <= r.score <= 1 for k, r in got.items())


def test_pii_base_spans_are_the_patterns(spark, docs):
    patterns = [
        r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]",
    ]
    for r in run(spark, "op2_pii"):
        text = docs[r.doc_id].text
        spans, n = [], [0] * 4
        for k, p in enumerate(patterns):
            for m in re.finditer(p, text):
                digits = re.sub("[^0-9]", "", m[0])
                fits = [True, all(int(x) <= 255 for x in m[0].split(".")) if k == 1 else True, 13 <= len(digits) <= 19 and pii.luhn(digits), 9 <= len(digits) <= 15]
                if fits[k]:
                    spans.append(f"{pii.KINDS[k]}:{m.start()}:{m.end()}")
                    n[k] += 1
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == n
        assert r.base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert set(spans) <= set(r.spans.split(","))


@pytest.mark.parametrize("name,label,fold", [("op3_toxicity", "toxic", (3, 1)), ("op7_quality", "quality", (4, 2))])
def test_classifiers(spark, name, label, fold):
    truth = {r.doc_id: r[label] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    got = run(spark, name)
    assert len({r.doc_id for r in got}) == len(got) == 200
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % fold[0] == fold[1]) for r in got)
    assert all(r.predicted == (r.score >= 0.7) for r in got)
    held = [(r.predicted, truth[r.doc_id]) for r in got if r.held_out and r.doc_id in truth]
    assert sum(p == t for p, t in held) / len(held) > 0.75


def plain_fingerprint(text):
    """Minima over Python integers, one shingle after the other."""
    import numpy as np

    from textmill.llm.arrow import shingles

    data = np.frombuffer(text.encode(), np.uint8)
    hashed, _ = shingles(data, np.array([0, len(data)]), minhash.SHINGLE)
    out = []
    for a, b in zip(*minhash.permutations(minhash.PERMUTATIONS), strict=True):
        out.append(min(((int(a) * int(x) + int(b)) % 2**64 >> 32 for x in set(hashed.tolist())), default=2**32 - 1))
    return "".join(f"{x:08x}" for x in out)


def test_fingerprints(spark, docs):
    got = {r.doc_id: r for r in run(spark, "op4_fingerprints")}
    assert len(got) == len(docs)
    parts = lambda s: [s[i : i + 8] for i in range(0, len(s), 8)]
    for i, d in enumerate(docs):
        following = docs[(i + 1) % len(docs)].text
        n = len(d.text)
        changed = d.text[: n - n // 2] + following[: n // 2]
        r = got[d.doc_id]
        assert (r.n_chars, r.edited_sha256) == (n, hashlib.sha256(changed.encode()).hexdigest())
        if i % 20 == 0:
            own, new, nxt = (parts(plain_fingerprint(t)) for t in (d.text, changed, following))
            assert (r.fingerprint, r.edited_fingerprint) == ("".join(own), "".join(new))
            assert math.isclose(r.near_edited, sum(map(str.__eq__, own, new)) / 64)
            assert math.isclose(r.near_next, sum(map(str.__eq__, own, nxt)) / 64)


def test_decontamination_finds_all_that_a_full_search_finds(spark, docs):
    from textmill.llm import decontaminate as D

    items = {r.item_id: r.text.strip() for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()}
    got = {(r.doc_id, r.item_id) for r in run(spark, "op5_decontaminate")}
    want = {(d.doc_id, i) for d in docs for i, t in items.items() if D.distance(d.text, t, int(len(t) * D.MAX_SHARE))}
    assert got == want and got
