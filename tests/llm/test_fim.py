"""Fill-in-middle: ranks against counting, cuts against a plain split, outputs taken apart again."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from textmill.llm.arrow import flat
from textmill.llm.fim import Markers, Units, WaveletMatrix, transform

UNIT = {"lines": r"[^\n]*\n|[^\n]+", "words": r"[ \t\n\v\f\r]*[^ \t\n\v\f\r]+|[ \t\n\v\f\r]+", "chars": r"(?s)."}


def test_ranks():
    symbols = np.random.default_rng(1).integers(0, 5, 1000).astype(np.uint8)
    matrix, at = WaveletMatrix(symbols), np.arange(1001)
    for s in range(8):
        assert matrix.rank(s, at).tolist() == [0, *np.cumsum(symbols == s).tolist()]


@pytest.mark.parametrize("unit", UNIT)
def test_cuts_at_units(unit):
    draw = random.Random(2)
    texts = ["".join(draw.choice("ab é中\n\n \t\r😀") for _ in range(draw.randrange(30))) for _ in range(2000)] + ["", "\n", " "]
    parts = [re.findall(UNIT[unit], t) for t in texts]
    data, offsets = flat(pa.array(texts))
    units = Units(data, offsets, unit)
    assert units.count.tolist() == [len(p) for p in parts]
    k = np.array([draw.randrange(len(p) + 1) for p in parts])
    ends = units.ends(k)
    heads = ["".join(p[:n]) for p, n in zip(parts, k.tolist())]
    assert [data[a:b].tobytes().decode() for a, b in zip(offsets, ends)] == heads
    assert units.chars(offsets[:-1], ends).tolist() == [len(h) for h in heads]


def slow(key, text, unit, fim_share, spm_share):
    text = text or ""
    parts = re.findall(UNIT[unit], text)
    digest = hashlib.sha256(f"7:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    a, b = sorted((h1 % (len(parts) + 1), h2 % (len(parts) + 1)))
    prefix, middle, suffix = ("".join(p) for p in (parts[:a], parts[a:b], parts[b:]))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= fim_share:
        return len(parts), "plain", None, None, text, text
    if h4 % 100 < spm_share:
        return len(parts), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}", text
    return len(parts), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}", text


@pytest.mark.parametrize("unit,fim_share,spm_share", [("lines", 100, 50), ("words", 70, 0), ("chars", 90, 100)])
def test_all_documents_as_by_a_plain_loop(spark, sf_dir, unit, fim_share, spm_share):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = {r.key: tuple(r)[1:] for r in transform(docs, unit=unit, fim_share=fim_share, spm_share=spm_share).collect()}
    want = {r.doc_id: slow(r.doc_id, r.text, unit, fim_share, spm_share) for r in docs.collect()}
    assert got == want and len({w[1] for w in want.values()}) == (3 if fim_share < 100 and 0 < spm_share < 100 else 2)


def test_outputs_are_taken_apart_where_markers_meet_their_own_letters():
    marks = Markers()
    draw = random.Random(4)
    for _ in range(2000):
        parts = ["".join(draw.choice("<PSM>a") for _ in range(draw.randrange(5))).encode() for _ in range(3)]
        if not marks.inside(b"".join(parts)):
            for form in ("psm", "spm"):
                assert marks.restore(marks.join(form, *parts), form) == b"".join(parts)


def test_odd_rows(spark, odd, none):
    got = {}
    for r in transform(odd).collect():
        got.setdefault(r.key, []).append(tuple(r)[1:])
    assert got[0] == got[1] == [(0, "plain", None, None, "", "")] and len(got[5]) == 2 and len(set(got[5])) == 1 and len(got[None]) == 2
    assert got[10][0] == slow(10, "x" * 300_000, "lines", 100, 50) and got[2] == [slow(2, " \n\t ", "lines", 100, 50)]
    marked = spark.createDataFrame([(1, "a\n<S>\nb"), (2, "a\nb")], "doc_id long, text string")
    assert {r.key: r.form == "plain" for r in transform(marked).collect()} == {1: True, 2: False}
    assert transform(none).count() == 0 and {r.key for r in transform(odd, key="key").collect()} == {"k", None}
