"""Packing: ids as the tokenizer's own, levels as a plain loop's, every id in one piece, nothing padded."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from textmill.llm.arrow import flat
from textmill.llm.packing import Encoder, Levels, Packer, pack

public_tokenizers = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def definition():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        return f.read()


@pytest.fixture(scope="module")
def plain(definition):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(definition)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids + [2]


def test_ids_are_those_of_whole_texts(definition, plain):
    draw = random.Random(3)
    letters = "\x00aAéÉé̈ ßΣσς  \n\t  İı中1²'s't\x1c\x85\x0b\x0c\r<|endoftext|>"
    texts = ["".join(draw.choice(letters) for _ in range(draw.randrange(60))) for _ in range(2000)] + ["", "  ", " \x00 ", "x" * 5000]
    encode = Encoder(definition)
    for _ in range(2):  # with and without words met before
        ids, at = encode(*flat(pa.array(texts)))
        assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == [plain(t) for t in texts]


def slow_best(levels: list[int], size: int, n: int) -> set[int]:
    """Levels after which the sum of squares is least, by counting it anew."""
    sums = {}
    for h in [0, *(h for h in range(1, size - n + 1) if h in levels)]:
        after = list(levels)
        if h:
            after.remove(h)
        if h + n < size:
            after.append(h + n)
        sums[h] = sum(after.count(x) ** 2 for x in set(after))
    return {h for h, s in sums.items() if s == min(sums.values())}


def test_levels_minimise_the_sum_of_squares():
    draw, size = random.Random(5), 24
    levels, plain_levels = Levels(size), []
    for _ in range(3000):
        n = draw.randrange(1, size)
        h = levels.best(n)
        assert h == max(slow_best(plain_levels, size, n))
        if h:
            levels.take(h)
            plain_levels.remove(h)
        if h + n < size:
            levels.put(h + n, object())
            plain_levels.append(h + n)


@pytest.mark.parametrize("held", [40, 200, 1 << 20])
def test_every_id_is_in_one_piece(held):
    draw, size = random.Random(7), 32
    docs = [np.arange(draw.choice([1, 5, 20, 21, 32, 64, 75, 400]), dtype=np.uint32) for _ in range(300)]
    packer = Packer(size, held, first=100)
    done = [w for i, d in enumerate(docs) for w in packer.add(i, d)] + list(packer.finish())
    assert len({w.number for w in done}) == len(done) and min(w.number for w in done) >= 100
    assert sum(w.fill < size for w in done) <= 5 and all(w.fill == 1 << w.fill.bit_length() - 1 for w in done)
    pieces = sorted((key, start, ids.tolist()) for w in done for key, _, start, ids in w.pieces)
    for i, d in enumerate(docs):
        own = [(s, ids) for key, s, ids in pieces if key == i]
        assert [x for _, ids in own for x in ids] == d.tolist() and all(ids[0] == s for s, ids in own)
    # Most rests are placed whole.
    assert held < 100 or sum(1 for i, d in enumerate(docs) if sum(p[0] == i for p in pieces) > -(-len(d) // size)) < 30


def check_pieces(rows, texts, plain):
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.key, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at and r.length * 4 == len(r.ids)
            at += r.length
        assert at == 4096 or at == 1 << at.bit_length() - 1
    for key, text in texts.items():
        own = sorted(by_doc[key], key=lambda r: r.start)
        ids = np.frombuffer(b"".join(bytes(r.ids) for r in own), "<u4").tolist()
        assert ids == plain(text) and {r.doc_tokens for r in own} == {len(ids)}


def test_pieces_of_the_documents(spark, sf_dir, definition, plain):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").repartition(3)
    check_pieces(pack(docs, definition).collect(), {r.doc_id: r.text for r in docs.collect()}, plain)


def test_query_gives_checksums_of_its_pieces(spark, sf_dir, plain):
    from textmill.llm.entries import op11

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = op11(spark, sf_dir).collect()
    for r in rows:
        part = plain(texts[r.doc_id])[r.start : r.start + r.length]
        assert len(part) == r.length and r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
    assert sum(r.length for r in rows) == sum(len(plain(t)) for t in texts.values())


def test_odd_rows(odd, none, definition, plain):
    rows = pack(odd, definition).collect()
    totals = {}
    for r in rows:
        totals[r.key] = totals.get(r.key, 0) + r.length
    assert totals[0] == totals[1] == totals[2] == 1 and totals[5] == 2 * len(plain("the same text of some words here"))
    assert totals[10] == len(plain("x" * 300_000)) and totals[None] == len(plain("no key")) + 1
    assert pack(none, definition).count() == 0
    assert {r.key for r in pack(odd, definition, key="key").collect()} == {"k", None}
