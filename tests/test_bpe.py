import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from textmill import catalog
from textmill.functions import tokens as K
from textmill.operators import bpe
from textmill.operators import bpe_training as training


def merge(seq, pair, new):
    out, i = [], 0
    while i < len(seq):
        if i + 1 < len(seq) and (seq[i], seq[i + 1]) == pair:
            out.append(new)
            i += 2
        else:
            out.append(seq[i])
            i += 1
    return out


def plain_train(texts, size, low=2):
    """One merge per pass over all sequences; ties go to the pair met first."""
    seqs = [list(t.encode()) for t in texts]
    merges, log = [], []
    while 256 + len(merges) < size - 4:
        counts = Counter()
        for s in seqs:
            counts.update(zip(s, s[1:]))
        if not counts:
            break
        pair, n = counts.most_common(1)[0]
        if n < low:
            break
        seqs = [merge(s, pair, 256 + len(merges)) for s in seqs]
        merges.append(pair)
        log.append((len(merges), *pair, n, sum(map(len, seqs))))
    return merges, log


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "i long, t string")


@pytest.mark.parametrize("seed", range(5))
def test_training_equals_one_merge_at_a_time(spark, seed):
    rnd = random.Random(seed)
    alphabet = ["ab", "abc ", "aé ", "the cat sat"][seed % 4]
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(0, 60))) for _ in range([1, 6][seed % 2])]
    texts.append("aaaa aaa")
    tok = bpe.bpe_train(frame(spark, texts), "t", "i", vocab_size=260 + 18)
    merges, log = plain_train([t for t in texts if t], 260 + 18)
    assert tok.merges == merges
    assert tok.log == log


def test_many_ties_and_long_training(spark):
    texts = ["".join(chr(97 + (i * 7 + j) % 26) for j in range(40)) for i in range(4)]
    tok = bpe.bpe_train(frame(spark, texts), "t", "i", vocab_size=260 + 30)
    assert tok.merges == plain_train(texts, 260 + 30)[0]


def test_independent_prefix_stops_where_order_is_unsure():
    f = bpe.independent_prefix
    assert f([("ab", 9), ("cd", 8), ("be", 7), ("fg", 6)], 2, 10) == [("ab", 9), ("cd", 8)]
    assert f([("ab", 9), ("ac", 8), ("db", 7), ("ea", 6)], 2, 10) == [("ab", 9), ("ac", 8), ("db", 7)]
    assert f([("ab", 9), ("cc", 8), ("de", 7)], 2, 10) == [("ab", 9), ("cc", 8)]
    assert f([("ab", 9), ("cd", 8)], 2, 1) == [("ab", 9)]
    assert f([("ab", 9), ("cd", 1)], 2, 10) == [("ab", 9)]


@pytest.mark.parametrize("seed", range(3))
def test_pairs_of_a_side_are_merged_in_one_pass(spark, seed):
    rnd = random.Random(seed)
    words = ["a" + x for x in "bcdef"] + [x + "b" for x in "cdef"] + ["ba", "cab", "abab"]
    texts = ["".join(rnd.choice(words) for _ in range(60)) for _ in range(4)]
    tok = bpe.bpe_train(frame(spark, texts), "t", "i", vocab_size=260 + 40)
    merges, log = plain_train(texts, 260 + 40)
    assert tok.merges == merges
    assert tok.log == log


def test_long_training_on_documents(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("length(text) between 300 and 2000").orderBy("doc_id").limit(16)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    rows = catalog.queries()["bpe_train_large"](spark, str(tmp_path)).orderBy("step").collect()
    merges, log = plain_train([r.text for r in docs.select("doc_id", "text").orderBy("doc_id").collect()], 260 + 512)
    assert len(rows) > 500 and [(r.left_id, r.right_id) for r in rows] == merges
    assert [tuple(r) for r in rows] == log


def test_training_errors_and_stops(spark):
    df = frame(spark, ["abab"])
    for size in (0, 256, 260):
        with pytest.raises(ValueError, match="260"):
            bpe.bpe_train(df, "t", "i", vocab_size=size)
    assert bpe.bpe_train(df, "t", "i", vocab_size=261).merges == [(97, 98)]
    assert bpe.bpe_train(frame(spark, ["a"]), "t", "i", vocab_size=300).merges == []
    assert bpe.bpe_train(df, "t", "i", vocab_size=300, min_pair_frequency=3).merges == []
    with pytest.raises(ValueError, match="empty"):
        bpe.bpe_train(frame(spark, ["", None]), "t", "i")


def plain_encode(text, merges):
    seq = list(text.encode())
    rank = {p: i for i, p in enumerate(merges)}
    while True:
        here = [p for p in zip(seq, seq[1:]) if p in rank]
        if not here:
            return seq
        best = min(here, key=rank.get)
        seq = merge(seq, best, 256 + rank[best])


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="abé \n😀", max_size=30), min_size=1, max_size=8))
def test_encoding_takes_the_lowest_rank_first_and_round_trips(spark, texts):
    merges, _ = plain_train(texts, 260 + 12)
    tok = bpe.make_tokenizer(merges)
    t = bpe.encode_text(F.col("t"), tok)
    rows = frame(spark, texts).select("t", K.token_ids(t).alias("ids"), bpe.decode_tokens(t, tok).alias("back")).collect()
    assert [r.ids for r in rows] == [plain_encode(r.t, merges) for r in rows]
    assert [r.back for r in rows] == [r.t for r in rows]
    assert bpe.round_trip_failures(frame(spark, texts), "t", tok).count() == 0


def test_round_trip_of_awkward_texts(spark):
    texts = ["Hello, world!", "naïve café", "😀👩‍👩‍👧 é", "", "a<EOS>b", "\x00\x7f\r\n\t", "퟿￿"]
    tok = bpe.make_tokenizer(plain_train(texts, 270)[0])
    assert bpe.round_trip_failures(frame(spark, texts), "t", tok).count() == 0
    ids = K.token_ids(bpe.encode_text(F.col("t"), tok))
    back = frame(spark, texts).select("t", bpe.decode_ids(ids, tok).alias("b")).collect()
    assert all(r.t == r.b for r in back)


def test_specials(spark):
    tok = bpe.make_tokenizer([(97, 98)])
    assert list(tok.specials.values()) == [257, 258, 259, 260]
    assert (tok.bpe_vocab_size, tok.vocab_size) == (257, 261)
    shared = bpe.make_tokenizer([(97, 98)], special_ids="shared")
    assert set(shared.specials.values()) == {257}
    t = bpe.encode_with_specials(F.col("t"), tok)
    rows = frame(spark, ["ab<EOS>ab", "<EOS", "<BOS><BOS>", "a<PAD>b"]).select(
        K.token_ids(t).alias("ids"), bpe.decode_tokens(t, tok).alias("plain"),
        bpe.decode_tokens(t, tok, skip_specials=False).alias("shown"),
        K.token_ids(bpe.with_bos_eos(t, tok)).alias("framed"),
    ).collect()
    assert [r.ids for r in rows] == [[256, 260, 256], [60, 69, 79, 83], [259, 259], [97, 257, 98]]
    assert [r.plain for r in rows] == ["abab", "<EOS", "", "ab"]
    assert [r.shown for r in rows] == ["ab<EOS>ab", "<EOS", "<BOS><BOS>", "a<PAD>b"]
    assert rows[0].framed == [259, 256, 260, 256, 260]
    with pytest.raises(ValueError, match="BOS"):
        bpe.with_bos_eos(t, bpe.Tokenizer([], {i: bytes([i]) for i in range(256)}, {}))


def test_equal_byte_strings_give_the_last_id(spark):
    tok = bpe.make_tokenizer([(97, 98), (98, 99), (256, 99), (97, 257)])
    assert tok.vocab[258] == tok.vocab[259] == b"abc"
    got = frame(spark, ["abc"]).select(K.token_ids(bpe.encode_text(F.col("t"), tok)).alias("i")).first().i
    assert got == [259]
    broken = bpe.Tokenizer([(97, 98)], {i: bytes([i]) for i in range(256)}, {})
    with pytest.raises(ValueError, match="not in the vocabulary"):
        bpe.merge_steps(broken)


def test_decoding_bad_input(spark):
    tok = bpe.make_tokenizer([(97, 98)])
    df = spark.createDataFrame([([0xE2, 0x82],), ([97, 0xFF, 98],)], "i array<int>")
    got = df.select(bpe.decode_tokens(K.tokens_from_ids(F.col("i")), tok).alias("t")).collect()
    assert [r.t for r in got] == ["�", "a�b"]
    with pytest.raises(Exception, match="unknown"):
        spark.createDataFrame([([999],)], "i array<int>").select(bpe.decode_tokens(K.tokens_from_ids(F.col("i")), tok)).collect()


def test_decoding_by_a_table(spark):
    vocab = spark.createDataFrame([(0xD801, bytearray(b"\xc3")), (300, bytearray(b"the ")), (7, bytearray(b"\xa9"))], "id int, bytes binary")
    df = spark.createDataFrame([(0, [300, 0xD801, 7, 300]), (1, []), (2, None), (3, [7])], "k int, i array<int>")
    got = df.orderBy("k").select(bpe.decode_by_table(K.tokens_from_ids(F.col("i")), vocab).alias("t")).collect()
    assert [r.t for r in got] == ["the éthe ", "", None, "\ufffd"]
    for bad in (8, 301, 0xD802):
        with pytest.raises(Exception, match="unknown"):
            spark.createDataFrame([([bad],)], "i array<int>").select(bpe.decode_by_table(K.tokens_from_ids(F.col("i")), vocab)).collect()


@pytest.mark.parametrize("name", ["decode_join", "decode_join_large"])
def test_decoding_by_a_table_has_no_expression_per_token(spark, name):
    plan = catalog.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan and "collect_list" not in plan


def test_ids_and_characters(spark):
    ids = [0, 10, 255, 256, 300, 4351, 0xD7FF, 0xD800, 0xDFFF, K.MAX_ID]
    df = spark.createDataFrame([(ids,)], "i array<int>")
    assert df.select(K.token_ids(K.tokens_from_ids(F.col("i"))).alias("o")).first().o == ids
    assert [K.id_of(K.char_of(i)) for i in ids] == ids
    with pytest.raises(ValueError):
        K.char_of(K.MAX_ID + 1)


def test_pair_counts_overlap_and_stay_in_their_row(spark):
    df = spark.createDataFrame([("aaa",), ("ab",), ("a",), ("",), ("b",)], "t string").coalesce(1)
    got = {(chr(r.a) + chr(r.b)): r.n for r in bpe.pair_counts(df, "t").collect()}
    assert got == {"aa": 2, "ab": 1}


def test_batches_equal_the_loop(spark, monkeypatch):
    rnd = random.Random(8)
    texts = ["".join(rnd.choice(["the ", "cat", "é", "aa", "a", "\n", "<EOS>", "zq"]) for _ in range(rnd.choice([0, 3, 20, 90]))) for _ in range(40)]
    merges, _ = plain_train(texts[:20], 260 + 40)
    tok = bpe.make_tokenizer(merges)
    for chunk in (1, 50, 1 << 22):
        monkeypatch.setattr(bpe.BatchEncoder, "CHUNK", chunk)
        encoder = bpe.BatchEncoder(tok)
        assert [[K.id_of(c) for c in t] for t in encoder.encode([t.encode() for t in texts])] == [plain_encode(t, merges) for t in texts]
    df = frame(spark, [*texts, None])
    got = df.orderBy("i").select(bpe.encode_with_specials(F.col("t"), tok).alias("s")).collect()
    eos = K.char_of(tok.specials["<EOS>"])
    for t, r in zip([*texts, None], got, strict=True):
        want = None if t is None else eos.join("".join(K.char_of(i) for i in plain_encode(p, merges)) for p in t.split("<EOS>"))
        assert r.s == want


@pytest.mark.parametrize("merges", [[], [(97, 97), (256, 256), (256, 97)], [(97, 98), (256, 97), (98, 97)]])
def test_runs_and_overlaps(merges):
    encoder = bpe.BatchEncoder(bpe.make_tokenizer(merges))
    texts = ["a" * n for n in range(20)] + ["ab" * n for n in range(9)] + ["aab" * 7, "b", ""]
    assert [[K.id_of(c) for c in t] for t in encoder.encode([t.encode() for t in texts])] == [plain_encode(t, merges) for t in texts]


def test_first_look_is_at_merged_byte_pairs_alone(monkeypatch):
    merges = [(97, 98), (0, 0), (256, 256), (98, 0)]
    encoder, seen = bpe.BatchEncoder(bpe.make_tokenizer(merges)), []
    rank = encoder._rank
    monkeypatch.setattr(encoder, "_rank", lambda left, right: (seen.append(len(left)), rank(left, right))[1])
    texts = ["", "\0", "x" * 5000 + "abab", "b", "", "\0\0\0", "a", "b\0", "\0b", "x" * 5000]
    assert [[K.id_of(c) for c in t] for t in encoder.encode([t.encode() for t in texts])] == [plain_encode(t, merges) for t in texts]
    assert sum(seen) < 30


def test_large_vocabulary(spark):
    rnd = random.Random(9)
    words = [" " + "".join(rnd.choice("abcdefé") for _ in range(rnd.randrange(2, 9))) for _ in range(1200)]
    tok = bpe.word_tokenizer(words)
    assert len(tok.merges) > 2000 and {w.encode() for w in words} <= set(tok.vocab.values())
    texts = ["".join(rnd.choice(words) for _ in range(40)) for _ in range(30)]
    encoder = bpe.BatchEncoder(tok)
    assert [[K.id_of(c) for c in t] for t in encoder.encode([t.encode() for t in texts])] == [plain_encode(t, tok.merges) for t in texts]
    assert bpe.round_trip_failures(frame(spark, texts), "t", tok).count() == 0


# ---------------------------------------------------------------- incremental training


@pytest.mark.parametrize("held", [1, 400, 1 << 25])
def test_a_task_gives_each_run_once(monkeypatch, held):
    rnd = random.Random(4)
    texts = ["".join(rnd.choice("abcx") for _ in range(rnd.randrange(1, 40))).encode() for _ in range(300)]
    order = rnd.sample(range(1000), len(texts))
    hot = np.array(sorted(a << 16 | b for a in b"abc" for b in b"abc"), np.int64)
    want = {}
    for o, t in zip(order, texts, strict=True):
        for m in re.finditer(rb"[abc]{2,}", t):
            n, met = want.get(m[0], (0, (o, m.start())))
            want[m[0]] = (n + 1, min(met, (o, m.start())))
    rows = pa.RecordBatch.from_arrays([pa.array(order, pa.int64()), pa.array(texts, pa.binary())], names=["i", "ids"])
    monkeypatch.setattr(training, "SLICE", 100)
    monkeypatch.setattr(training, "HELD", held)
    found = list(training._hot_runs(hot, np.ones(256, np.int64), np.uint8, "i")(iter([rows.slice(0, 170), rows.slice(170)])))
    got = {}
    for r in (r for b in found for r in b.to_pylist()):
        key = np.frombuffer(r["ids"], np.uint16).astype(np.uint8).tobytes()
        n, met = got.get(key, (0, (r["i"], r["at"])))
        got[key] = (n + r["n"], min(met, (r["i"], r["at"])))
    assert got == want
    assert held < 1 << 25 or sum(b.num_rows for b in found) == len(want)


def test_changes_of_a_merge_are_those_of_counting_anew():
    rnd = random.Random(11)
    for _ in range(400):
        rows = [bytes(rnd.choice(b"aab") for _ in range(rnd.randrange(1, 14))) for _ in range(3)]
        ids = training.flat_ids(pa.array([np.frombuffer(r, np.uint8).astype("<u2").tobytes() for r in rows], pa.binary()))

        def counted(x):
            return Counter(training._keys(x).tolist())

        for product, (left, right) in enumerate([(97, 97), (97, 98), (256, 97), (256, 256)], 256):
            after, n, gone, came = training.merge(ids, (left, right, product))
            text = "".join(map(chr, ids)).replace(chr(left) + chr(right), chr(product))
            assert "".join(map(chr, after)) == text and n == len(ids) - len(after)
            want = counted(ids)
            want.subtract(gone.tolist())
            want.update(came.tolist())
            assert +want == counted(after) and min(want.values(), default=0) >= 0
            ids = after


def test_first_places_are_told_for_wanted_and_new_pairs():
    ids = training.flat_ids(pa.array([np.array(r, "<u2").tobytes() for r in ([1, 2, 300, 1, 2], [2, 1, 301])], pa.binary()))
    pairs, at = training.first_places(ids, np.array(sorted([1 << 16 | 2, 5 << 16 | 5])), 300)
    got = {(k >> 16, k & 0xFFFF): i for k, i in zip(pairs.tolist(), at.tolist())}
    assert got == {(1, 2): 1, (2, 300): 2, (300, 1): 3, (1, 301): 8}
    assert training.first_places(ids, np.zeros(0, np.int64), training.BORDER)[0].tolist() == []


def test_ranking_stops_where_places_are_not_known():
    pairs = training.Pairs()
    pairs.add(np.array([1, 2, 3, 4]), np.array([9, 7, 7, 5]))
    assert pairs.ranked({1: (0, 0), 2: (1, 0), 4: (0, 2)}) == [((0, 1), 9)]
    assert [k for k, _ in pairs.ranked({1: (0, 0), 2: (1, 0), 3: (0, 9), 4: (2, 2)})] == [(0, 1), (0, 3), (0, 2), (0, 4)]
    pairs.add(np.array([1, 5]), np.array([-9, 2]))
    assert pairs.keys.tolist() == [2, 3, 4, 5] and pairs.leading(1, 1).tolist() == [2, 3]


@pytest.mark.parametrize("writes", [1, 5, 1000])
def test_training_through_many_writes_equals_a_plain_loop(spark, monkeypatch, writes):
    monkeypatch.setattr(training, "MERGES_PER_WRITE", writes)
    monkeypatch.setattr(training, "LEADING", 3)
    monkeypatch.setattr(training, "SLICE", 64)
    rnd = random.Random(writes)
    texts = ["".join(rnd.choice("aaab ") for _ in range(rnd.randrange(40))) for _ in range(30)] + [None, "", "é中é中é中", "aaaaaaaa"]
    tok = bpe.bpe_train(frame(spark, texts), "t", "i", vocab_size=260 + 40)
    merges, log = plain_train([t or "" for t in texts], 260 + 40)
    assert tok.merges == merges and tok.log == log


def test_training_looks_at_different_runs_only(spark, monkeypatch):
    rnd = random.Random(4)
    rare = "".join(map(chr, range(48, 123)))
    texts = ["".join(rnd.choice(["the", "cat", "and"]) + "".join(rnd.choice(rare) for _ in range(4)) for _ in range(rnd.randrange(40))) for _ in range(200)]
    seen, real = [], training._learn_runs

    def spied(state, *rest):
        seen.append(state.select(F.sum(F.length("ids") / 2)).first()[0])
        return real(state, *rest)

    monkeypatch.setattr(training, "_learn_runs", spied)
    tok = bpe.bpe_train(frame(spark, texts), "t", "i", vocab_size=260 + 6)
    assert (tok.merges, tok.log) == plain_train(texts, 260 + 6)
    assert max(seen) * 5 < sum(map(len, texts))


def test_groups_of_merges_equal_one_after_another():
    rnd = random.Random(3)
    for _ in range(200):
        ids = training.flat_ids(pa.array([bytes(rnd.choice(b"abc") for _ in range(rnd.randrange(1, 30))) for _ in range(3)], pa.binary()), np.uint8)
        steps = []
        while len(steps) < 6:
            pair = tuple(rnd.choice([97, 98, 99, *range(256, 256 + len(steps))]) for _ in range(2))
            if pair not in [s[:2] for s in steps]:
                steps.append((*pair, 256 + len(steps)))
        groups, one, swept = training.commuting(steps), ids, ids
        for step in steps:
            one = training.merge(one, step)[0]
        for group in groups:
            swept = training.merge_group(swept, group)
        assert [s for g in groups for s in g] == steps and one.tolist() == swept.tolist()


def test_rows_are_worked_on_in_parts():
    texts = pa.array(["abcd", None, "", "ef", "g" * 30, "h", None])
    seen = []

    def work(part):
        seen.append(part.to_pylist())
        return part

    assert bpe.in_parts(texts, work, pa.string(), 5).to_pylist() == texts.to_pylist()
    assert seen == [["abcd", None, ""], ["ef"], ["g" * 30], ["h", None]]
    assert bpe.in_parts(texts.slice(0, 0), work, pa.string()).to_pylist() == []
    lists = pa.array([[1, 2, 3], None, [4], []])
    assert bpe.in_parts(lists.slice(1), work, lists.type, 1).to_pylist() == [None, [4], []] and len(seen) == 5
