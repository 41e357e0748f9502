import hashlib
import math
import random
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from textmill.functions import tokens as K
from textmill.operators import ngram as L
from textmill.operators import bpe, stats
from textmill.operators import windows as B
from textmill.operators.chartok import CharTokenizer, char_vocab


@pytest.fixture(scope="module")
def stream(spark):
    rnd = random.Random(2)
    docs = [(i * 3, "".join(rnd.choice("abcd" + chr(300)) for _ in range(rnd.choice([0, 1, 5, 40, 3])))) for i in range(30)]
    return docs, spark.createDataFrame(docs, "i long, t string").repartition(3)


def test_positional_split(stream):
    docs, df = stream
    whole = "".join(t for _, t in sorted(docs))
    cut = int(0.9 * len(whole))
    got = B.split_tokens(df, "t", "i").orderBy("i").collect()
    assert "".join(r.train for r in got) == whole[:cut]
    assert "".join(r.val for r in got) == whole[cut:]
    assert sum(1 for r in got if r.train and r.val) <= 1


@pytest.mark.parametrize("size", [1, 4, 7, 1000])
def test_blocks_are_the_stream(stream, size):
    docs, df = stream
    whole = "".join(t for _, t in sorted(docs))
    got = B.pack_blocks(df, "t", "i", size).orderBy("block_id").collect()
    assert [r.tokens for r in got] == [whole[i : i + size] for i in range(0, len(whole), size)]
    assert [r.block_id for r in got] == list(range(len(got)))


def test_windows_are_slices_of_the_stream(spark, stream):
    docs, df = stream
    whole = "".join(t for _, t in sorted(docs))
    size = 8
    blocks = B.pack_blocks(df, "t", "i", size)
    got = B.sample_windows(
        blocks, F.lit(len(whole)), size, seed=18, draws=blocks.select(F.floor(F.col("block_id") / 4).alias("step"), (F.col("block_id") % 4).alias("slot"))
    ).collect()
    assert len(got) == math.ceil(len(whole) / size)
    for r in got:
        want = int(hashlib.md5(f"18:{r.step}:{r.slot}".encode()).hexdigest()[:15], 16) % (len(whole) - size - 1)
        assert r.start == want
        assert (r.x, r.y) == (whole[want : want + size], whole[want + 1 : want + size + 1])


@pytest.mark.parametrize("n,rows", [(8, 0), (9, 0), (10, 2)])
def test_short_streams_give_no_window(spark, n, rows):
    df = spark.createDataFrame([(0, "x" * n)], "i long, t string")
    got = B.sample_windows(blocks := B.pack_blocks(df, "t", "i", 8), F.lit(n), 8, seed=1, draws=blocks.select(F.lit(0).alias("step"), F.col("block_id").alias("slot"))).collect()
    assert len(got) == rows and all(r.start == 0 for r in got)


def test_prompt_tail_and_targets(spark):
    df = spark.createDataFrame([("abcdef",), ("ab",)], "t string")
    assert [r[0] for r in df.select(K.last_tokens(F.col("t"), 4)).collect()] == ["cdef", "ab"]
    x, y = B.shifted_targets("t")
    assert [tuple(r) for r in df.select(x, y).collect()] == [("abcde", "bcdef"), ("a", "b")]
    with pytest.raises(Exception, match="empty"):
        spark.createDataFrame([("",)], "t string").select(K.last_tokens(F.col("t"), 4)).collect()


def test_preflight(spark):
    df = spark.createDataFrame([("x" * 20,)], "t string")
    r = stats.preflight(df, "t", block_size=8).first()
    assert (r.n_tokens, r.n_train, r.n_val, r.ok) == (20, 18, 2, False) and "validation" in r.errors
    assert "no tokens" in stats.preflight(df.limit(0), "t", block_size=8).first().errors
    assert stats.compression(df.limit(0), "t", F.col("t")).first().chars_per_token == 0.0
    with pytest.raises(ValueError, match="nothing"):
        stats.require_rows(df.limit(0), "nothing")


def plain_model(texts, vocab, k):
    counts = defaultdict(Counter)
    for t in texts:
        for a, b in zip(t, t[1:]):
            counts[a][b] += 1
    return counts, lambda a, b: (counts[a][b] + k) / (sum(counts[a].values()) + k * vocab)


def test_next_token_statistics(spark, stream):
    docs, df = stream
    texts = [t for _, t in docs]
    counts, prob = plain_model(texts, 10, 0.5)
    model = L.lm_fit(df, "t", vocab_size=10, add_k=0.5).cache()
    got = {(chr(r.ctx), chr(r.nxt)): math.exp(r.logp) for r in model.collect()}
    assert got.keys() == {(a, b) for a in counts for b in counts[a]}
    assert all(abs(got[a, b] - prob(a, b)) < 1e-12 for a, b in got)
    held = ["abz", "zz", "a"]
    pairs = [(a, b) for t in held for a, b in zip(t, t[1:])]
    row = L.lm_eval(model, spark.createDataFrame([(t,) for t in held], "t string"), "t", vocab_size=10, add_k=0.5).first()
    assert row.n_pairs == len(pairs)
    assert abs(row.loss - sum(-math.log(prob(a, b)) for a, b in pairs) / len(pairs)) < 1e-12


def test_top_k_keeps_ties_and_temperature_is_bounded(spark):
    rows = [(97, 98, 4), (97, 99, 2), (97, 100, 2), (97, 101, 1)]
    model = spark.createDataFrame([(a, b, n, 9, math.log(n / 9)) for a, b, n in rows], "ctx int, nxt int, n long, ctx_n long, logp double")
    got = {r.nxt: r.p for r in L.lm_next(model, temperature=1.0, top_k=2).collect()}
    assert {k: round(v, 9) for k, v in got.items()} == {98: 0.5, 99: 0.25, 100: 0.25}
    cold = {r.nxt: r.p for r in L.lm_next(model, temperature=0.0, top_k=None).collect()}
    assert cold[98] == 1.0 and sum(cold.values()) == 1.0


def test_generation_equals_the_loop(spark, stream):
    docs, df = stream
    dist = L.lm_next(L.lm_fit(df, "t", vocab_size=10), temperature=1.0, top_k=3).cache()
    table = defaultdict(list)
    for r in sorted(dist.collect(), key=lambda r: (r.ctx, r.nxt)):
        table[chr(r.ctx)].append((chr(r.nxt), r.p))
    prompts = [(i, "abcd"[i % 4]) for i in range(20)] + [(90, "z")]
    got = {r.k: r.tokens for r in L.lm_generate(
        spark.createDataFrame(prompts, "k long, p string"), dist, key="k", tokens="p", steps=10, seed=5, eos="c"
    ).collect()}
    for k, text in prompts:
        done = False
        for step in range(10):
            choices = table.get(text[-1])
            if done or not choices:
                break
            u, acc = int(hashlib.md5(f"5:{k}:{step}".encode()).hexdigest()[:13], 16) / 2**52, 0.0
            for char, p in choices:
                acc += p
                if acc > u:
                    break
            text += char
            done = char == "c"
        assert got[k] == text


def test_backoff_generation_equals_the_loop(spark, stream):
    docs, df = stream
    order = 3
    dist = L.lm_next(L.backoff_fit(df, "t", vocab_size=10, order=order), temperature=1.0, top_k=4).cache()
    table = defaultdict(list)
    for r in sorted(dist.collect(), key=lambda r: (r.ctx, r.nxt)):
        table[r.ctx].append((chr(r.nxt), r.p))
    assert {len(k) for k in table} == {0, 1, 2, 3}
    prompts = [(i, "abcd"[i % 4] * (i % 5)) for i in range(20)] + [(90, "z"), (91, "abz"), (92, "")]
    got = {r.k: r.tokens for r in L.backoff_generate(
        spark.createDataFrame(prompts, "k long, p string"), dist, key="k", tokens="p", order=order, steps=10, seed=5, eos="c"
    ).collect()}
    for k, text in prompts:
        for step in range(10):
            choices = next(table[text[i:]] for i in range(max(0, len(text) - order), len(text) + 1) if text[i:] in table)
            u, acc = int(hashlib.md5(f"5:{k}:{step}".encode()).hexdigest()[:13], 16) / 2**52, 0.0
            for char, p in choices:
                acc += p
                if acc > u:
                    break
            text += char
            if char == "c":
                break
        assert got[k] == text


def test_character_tokens(spark):
    df = spark.createDataFrame([("héa\n",), ("\x00a",), ("",)], "t string")
    vocab = char_vocab(df, "t")
    assert [(r.ch, r.id) for r in vocab.orderBy("id").collect()] == [(c, i) for i, c in enumerate(sorted("\x00\naéh"))]
    tok = CharTokenizer.of(vocab)
    t = tok.encode(F.col("t"))
    rows = df.select("t", t.alias("ids"), tok.decode(t).alias("back")).collect()
    order = sorted("\x00\naéh")
    assert [r.ids for r in rows] == [[order.index(ch) for ch in r.t] for r in rows]
    assert [r.back for r in rows] == [r.t for r in rows]
    nothing = spark.createDataFrame([(None,)], "t string").select(t.alias("i"), tok.decode(t).alias("b")).first()
    assert (nothing.i, nothing.b) == (None, None)
    with pytest.raises(Exception, match="vocabulary"):
        spark.createDataFrame([("x",)], "t string").select(tok.encode(F.col("t"))).collect()
    with pytest.raises(Exception, match="unknown"):
        spark.createDataFrame([([9],)], "t array<int>").select(tok.decode(F.col("t"))).collect()


def test_more_characters_than_two_bytes_hold(spark):
    chars = [chr(i) for i in (*range(1, 0xD800), *range(0xE000, 0xFFFE), *range(0x20000, 0x22000))]
    texts = ["".join(chars[i : i + 5000]) for i in range(0, len(chars), 5000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    tok = CharTokenizer.of(char_vocab(df, "t"))
    assert tok.vocab_size == len(chars) > 70_000
    ids = tok.encode(F.col("t"))
    rows = df.select("t", ids.alias("i"), tok.decode(ids).alias("b")).collect()
    assert all(r.b == r.t for r in rows) and max(max(r.i) for r in rows) == len(chars) - 1


@pytest.mark.parametrize("order", range(4))
@pytest.mark.parametrize("alphabet", ["ab", "".join(map(chr, range(32, 400))), "a" + "".join(map(chr, range(0xE000, 0xFFFF)))])
def test_runs_counted_in_slices_equal_a_plain_count(monkeypatch, order, alphabet):
    monkeypatch.setattr("textmill.operators.bpe_training.SLICE", 50)
    rnd = random.Random(order)
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.choice([order, order + 1, 3, 30, 200]))) for _ in range(60)]
    batches = [pa.RecordBatch.from_pydict({"t": texts[:25]}), pa.RecordBatch.from_pydict({"t": texts[25:]})]
    want = Counter(t[i : i + order + 1] for t in texts for i in range(len(t) - order))
    out = list(L._count_runs(order)(iter(batches)))
    got = Counter()
    for b in out:
        for r in b.to_pylist():
            got[r["ctx"] + chr(r["nxt"])] += r["n"]
    assert got == want
    # Summed over the task, so a run has one row.
    assert order > 2 or sum(b.num_rows for b in out) == len(want)


def test_pairs_are_summed_per_task_and_met_per_slice(monkeypatch):
    monkeypatch.setattr("textmill.operators.bpe_training.SLICE", 64)
    rnd = random.Random(5)
    for alphabet in ("abc", "ab￿", "".join(map(chr, range(300, 4000)))):
        texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(50))) for _ in range(40)]
        keys = rnd.sample(range(100), 40)
        batch = pa.RecordBatch.from_pydict({"i": keys, "t": [t.encode("utf-16-be") for t in texts]})
        want = Counter(t[i : i + 2] for t in texts for i in range(len(t) - 1))
        (summed,) = bpe._count_neighbours(iter([batch.select(["t"])]))
        assert {chr(r["a"]) + chr(r["b"]): r["n"] for r in summed.to_pylist()} == want and summed.num_rows == len(want)
        first, n = {}, Counter()
        parts = list(bpe._count_and_meet(iter([batch])))
        for r in (r for p in parts for r in p.to_pylist()):
            pair = chr(r["a"]) + chr(r["b"])
            n[pair] += r["n"]
            first[pair] = min(first.get(pair, (1 << 30, 0)), (r["row"], r["at"]))
        assert n == want and len(parts) > 10
        assert first == {p: min((k, t.index(p)) for k, t in zip(keys, texts) if p in t) for p in want}
