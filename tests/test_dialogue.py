import random

import pytest
from pyspark.sql import functions as F

from textmill.operators import dialogue as D


@pytest.fixture(scope="module")
def talk(spark):
    rnd = random.Random(3)
    rows = []
    for conv in range(40):
        turns = sorted(rnd.sample(range(-3, 60), rnd.randrange(0, 25))) if conv % 2 else range(rnd.randrange(0, 4))
        rows += [(conv, t, rnd.choice(["user", "bot"]), rnd.choice(["", " ", "a", "b\n", "cc"])) for t in turns]
    return rows, spark.createDataFrame(rows, "conv long, turn long, who string, text string")


def by_conv(rows):
    out = {}
    for r in sorted(rows):
        out.setdefault(r[0], []).append(r)
    return out


def test_blocks_and_lines_make_the_same_text(talk):
    rows, df = talk
    want = {}
    for conv, turns in by_conv(rows).items():
        lines = [f"{w}: {t.strip()}" for _, _, w, t in turns if t.strip()]
        if len(lines) >= 2:
            want[conv] = "[CONVERSATION]\n" + "\n".join(lines) + "\n\n"
    got = D.conversation_blocks(df, "conv", "turn", F.col("who"), F.col("text")).collect()
    assert {r.conv: r.block for r in got} == want and len(got) == len(want)
    assert all(r.weight == len(r.block) for r in got)
    lines = D.conversation_lines(df, "conv", "turn", F.col("who"), F.col("text"))
    sizes = D.conversation_sizes(lines, "conv", "turn")
    assert {r.conv: (r.weight, r.n_turns) for r in sizes.collect()} == {r.conv: (r.weight, r.n_turns) for r in got}
    parts = {}
    for r in sorted(D.conversation_parts(lines, sizes, "conv", "turn").collect()):
        parts[r.conv] = parts.get(r.conv, "") + r.part
    assert parts == want


def test_a_dialogue_of_many_rows_is_one_row(spark):
    df = spark.range(4090, 4100).select(F.lit(0).alias("conv"), "id", F.lit("A").alias("who"), F.lit("t").alias("text"))
    assert [r.n_turns for r in D.conversation_blocks(df, "conv", "id", F.col("who"), F.col("text")).collect()] == [10]


def test_pairs(talk):
    rows, df = talk
    want = []
    for conv, turns in by_conv(rows).items():
        want += [(conv, a[1], a[3], b[3]) for a, b in zip(turns, turns[1:]) if a[3] and b[3]]
    assert sorted(map(tuple, D.turn_pairs(df, "conv", "turn", "text").collect())) == sorted(want)
