import random

from pyspark.sql import functions as F

from textmill.functions import text as X

DIRTY = ["a", "b", "é", "😀", "\n", "\n", " ", " ", "\t", "\r", "\x00", "\xa0", " ", "\x1c", "\x1f", "\x85", "​", "　", "\x0b", "﻿"]


def plain_clean(t):
    t = (t or "").replace("\r", "").replace("\x00", "")
    return "\n".join(x for x in (line.strip() for line in t.split("\n")) if x)


def test_clean_equals_the_rule_on_dirty_strings(spark):
    rnd = random.Random(5)
    texts = ["".join(rnd.choice(DIRTY) for _ in range(rnd.randrange(16))) for _ in range(3000)] + [None, "", "  ", "a\r\nb", "a\x00b"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", X.clean_text(F.col("t")).alias("c")).collect()
    assert [r.c for r in rows] == [plain_clean(r.t) for r in rows]


def test_strip_removes_exactly_the_python_blanks(spark):
    codes = [c for c in range(1, 0x3100) if c not in (10, 13)]
    rows = spark.createDataFrame([(c, f"x{chr(c)}") for c in codes], "c int, t string")
    got = {r.c: r.t for r in rows.select("c", X.clean_text(F.col("t")).alias("t")).collect()}
    assert got == {c: f"x{chr(c)}".strip() for c in codes}


def test_lengths_count_code_points_and_cuts_are_cleaned(spark):
    rows = [("é" * 39,), ("😀" * 40,), ("a" * 3999 + "\n" + "b" * 9,)]
    df = spark.createDataFrame(rows, "t string")
    got = df.select(X.min_length(F.col("t"), 40).alias("k"), X.truncate_clean(F.col("t"), 4000).alias("c")).collect()
    assert [r.k for r in got] == [False, True, True]
    assert got[2].c == "a" * 3999


def test_missing_and_fallbacks(spark):
    df = spark.createDataFrame([(None, "", "z"), ("", None, None), (" ", "x", "y")], "a string, b string, c string")
    got = df.select(
        X.first_nonempty(F.col("a"), F.col("b"), F.col("c")).alias("f"), X.required(F.col("a")).alias("r"),
        X.titled(F.col("a"), F.lit("T")).alias("t"),
    ).collect()
    assert [r.f for r in got] == ["z", None, " "]
    assert [r.r for r in got] == [False, False, True]
    assert [r.t for r in got] == ["T", "T", " \nT"]


def test_speakers(spark):
    df = spark.createDataFrame([("user",), ("assistant",), ("system",), (None,)], "r string")
    got = df.select(
        X.speaker_of(F.col("r"), user="user").alias("a"), X.speaker_of(F.col("r"), user="user", other="assistant").alias("b")
    ).collect()
    assert [r.a for r in got] == ["User", "Assistant", "Assistant", "Assistant"]
    assert [r.b for r in got] == ["User", "Assistant", None, None]
    assert df.select(X.person(F.lit(None)).alias("p")).first().p == "PersonNone"
