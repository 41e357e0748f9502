from pyspark.sql import functions as F

from textmill.functions import render as R
from textmill.operators import dialogue as D


def one(spark, row, schema, **cols):
    return spark.createDataFrame([row], schema).select(*[v.alias(k) for k, v in cols.items()]).first()


def test_qa_block_needs_both_sides(spark):
    df = spark.createDataFrame([(" q \n\n r", "a"), ("\n", "a"), ("q", None)], "q string, a string")
    got = [r.b for r in df.select(R.qa_block(F.col("q"), F.col("a"), "MATH").alias("b")).collect()]
    assert got == ["[MATH]\nUser: q\nr\nAssistant: a\n\n", None, None]


def test_document_block_threshold(spark):
    df = spark.createDataFrame([("x" * 39,), ("x" * 40,), (" " + "é" * 40 + "\n",)], "t string")
    got = [r.b for r in df.select(R.document_block(F.col("t"), 40).alias("b")).collect()]
    assert got == [None, "x" * 40 + "\n\n", "é" * 40 + "\n\n"]


def test_conversation_block_drops_short_ones(spark):
    turns = "array<struct<speaker:string,text:string>>"
    df = spark.createDataFrame(
        [([],), ([("User", "a")],), ([("User", "a"), ("Assistant", " "), ("User", "b\n")],), ([("User", "a"), ("User", None)],)],
        f"t {turns}",
    )
    got = [r.b for r in df.select(R.conversation_block(F.col("t")).alias("b")).collect()]
    assert got == [None, None, "[CONVERSATION]\nUser: a\nUser: b\n\n", None]


def test_labelled_choices_stop_at_the_shorter_list(spark):
    df = spark.createDataFrame(
        [(["A", "B"], ["x"]), (["A"], ["x", "y"]), ([], []), (None, ["x"]), (["A"], [None])], "l array<string>, t array<string>"
    )
    got = [r.b for r in df.select(R.labelled_lines(F.col("l"), F.col("t")).alias("b")).collect()]
    assert got == ["A: x", "A: x", "", "", "A: None"]


def test_answer_by_index_never_wraps(spark):
    rows = [(i, ["x", "y"]) for i in (-1, 0, 1, 2, None)] + [(7, []), (7, None), (None, None)]
    df = spark.createDataFrame(rows, "i int, c array<string>")
    got = df.select(
        R.indexed_answer(F.col("i"), F.col("c")).alias("a"), R.indexed_sentence(F.col("i"), F.col("c")).alias("s")
    ).collect()
    assert [r.a for r in got] == [None, "Answer: x", "Answer: y", None, None, "Answer: 7", "Answer: 7", None]
    assert [r.s for r in got] == [
        "-1", "The correct answer is x.", "The correct answer is y.", "2", "None", "7", "7", "None",
    ]


def test_missing_key_is_printed(spark):
    got = one(spark, (None,), "k string", s=R.key_sentence(F.col("k")))
    assert got.s == "The correct answer is None."


def test_parts_and_facts(spark):
    df = spark.createDataFrame([("a", "", ["A"], ["x"]), (None, None, None, None)], "p string, k string, l array<string>, t array<string>")
    got = df.select(
        R.joined_parts(R.present(F.col("p")), R.labelled_part("Answer", R.present(F.col("k")))).alias("j"),
        R.fact_qa(F.lit("q"), F.col("l"), F.col("t"), F.col("k")).alias("f"),
    ).collect()
    assert [r.j for r in got] == ["a", None]
    assert [r.f for r in got] == ["Question: q\nA: x", "Question: q"]


def test_context_and_choices(spark):
    df = spark.createDataFrame([("c", ["x", "y"], "o"), ("", [], ""), (None, None, None)], "c string, l array<string>, o string")
    q = F.lit("q")
    got = df.select(
        R.with_context(q, F.col("c")).alias("w"), R.choices_lines(q, F.col("l")).alias("l"),
        R.choices_inline(q, F.col("l")).alias("i"), R.choices_text(q, F.col("o")).alias("o"),
    ).collect()
    assert tuple(got[0]) == ("q\n\nContext:\nc", "q\nChoices:\nx\ny", "q\nChoices: x, y", "q\nChoices:\no")
    assert tuple(got[1]) == tuple(got[2]) == ("q", "q", "q", "q")


def test_array_dialogues(spark):
    df = spark.createDataFrame([(["a", "b", "", "d"], "r"), (["a"], ""), (["a"], None)], "h array<string>, r string")
    got = df.select(
        D.with_reply(F.col("h"), F.col("r")).alias("t"), D.adjacent_pairs(F.col("h")).alias("p")
    ).collect()
    assert [tuple(t) for t in got[0].t] == [("User", "a"), ("Assistant", "b"), ("User", ""), ("Assistant", "d"), ("Assistant", "r")]
    assert [len(r.t) for r in got] == [5, 1, 1]
    assert [[tuple(p) for p in r.p] for r in got] == [[("a", "b")], [], []]


def test_messages(spark):
    df = spark.createDataFrame(
        [([("system", "s"), ("user", "u"), ("assistant", ""), ("assistant", "a"), (None, "n"), ("user", None)],)],
        "m array<struct<role:string,content:string>>",
    )
    got = df.select(D.messages_to_turns(F.col("m")).alias("t")).first().t
    assert [tuple(t) for t in got] == [("User", "u"), ("Assistant", "a")]
