"""All source recipes on small frames of their schema."""

import pytest
from pyspark.sql import functions as F

from textmill.plans import recipes as P
from textmill.plans.builders import CORPORA, build_corpus, source_report

LONG = "word " * 60
CHOICE = "struct<label:array<string>,text:array<string>>"
MC = "question string, choices array<string>, answer int, lecture string"
KEYED = f"question string, choices {CHOICE}, answerKey string"
SKILL = "dialog array<string>"


def qa(tag, q, a):
    return f"[{tag}]\nUser: {q}\nAssistant: {a}\n\n"


def talk(*lines):
    return "[CONVERSATION]\n" + "\n".join(lines) + "\n\n"


L2 = (["A", "B"], ["x", "y"])
SQUAD = "question string, context string, answers struct<text:array<string>>"
# key -> (schema, rows, expected blocks)
CASES = {
    "C1": ("lang string, role string, text string",
           [("en", "prompter", "hi"), ("en", None, "yo"), ("de", "prompter", "no"), ("en", "prompter", "")],
           [talk("User: hi", "Assistant: Understood."), talk("Assistant: yo", "Assistant: Understood.")]),
    "C2": ("conv_id string, speaker_idx int, utterance string",
           [("a", 1, "x"), ("b", 3, "solo"), ("a", 2, "y"), ("a", 1, "")], [talk("Person1: x", "Person2: y")]),
    "C3": ("history array<string>, candidates array<string>",
           [(["a", "b"], ["no", "yes"]), ([], ["z"]), (["a"], [])], [talk("User: a", "Assistant: b", "Assistant: yes")]),
    "C4": (SKILL, [(["a", "b", "c"],), (["a"],), (None,)], [talk("User: a", "Assistant: b", "User: c")]),
    "C5": ("messages array<struct<role:string,content:string>>",
           [([("system", "s"), ("user", "u"), ("assistant", "a")],), ([],)], [talk("User: u", "Assistant: a")]),
    "C6": ("dialogue array<string>", [(["a", "b"],)], [talk("User: a", "Assistant: b")]),
    "C7": ("instruction string, context string, response string", [("i", "c", "r"), ("i", "", "r"), ("i", "c", None)],
           [talk("User: i", "Context:", "c", "Assistant: r"), talk("User: i", "Assistant: r")]),
    "C8": ("lang string, role string, text string", [("en", "prompter", "hi")], []),
    "K1": ("instruction string, context string, response string", [("i", "c", "r")], [qa("KNOWLEDGE", "i\nContext:\nc", "r")]),
    "K2": ("lang string, role string, text string", [("en", "prompter", "t"), ("en", "assistant", "t")],
           [qa("KNOWLEDGE", "t", "Please provide a complete and accurate answer.")]),
    "K3": (MC, [("q", ["x", "y"], 1, None), ("q", None, None, None), ("q", ["x"], 5, None)],
           [qa("KNOWLEDGE", "q\nChoices: x, y", "The correct answer is y."), qa("KNOWLEDGE", "q", "None"),
            qa("KNOWLEDGE", "q\nChoices: x", "5")]),
    "K4": (KEYED, [("q", L2, "B"), ("q", None, "B")], [qa("KNOWLEDGE", "q\nA: x\nB: y", "The correct answer is B.")]),
    "K5": ("question string, answer string", [("q", "a"), ("q", "")], [qa("KNOWLEDGE", "q", "a")]),
    "K6": ("question string, answer struct<value:string>", [("q", ("v",)), ("q", (None,)), ("q", None)], [qa("KNOWLEDGE", "q", "v")]),
    "K7": ("title string, text string", [("T", LONG), ("T", "short"), ("", LONG)],
           [qa("KNOWLEDGE", "Explain what T is and provide useful factual information about it.", LONG.strip())]),
    "K8": ("question string, answers array<string>", [("q", ["a", "b"]), ("q", [])], [qa("KNOWLEDGE", "q", "a, b")]),
    "N1": (MC, [("q", ["x", "y"], 0, "lec"), ("q", ["x"], 9, None), ("q", [], 4, "")],
           [qa("SCIENCE", "q\nChoices:\nx\ny", "lec\nAnswer: x"), qa("SCIENCE", "q", "Answer: 4")]),
    "N2": (KEYED, [("q", L2, None)], [qa("SCIENCE", "q\nChoices:\nA: x\nB: y", "The correct answer is None.")]),
    "N3": (f"question_stem string, choices {CHOICE}, answerKey string", [("q", L2, "A"), ("q", None, "A")],
           [qa("SCIENCE", "q\nChoices:\nA: x\nB: y", "The correct answer is A."), qa("SCIENCE", "q", "The correct answer is A.")]),
    "N4": ("question string, instruction string, answer string, solution string",
           [("", "i", None, "s"), (None, None, "a", "s"), ("q", None, "", "")],
           [qa("SCIENCE", "Explain and solve this physics question:\ni", "s")]),
    "N5": ("question string, cop int, exp string", [("q", 0, "e"), ("q", None, None)],
           [qa("SCIENCE", "Answer this biology or medical science question:\nq", "e\nCorrect option: 0")]),
    "N6": ("question string, answer string, explanation string", [("q", "", "e"), ("q", None, "")],
           [qa("SCIENCE", "Explain the scientific reasoning behind this question:\nq", "e")]),
    "N7": ("title string, text string", [("Unicellular", LONG), ("History", LONG), ("Atom", "x" * 199)],
           [qa("SCIENCE", "Explain the scientific topic of Unicellular in a clear and useful way.", LONG.strip())]),
    "H1": ("question string, answer string", [("q", "a")], [qa("MATH", "Solve this math problem step by step:\nq", "a")]),
    "H2": ("Problem string, options string, correct string, Rationale string",
           [("p", "a ) 1", "a", "r"), ("p", None, None, ""), ("p", "", "b", None)],
           [qa("MATH", "p\nChoices:\na ) 1", "r\nCorrect answer: a"), qa("MATH", "p", "Correct answer: b")]),
    "H3": ("question string, options array<string>, rationale string, correct string", [("q", ["A)1", "B)2"], "r", "B")],
           [qa("MATH", "q\nChoices:\nA)1\nB)2", "r\nCorrect answer: B")]),
    "H4": ("Body string, Question string, Equation string, Answer double", [("b", "q", "1-1", 0.0), ("", "q", None, None)],
           [qa("MATH", "b\nq", "Equation: 1-1\nAnswer: 0.0")]),
    "H5": ("body string, solution string, answer string", [("b", "s", "1"), ("b", None, "")],
           [qa("MATH", "Solve this problem and explain the reasoning:\nb", "s\nAnswer: 1")]),
    "H6": ("question string, answer string", [("q", "a")], [qa("MATH", "Solve this algebra problem:\nq", "a")]),
    "G1": ("input string, output string", [("bad", "good"), ("bad", None)],
           [qa("LANGUAGE", "Correct the grammar in this sentence:\nbad", "good")]),
    "G2": ("sentence string, corrections array<string>", [("s", ["a", "", "b"]), ("s", []), ("s", None)],
           [qa("LANGUAGE", "Improve the grammar and fluency of this sentence:\ns", x) for x in "ab"]),
    "G3": ("word string, definition string", [("w", "d")], [qa("LANGUAGE", "What does the word w mean?", "d")]),
    "G4": ("sentence1 string, sentence2 string, label int", [("a", "b", 1), ("a", "b", 0), ("a", "b", None)],
           [qa("LANGUAGE", "Rewrite this sentence using different wording while keeping the same meaning:\na", "b")]),
    "G5": (SQUAD, [("q", "c", (["a", "b"],)), ("q", "c", ([],)), ("q", "", (["a"],)), ("q", "c", None)],
           [qa("LANGUAGE", "q\nContext:\nc", "a")]),
    "G6": (SKILL, [(["a", "b", "", "c", "d"],), (["a"],)], [qa("LANGUAGE", "a", "b"), qa("LANGUAGE", "c", "d")]),
    "G7": (SKILL, [(["a", "b", "c"],)], [qa("LANGUAGE", "a", "b"), qa("LANGUAGE", "b", "c")]),
    "F1": ("title string, text string", [("T", LONG), ("", LONG), ("T", "")], ["T\n" + LONG.strip() + "\n\n", LONG.strip() + "\n\n"]),
    "F2": ("text string", [(LONG,), ("short",)], [LONG.strip() + "\n\n"]),
    "F3": ("source array<string>", [(["a" * 30, "b" * 30],)], ["a" * 30 + " " + "b" * 30 + "\n\n"]),
    "F4": (f"question string, choices {CHOICE}, answerKey string", [("q" * 40, L2, "A")], ["Question: " + "q" * 40 + "\nA: x\nB: y\nAnswer: A\n\n"]),
    "F5": ("text string", [(LONG,)], [LONG.strip() + "\n\n"]),
    "W1": ("text string", [("x" * 30,), ("x" * 29,)], ["x" * 30 + "\n\n"]),
    "W2": ("text string", [("x" * 30,)], ["x" * 30 + "\n\n"]),
    "W3": ("text string", [("x" * 30,)], ["x" * 30 + "\n\n"]),
    "W4": ("report string", [("x" * 30,), (None,)], ["x" * 30 + "\n\n"]),
}


def frame(spark, key, rows=None):
    schema, data, _ = CASES[key]
    data = rows or data
    return spark.createDataFrame([(i, *r) for i, r in enumerate(data)], f"row_id long, {schema}")


def test_every_recipe_has_a_case():
    assert set(CASES) == set(P.RECIPES)
    assert len(P.RECIPES) == 45


@pytest.mark.parametrize("key", list(CASES))
def test_recipe(spark, key):
    got = P.render(P.RECIPES[key], frame(spark, key)).collect()
    assert sorted(r.block for r in got) == sorted(CASES[key][2])
    assert all(r.weight == len(r.block) for r in got)
    assert len({r.row_key for r in got}) == len(got)


def test_scalar_forms_of_nested_fields(spark):
    df = spark.createDataFrame([(0, "q", "v")], "row_id long, question string, answer string")
    assert P.render(P.RECIPES["K6"], df).first().block == qa("KNOWLEDGE", "q", "v")
    df = spark.createDataFrame([(0, "s" * 50)], "row_id long, source string")
    assert P.render(P.RECIPES["F3"], df).first().block == "s" * 50 + "\n\n"
    df = spark.createDataFrame([(0, ["a"], "r")], "row_id long, history array<string>, candidates string")
    assert P.render(P.RECIPES["C3"], df).first().block == talk("User: a", "Assistant: r")


def test_splits_and_caps(spark):
    from dataclasses import replace

    rows = [(i, s, o, f"q{i}", "" if i == 1 else "\n" if i == 2 else "a") for o, s in enumerate(("test", "train")) for i in range(5)]
    df = spark.createDataFrame(rows, "row_id long, split string, split_ord int, question string, answer string")
    # Row 1 is filtered before the cap counts; row 2 is counted and then cleans to nothing.
    got = P.render(replace(P.RECIPES["H6"], cap=6), df).collect()
    assert sorted(r.row_key for r in got) == ["test:0", "test:3", "test:4", "train:0"]
    got = P.render(replace(P.RECIPES["H6"], split="train", cap=2), df).collect()
    assert sorted(r.row_key for r in got) == ["train:0"]


def test_corpora_skip_what_is_missing_and_report(spark):
    frames = {"H1": frame(spark, "H1"), "H2": None, "H5": frame(spark, "H5")}
    got = build_corpus("math", frames).collect()
    assert sorted(r.source for r in got) == ["H1:gsm8k", "H5:asdiv"]
    rep = {r.source: (r.attempted, r.kept) for r in source_report("math", frames).collect()}
    assert rep == {"H1:gsm8k": (1, 1), "H5:asdiv": (1, 1)}
    with pytest.raises(ValueError, match="oasst1"):
        build_corpus("conversation", {"C4": frame(spark, "C4")})
    with pytest.raises(ValueError, match="no source"):
        build_corpus("math", {})
    assert sum(len(c.recipes) for c in CORPORA.values()) == 45


def test_single_messages_are_counted_but_give_nothing(spark):
    frames = {k: frame(spark, k) for k in ("C1", "C2", "C8")}
    rep = {r.source: (r.attempted, r.kept) for r in source_report("conversation", frames).collect()}
    assert rep["C8:oasst2"] == (1, 0)


def test_document_corpora_saturate_source_by_source(spark):
    text = "x" * 48
    frames = {
        "F1": frame(spark, "F1", [("", text), ("", "short"), ("", text), ("", text)]),
        "F2": frame(spark, "F2", [(text,), (text,)]),
        "F4": frame(spark, "F4", [("q" * 60, None, None), ("q" * 60, None, None)]),
        "F5": frame(spark, "F5", [("",), (text,)]),
    }
    from textmill.plans.builders import read_until_full

    used = [(P.RECIPES[k], df) for k, df in frames.items()]
    # 50 + 50 characters fill the budget in F1; F2 gives its first row, F4 all, F5 an empty first row.
    got = {(r.source, r.row_key.removeprefix("train:")) for r in read_until_full(used, 100)[1].collect()}
    assert got == {("F1:wikipedia", "0"), ("F1:wikipedia", "2"), ("F2:open_web_math", "0"), ("F4:openbookqa", "0"), ("F4:openbookqa", "1")}
    total = build_corpus("facts", frames, budget=100).agg(F.sum("weight")).first()[0]
    assert total <= 100


def test_document_sources_read_the_train_split(spark):
    rows = [(0, "train", "x" * 48), (0, "test", "y" * 48), (1, "validation", "z" * 48)]
    df = spark.createDataFrame([(i, s, "", t) for i, s, t in rows], "row_id long, split string, title string, text string")
    for name, key in (("facts", "F1"), ("writing", "W1"), ("writing", "W2")):
        got = build_corpus(name, {key: df}).collect()
        assert [(r.row_key, r.block) for r in got] == [("train:0", "x" * 48 + "\n\n")]


def test_answers_of_any_type(spark):
    df = spark.createDataFrame([(0, "q", ["a", "b"], "1", "")], "row_id long, question string, choices array<string>, answer string, lecture string")
    assert "Answer: 1\n" in P.render(P.RECIPES["N1"], df).first().block
    assert "Assistant: 1\n" in P.render(P.RECIPES["K3"], df).first().block
    df = df.withColumn("answer", F.lit(1.5))
    assert "Answer: 1.5\n" in P.render(P.RECIPES["N1"], df).first().block
    df = df.withColumn("answer", F.lit(1))
    assert "Answer: b\n" in P.render(P.RECIPES["N1"], df).first().block
    numbers = spark.createDataFrame([(0, "p", "r", 7)], "row_id long, Problem string, Rationale string, correct int")
    assert "Correct answer: 7\n" in P.render(P.RECIPES["H2"], numbers).first().block
