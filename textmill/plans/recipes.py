"""The source recipes: what each source must hold and how its rows become blocks.

A recipe is data plus column expressions. Source frames carry ``row_id`` (a unique integer in
source order); ``split`` and ``split_ord`` are optional.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmill.functions import render as R
from textmill.functions.text import (
    clean_text, contains_any, first_nonempty, is_empty_list, is_missing, person, required, speaker_of, titled,
)
from textmill.operators import dialogue as D
from textmill.operators.mixture import as_blocks
from textmill.operators.prefix import take_first


class Fields:
    """Columns by name; a column the source lacks reads as null."""

    def __init__(self, df: DataFrame):
        self._schema = df.schema

    def __getattr__(self, name: str) -> Column:
        return F.col(name) if name in self._schema.names else F.lit(None).cast("string")

    def kind(self, name: str) -> type:
        return type(self._schema[name].dataType) if name in self._schema.names else T.NullType

    def integer(self, name: str) -> bool:
        return issubclass(self.kind(name), T.IntegralType)

    def part(self, name: str, field: str, dtype: str = "array<string>") -> Column:
        """A struct's field, null when the column or the field is absent."""
        if self.kind(name) is T.StructType and field in self._schema[name].dataType.names:
            return F.col(name)[field]
        return F.lit(None).cast(dtype)

    def listed(self, name: str) -> Column:
        return F.col(name) if self.kind(name) is T.ArrayType else F.lit(None).cast("array<string>")


@dataclass(frozen=True)
class Recipe:
    key: str
    source: str
    domain: str
    keep: Callable[[Fields], Column]
    question: Callable[[Fields], Column] | None = None
    answer: Callable[[Fields], Column] | None = None
    turns: Callable[[Fields], Column] | None = None
    text: Callable[[Fields], Column] | None = None
    pairs: Callable[[Fields], Column] | None = None
    min_chars: int = 0
    split: str | None = None
    cap: int | None = None
    needed: bool = False
    checked: bool = True


def _answer_key(c: Fields) -> Column:
    return R.key_sentence(c.answerKey)


def _choice_table(c: Fields) -> tuple[Column, Column]:
    return c.part("choices", "label"), c.part("choices", "text")


def _stem_choices(c: Fields) -> Column:
    with_lines = R.choices_labelled(c.question_stem, *_choice_table(c), "\nChoices:\n")
    return F.when(c.choices.isNull(), c.question_stem).otherwise(with_lines)


def _trivia(c: Fields) -> Column:
    return c.part("answer", "value", "string") if c.kind("answer") is T.StructType else c.answer.cast("string")


def _candidate(c: Fields) -> Column:
    return F.try_element_at(c.candidates, F.lit(-1)) if c.kind("candidates") is T.ArrayType else c.candidates


def _joined(c: Fields, name: str, sep: str) -> Column:
    return F.array_join(F.col(name), sep) if c.kind(name) is T.ArrayType else getattr(c, name).cast("string")


def _numbered(value: Column) -> Column:
    """A number is kept when it is not null, 0 included."""
    return value.cast("string")


def _indexed(c: Fields) -> Column:
    return R.joined_parts(R.present(c.lecture), R.indexed_answer(c.answer, c.listed("choices"), c.integer("answer")))


def _rationale(name: str) -> Callable[[Fields], Column]:
    return lambda c: R.joined_parts(
        R.present(getattr(c, name)), R.labelled_part("Correct answer", R.present(c.correct))
    )


def _svamp_question(c: Fields) -> Column:
    return F.concat(F.when(is_missing(c.Body), F.lit("")).otherwise(F.concat(c.Body, F.lit("\n"))), c.Question)


def _svamp_answer(c: Fields) -> Column:
    return R.joined_parts(
        R.labelled_part("Equation", R.present(c.Equation)), R.labelled_part("Answer", _numbered(c.Answer))
    )


def _asdiv_answer(c: Fields) -> Column:
    return R.joined_parts(R.present(c.solution), R.labelled_part("Answer", R.present(c.answer)))


def _medical_answer(c: Fields) -> Column:
    return R.joined_parts(R.present(c.exp), R.labelled_part("Correct option", _numbered(c.cop)))


def _physics(c: Fields) -> tuple[Column, Column]:
    return first_nonempty(c.question, c.instruction, c.prompt), first_nonempty(c.answer, c.response, c.solution)


def _worldtree(c: Fields) -> Column:
    return first_nonempty(c.answer, c.answer_text, c.explanation)


def _article(n: int) -> Callable[[Fields], Column]:
    return lambda c: F.substring(clean_text(c.text), 1, n)


def _long_article(n: int) -> Callable[[Fields], Column]:
    return lambda c: required(c.title, c.text) & (F.length(clean_text(c.text)) >= n)


CONVERSATION = [
    Recipe("C1", "oasst1", "conversation", needed=True,
           keep=lambda c: (c.lang == "en") & ~is_missing(c.text),
           turns=lambda c: F.array(F.struct(speaker_of(c.role, user="prompter").alias("speaker"), c.text.alias("text")),
                                   D.turn_of("Assistant", F.lit(R.UNDERSTOOD)))),
    Recipe("C2", "empathetic_dialogues", "conversation", needed=True, keep=lambda c: ~is_missing(c.utterance)),
    Recipe("C3", "persona_chat", "conversation", keep=lambda c: ~is_empty_list(c.history),
           turns=lambda c: D.with_reply(c.history, _candidate(c))),
    Recipe("C4", "daily_dialog", "conversation", keep=lambda c: ~is_empty_list(c.dialog),
           turns=lambda c: D.alternate(c.dialog)),
    Recipe("C5", "ultrachat", "conversation", split="train_sft", cap=100_000,
           keep=lambda c: ~is_empty_list(c.messages), turns=lambda c: D.messages_to_turns(c.messages)),
    Recipe("C6", "soda", "conversation", split="train", cap=100_000,
           keep=lambda c: ~is_empty_list(c.dialogue), turns=lambda c: D.alternate(c.dialogue)),
    Recipe("C7", "dolly", "conversation", split="train", keep=lambda c: required(c.instruction, c.response),
           turns=lambda c: F.array(D.turn_of("User", R.with_context(c.instruction, c.context)),
                                   D.turn_of("Assistant", c.response))),
    Recipe("C8", "oasst2", "conversation", split="train", cap=100_000,
           keep=lambda c: (c.lang == "en") & ~is_missing(c.text),
           turns=lambda c: F.array(F.struct(speaker_of(c.role, user="prompter").alias("speaker"), c.text.alias("text")))),
]

KNOWLEDGE = [
    Recipe("K1", "dolly", "knowledge", split="train", keep=lambda c: required(c.instruction, c.response),
           question=lambda c: R.with_context(c.instruction, c.context), answer=lambda c: c.response),
    Recipe("K2", "oasst1", "knowledge",
           keep=lambda c: (c.lang == "en") & (c.role == "prompter") & ~is_missing(c.text),
           question=lambda c: c.text, answer=lambda c: F.lit(R.COMPLETE_ANSWER)),
    Recipe("K3", "scienceqa", "knowledge", split="train", keep=lambda c: ~is_missing(c.question),
           question=lambda c: R.choices_inline(c.question, c.listed("choices")),
           answer=lambda c: R.indexed_sentence(c.answer, c.listed("choices"), c.integer("answer"))),
    Recipe("K4", "arc_challenge", "knowledge", split="train",
           keep=lambda c: ~is_missing(c.question) & c.choices.isNotNull(),
           question=lambda c: R.choices_labelled(c.question, *_choice_table(c), "\n"), answer=_answer_key),
    Recipe("K5", "gsm8k", "knowledge", split="train", keep=lambda c: required(c.question, c.answer),
           question=lambda c: c.question, answer=lambda c: c.answer),
    Recipe("K6", "trivia_qa", "knowledge", split="train", cap=100_000,
           keep=lambda c: ~is_missing(c.question) & ~is_missing(_trivia(c)),
           question=lambda c: c.question, answer=_trivia),
    Recipe("K7", "wikipedia", "knowledge", split="train", cap=50_000, keep=_long_article(100),
           question=lambda c: R.title_question("article", c.title), answer=_article(4000)),
    Recipe("K8", "web_questions", "knowledge", split="train",
           keep=lambda c: ~is_missing(c.question) & (
               ~is_empty_list(c.answers) if c.kind("answers") is T.ArrayType else ~is_missing(c.answers)),
           question=lambda c: c.question, answer=lambda c: _joined(c, "answers", ", ")),
]

SCIENCE = [
    Recipe("N1", "scienceqa", "science", keep=lambda c: ~is_missing(c.question) & _indexed(c).isNotNull(),
           question=lambda c: R.choices_lines(c.question, c.listed("choices")), answer=_indexed),
    Recipe("N2", "arc", "science", keep=lambda c: ~is_missing(c.question) & c.choices.isNotNull(),
           question=lambda c: R.choices_labelled(c.question, *_choice_table(c), "\nChoices:\n"), answer=_answer_key),
    Recipe("N3", "openbookqa", "science", keep=lambda c: ~is_missing(c.question_stem),
           question=_stem_choices, answer=_answer_key),
    Recipe("N4", "physics", "science", cap=100_000, keep=lambda c: required(*[F.coalesce(x, F.lit("")) for x in _physics(c)]),
           question=lambda c: R.prompted("physics", _physics(c)[0]), answer=lambda c: _physics(c)[1]),
    Recipe("N5", "medmcqa", "science", cap=100_000,
           keep=lambda c: ~is_missing(c.question) & _medical_answer(c).isNotNull(),
           question=lambda c: R.prompted("medical", c.question), answer=_medical_answer),
    Recipe("N6", "worldtree", "science", cap=100_000,
           keep=lambda c: ~is_missing(c.question) & _worldtree(c).isNotNull(),
           question=lambda c: R.prompted("worldtree", c.question), answer=_worldtree),
    Recipe("N7", "wikipedia", "science", split="train", cap=50_000,
           keep=lambda c: contains_any(c.title, R.SCIENCE_TERMS) & _long_article(200)(c),
           question=lambda c: R.title_question("science", c.title), answer=_article(5000)),
]

MATH = [
    Recipe("H1", "gsm8k", "math", keep=lambda c: required(c.question, c.answer),
           question=lambda c: R.prompted("gsm8k", c.question), answer=lambda c: c.answer),
    Recipe("H2", "math_qa", "math", keep=lambda c: ~is_missing(c.Problem) & _rationale("Rationale")(c).isNotNull(),
           question=lambda c: R.choices_text(c.Problem, c.options), answer=_rationale("Rationale")),
    Recipe("H3", "aqua_rat", "math", keep=lambda c: ~is_missing(c.question) & _rationale("rationale")(c).isNotNull(),
           question=lambda c: R.choices_lines(c.question, c.listed("options")), answer=_rationale("rationale")),
    Recipe("H4", "svamp", "math", keep=lambda c: ~is_missing(c.Question) & _svamp_answer(c).isNotNull(),
           question=_svamp_question, answer=_svamp_answer),
    Recipe("H5", "asdiv", "math", keep=lambda c: ~is_missing(c.body) & _asdiv_answer(c).isNotNull(),
           question=lambda c: R.prompted("asdiv", c.body), answer=_asdiv_answer),
    Recipe("H6", "algebra", "math", cap=200_000, keep=lambda c: required(c.question, c.answer),
           question=lambda c: R.prompted("algebra", c.question), answer=lambda c: c.answer),
]


def _corrections(c: Fields) -> Column:
    question = R.prompted("fluency", c.sentence)
    kept = F.filter(c.corrections, lambda x: x.isNotNull() & (x != ""))
    return F.transform(kept, lambda x: F.struct(question.alias("question"), x.alias("answer")))


LANGUAGE = [
    Recipe("G1", "grammar", "language", keep=lambda c: required(c.input, c.output),
           question=lambda c: R.prompted("grammar", c.input), answer=lambda c: c.output),
    Recipe("G2", "jfleg", "language", keep=lambda c: ~is_missing(c.sentence) & ~is_empty_list(c.corrections),
           pairs=_corrections),
    Recipe("G3", "vocabulary", "language", cap=300_000, keep=lambda c: required(c.word, c.definition),
           question=lambda c: R.title_question("word", c.word), answer=lambda c: c.definition),
    Recipe("G4", "paws", "language", cap=100_000,
           keep=lambda c: required(c.sentence1, c.sentence2) & (c.label == 1),
           question=lambda c: R.prompted("paraphrase", c.sentence1), answer=lambda c: c.sentence2),
    Recipe("G5", "squad", "language", cap=100_000,
           keep=lambda c: required(c.question, c.context) & ~is_missing(F.get(c.part("answers", "text"), F.lit(0))),
           question=lambda c: R.with_context(c.question, c.context),
           answer=lambda c: F.get(c.part("answers", "text"), F.lit(0))),
    Recipe("G6", "blended_skill_talk", "language", keep=lambda c: ~is_empty_list(c.dialog),
           pairs=lambda c: D.adjacent_pairs(c.dialog)),
    Recipe("G7", "daily_dialog", "language", keep=lambda c: ~is_empty_list(c.dialog),
           pairs=lambda c: D.adjacent_pairs(c.dialog)),
]

FACTS = [
    Recipe("F1", "wikipedia", "facts", split="train", min_chars=40, keep=lambda c: ~is_missing(c.text),
           text=lambda c: titled(c.title, c.text)),
    Recipe("F2", "open_web_math", "facts", split="train", min_chars=40, cap=50_000, keep=lambda c: ~is_missing(c.text),
           text=lambda c: c.text),
    Recipe("F3", "scitldr", "facts", split="train", min_chars=40, cap=20_000,
           keep=lambda c: ~is_empty_list(c.source) if c.kind("source") is T.ArrayType else ~is_missing(c.source),
           text=lambda c: _joined(c, "source", " ")),
    Recipe("F4", "openbookqa", "facts", split="train", min_chars=40, cap=10_000, checked=False, keep=lambda c: ~is_missing(c.question),
           text=lambda c: R.fact_qa(c.question, *_choice_table(c), c.answerKey)),
    Recipe("F5", "emotion", "facts", split="train", min_chars=40, cap=20_000, keep=lambda c: ~is_missing(c.text),
           text=lambda c: c.text),
]

WRITING = [
    Recipe("W1", "wikipedia", "writing", split="train", min_chars=30, keep=lambda c: ~is_missing(c.text), text=lambda c: c.text),
    Recipe("W2", "reviews", "writing", split="train", min_chars=30, cap=50_000, keep=lambda c: ~is_missing(c.text),
           text=lambda c: c.text),
    Recipe("W3", "books", "writing", split="train", min_chars=30, cap=3_000, keep=lambda c: ~is_missing(c.text),
           text=lambda c: c.text),
    Recipe("W4", "reports", "writing", split="train", min_chars=30, cap=10_000, keep=lambda c: ~is_missing(c.report),
           text=lambda c: c.report),
]

RECIPES = {r.key: r for r in CONVERSATION + KNOWLEDGE + SCIENCE + MATH + LANGUAGE + FACTS + WRITING}

# The tag of the question-answer blocks.
TAGS = {"knowledge": "KNOWLEDGE", "science": "SCIENCE", "math": "MATH", "language": "LANGUAGE"}


def of_split(recipe: Recipe, df: DataFrame) -> DataFrame:
    """The rows of the split a recipe asks for; a source without splits is taken whole."""
    if recipe.split is not None and "split" in df.columns:
        return df.filter(F.col("split") == recipe.split)
    return df


def split_order(df: DataFrame) -> str | None:
    return "split_ord" if "split_ord" in df.columns else None


def row_key(df: DataFrame) -> Column:
    """Unique in a source: row ids may repeat from split to split."""
    split = F.col("split") if "split" in df.columns else F.lit("train")
    return F.concat_ws(":", split, F.col("row_id").cast("string"))


def chosen_rows(recipe: Recipe, df: DataFrame) -> DataFrame:
    """The rows a recipe counts: its split, its own filter, its cap."""
    c = Fields(df)
    df = of_split(recipe, df).filter(recipe.keep(c))
    if recipe.cap is not None:
        df = take_first(df, recipe.cap, "row_id", major=split_order(df))
    return df


def render(recipe: Recipe, df: DataFrame) -> DataFrame:
    """Block table of one source. Chosen rows that clean to nothing give no block."""
    c = Fields(df)
    rows = chosen_rows(recipe, df)
    key = row_key(df)
    tag = TAGS.get(recipe.domain, "")
    labels = (F.lit(recipe.domain), F.lit(recipe.key + ":" + recipe.source))
    if recipe.pairs is not None:
        long = rows.select(key.alias("_key"), F.posexplode(recipe.pairs(c)).alias("_i", "_p"))
        block = R.qa_block(F.col("_p.question"), F.col("_p.answer"), tag)
        return as_blocks(long, *labels, F.concat_ws(":", "_key", "_i"), block)
    if recipe.turns is not None:
        block = R.conversation_block(recipe.turns(c))
    elif recipe.text is not None:
        block = R.document_block(recipe.text(c), recipe.min_chars)
    elif recipe.question is not None:
        block = R.qa_block(recipe.question(c), recipe.answer(c), tag)
    else:
        return _utterances(rows, labels)
    return as_blocks(rows, *labels, key, block)


def _utterances(rows: DataFrame, labels: tuple[Column, Column]) -> DataFrame:
    """Utterance rows, grouped per split and conversation in the order of ``turn``, or of ``row_id``."""
    split = F.col("split") if "split" in rows.columns else F.lit("train")
    conv = F.concat_ws(":", split, F.col("conv_id").cast("string"))
    order = "turn" if "turn" in rows.columns else "row_id"
    blocks = D.conversation_blocks(
        rows.withColumn("_conv", conv), "_conv", order, person(F.col("speaker_idx")), F.col("utterance")
    )
    return blocks.select(
        labels[0].alias("domain"), labels[1].alias("source"), F.col("_conv").alias("row_key"), "weight", "block"
    )
