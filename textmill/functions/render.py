"""Text block templates as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from textmill.functions.text import clean_text, is_empty_list, is_missing, let

# The wording of the instruction prompts and constant replies.
PROMPTS = {
    "gsm8k": "Solve this math problem step by step:\n",
    "asdiv": "Solve this problem and explain the reasoning:\n",
    "algebra": "Solve this algebra problem:\n",
    "physics": "Explain and solve this physics question:\n",
    "medical": "Answer this biology or medical science question:\n",
    "worldtree": "Explain the scientific reasoning behind this question:\n",
    "grammar": "Correct the grammar in this sentence:\n",
    "fluency": "Improve the grammar and fluency of this sentence:\n",
    "paraphrase": "Rewrite this sentence using different wording while keeping the same meaning:\n",
}
TITLE_PROMPTS = {
    "article": ("Explain what ", " is and provide useful factual information about it."),
    "science": ("Explain the scientific topic of ", " in a clear and useful way."),
    "word": ("What does the word ", " mean?"),
}
UNDERSTOOD = "Understood."
COMPLETE_ANSWER = "Please provide a complete and accurate answer."
SCIENCE_TERMS = [
    "physics", "chemistry", "biology", "astronomy", "geology", "mathematics", "ecology",
    "genetics", "cell", "planet", "atom", "molecule", "evolution", "gravity", "energy",
    "electricity", "magnetism", "thermodynamics", "quantum", "scientific",
]


def qa_block(question: Column, answer: Column, tag: str) -> Column:
    """Tagged question and answer block, null when either side is empty after cleaning."""

    def block(s: Column) -> Column:
        whole = F.concat(F.lit(f"[{tag}]\nUser: "), s["q"], F.lit("\nAssistant: "), s["a"], F.lit("\n\n"))
        return F.when((s["q"] != "") & (s["a"] != ""), whole)

    return let(F.struct(clean_text(question).alias("q"), clean_text(answer).alias("a")), block)


def document_block(text: Column, min_chars: int) -> Column:
    """Cleaned text and a blank line, null below ``min_chars`` characters."""
    return let(clean_text(text), lambda t: F.when(F.length(t) >= min_chars, F.concat(t, F.lit("\n\n"))))


def turn_line(speaker: Column, text: Column) -> Column:
    """One line of a conversation, null when the text is empty after cleaning."""
    return let(clean_text(text), lambda t: F.when(t != "", F.concat(speaker, F.lit(": "), t)))


def conversation_block(turns: Column) -> Column:
    """Block of an ``array<struct<speaker, text>>``; null with fewer than two non-empty turns."""
    lines = F.array_compact(F.transform(turns, lambda t: turn_line(t["speaker"], t["text"])))
    return let(lines, lambda x: F.when(F.size(x) >= 2, conversation_text(x)))


CONVERSATION_HEAD = "[CONVERSATION]\n"


def conversation_text(lines: Column) -> Column:
    return F.concat(F.lit(CONVERSATION_HEAD), F.array_join(lines, "\n"), F.lit("\n\n"))


def prompted(name: str, text: Column) -> Column:
    return F.concat(F.lit(PROMPTS[name]), text)


def title_question(name: str, title: Column) -> Column:
    before, after = TITLE_PROMPTS[name]
    return F.concat(F.lit(before), title, F.lit(after))


def with_context(question: Column, context: Column) -> Column:
    """Question followed by its context, when there is one."""
    suffix = F.concat(F.lit("\n\nContext:\n"), context)
    return F.concat(question, F.when(is_missing(context), F.lit("")).otherwise(suffix))


def choices_lines(question: Column, choices: Column) -> Column:
    suffix = F.concat(F.lit("\nChoices:\n"), F.array_join(choices, "\n"))
    return F.concat(question, F.when(is_empty_list(choices), F.lit("")).otherwise(suffix))


def choices_text(question: Column, options: Column) -> Column:
    """Options that come as one string are appended as they are."""
    suffix = F.concat(F.lit("\nChoices:\n"), options)
    return F.concat(question, F.when(is_missing(options), F.lit("")).otherwise(suffix))


def choices_inline(question: Column, choices: Column) -> Column:
    suffix = F.concat(F.lit("\nChoices: "), F.array_join(choices, ", "))
    return F.concat(question, F.when(is_empty_list(choices), F.lit("")).otherwise(suffix))


def _shown(c: Column) -> Column:
    """A missing value is printed as None."""
    return F.coalesce(c.cast("string"), F.lit("None"))


def labelled_lines(labels: Column, texts: Column) -> Column:
    """``label: text`` lines; stops at the shorter list. A missing list counts as empty."""
    n = F.least(F.coalesce(F.size(labels), F.lit(0)), F.coalesce(F.size(texts), F.lit(0)))
    none = F.array().cast("array<string>")
    both = F.zip_with(
        F.slice(F.coalesce(labels.cast("array<string>"), none), F.lit(1), n),
        F.slice(F.coalesce(texts.cast("array<string>"), none), F.lit(1), n),
        lambda a, b: F.concat(_shown(a), F.lit(": "), _shown(b)),
    )
    return F.array_join(both, "\n")


def choices_labelled(question: Column, labels: Column, texts: Column, header: str) -> Column:
    return F.concat(question, F.lit(header), labelled_lines(labels, texts))


def indexed_answer(answer: Column, choices: Column, integer: bool = True) -> Column:
    """``Answer: …`` by index. Out of range: null; without choices: the number itself; null: null.

    An answer that is no integer is printed as it is.
    """
    if not integer:
        return F.concat(F.lit("Answer: "), answer.cast("string"))
    by_index = F.when(
        (answer >= 0) & (answer < F.size(choices)), F.concat(F.lit("Answer: "), F.get(choices, answer))
    )
    plain = F.concat(F.lit("Answer: "), answer.cast("string"))
    return F.when(answer.isNull(), None).when(is_empty_list(choices), plain).otherwise(by_index)


def indexed_sentence(answer: Column, choices: Column, integer: bool = True) -> Column:
    """``The correct answer is ….`` by index, else the bare value (None when null)."""
    if not integer:
        return _shown(answer)
    hit = ~is_empty_list(choices) & (answer >= 0) & (answer < F.size(choices))
    sentence = F.concat(F.lit("The correct answer is "), F.get(choices, answer), F.lit("."))
    return F.when(hit, sentence).otherwise(_shown(answer))


def key_sentence(key: Column) -> Column:
    return F.concat(F.lit("The correct answer is "), _shown(key), F.lit("."))


def labelled_part(label: str, value: Column) -> Column:
    """``label value``; null when the value is null."""
    return F.concat(F.lit(label + ": "), value.cast("string"))


def present(value: Column) -> Column:
    """Text of the value; null instead of the empty string."""
    return F.nullif(value.cast("string"), F.lit(""))


def joined_parts(*parts: Column) -> Column:
    """Non-null parts on lines of their own; null when there is none."""
    return let(F.array_compact(F.array(*parts)), lambda x: F.when(F.size(x) > 0, F.array_join(x, "\n")))


def fact_qa(question: Column, labels: Column, texts: Column, key: Column) -> Column:
    lines = labelled_lines(labels, texts)
    return F.concat(
        F.lit("Question: "), question,
        F.when(lines == "", F.lit("")).otherwise(F.concat(F.lit("\n"), lines)),
        F.when(is_missing(key), F.lit("")).otherwise(F.concat(F.lit("\nAnswer: "), key)),
    )
