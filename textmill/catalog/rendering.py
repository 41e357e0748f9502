"""Templates over questions, choices, dialogues and documents derived from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from textmill.catalog.base import NL, query, sql_clean, sql_qa, sql_qa_query, table
from textmill.catalog.cleaning import SQL_TITLE, titled_documents
from textmill.functions import render as R
from textmill.functions.text import clean_text, let, non_null
from textmill.operators import dialogue as D
from textmill.plans.recipes import RECIPES, render

# Multiple-choice rows made of parts: lists of unequal length, answers null, -1, in and out of range.
SQL_MC = """(SELECT p_partkey AS row_id, 'Which one fits ' || p_name || '?' AS question,
 list_slice([p_brand, p_type, p_name], 1, p_size % 4) AS choices, list_slice(['A', 'B', 'C', 'D'], 1, p_partkey % 5) AS labels,
 CASE WHEN p_partkey % 7 < 6 THEN (p_partkey % 7 - 1)::INT END AS answer,
 CASE WHEN p_size % 3 > 0 THEN chr((65 + p_size % 4)::INT) END AS answer_key,
 CASE WHEN p_partkey % 4 = 1 THEN '' WHEN p_partkey % 4 > 1 THEN p_type END AS lecture,
 p_retailprice AS price FROM part)"""


def multiple_choice(spark, sf):
    p = table(spark, sf, "part")
    key, size = F.col("p_partkey"), F.col("p_size")
    return p.select(
        key.alias("row_id"), F.concat(F.lit("Which one fits "), "p_name", F.lit("?")).alias("question"),
        F.slice(F.array("p_brand", "p_type", "p_name"), F.lit(1), size % 4).alias("choices"),
        F.slice(F.array(*[F.lit(x) for x in "ABCD"]), F.lit(1), (key % 5).cast("int")).alias("labels"),
        F.when(key % 7 < 6, key % 7 - 1).cast("int").alias("answer"),
        F.when(size % 3 > 0, F.get(F.array(*[F.lit(x) for x in "ABCD"]), size % 4)).alias("answer_key"),
        F.when(key % 4 == 1, "").when(key % 4 > 1, F.col("p_type")).alias("lecture"), F.col("p_retailprice").alias("price"),
    )


def c(name):
    return F.col(name)


# Questions and answers: adjacent turns.
SQL_PAIRS = (
    "(SELECT * FROM (SELECT conv_id, turn, text AS question, lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS answer "
    "FROM conversations) WHERE question <> '' AND answer <> '')"
)


def pairs(spark, sf):
    return D.turn_pairs(table(spark, sf, "conversations"), "conv_id", "turn", "text")


@query("turn_pairs", f"SELECT conv_id, turn, question, answer FROM {SQL_PAIRS}")
def turn_pairs(spark, sf):
    return pairs(spark, sf)


def blocks_of(df, key, question, answer, tag):
    return non_null(df, *key, block=R.qa_block(question, answer, tag))


@query("qa_block", sql_qa_query("conv_id, turn", "question", "answer", "LANGUAGE", SQL_PAIRS))
def qa_block(spark, sf):
    return blocks_of(pairs(spark, sf), ["conv_id", "turn"], c("question"), c("answer"), "LANGUAGE")


@query(
    "conversation_block",
    f"""SELECT conv_id, count(*) AS n_turns,
 '[CONVERSATION]' || {NL} || string_agg(speaker || ': ' || t, {NL} ORDER BY turn) || {NL} || {NL} AS block
 FROM (SELECT conv_id, turn, CASE role WHEN 'user' THEN 'User' ELSE 'Assistant' END AS speaker, {sql_clean("text")} AS t
 FROM conversations) WHERE t <> '' GROUP BY conv_id HAVING count(*) >= 2""",
)
def conversation_block(spark, sf):
    speaker = F.when(c("role") == "user", "User").otherwise(F.lit("Assistant"))
    blocks = D.conversation_blocks(table(spark, sf, "conversations"), "conv_id", "turn", speaker, c("text"))
    return blocks.select("conv_id", "n_turns", "block")


@query("document_block", f"SELECT doc_id, t || {NL} || {NL} AS block FROM (SELECT doc_id, {sql_clean('text')} AS t FROM documents) WHERE length(t) >= 40")
def document_block(spark, sf):
    return non_null(table(spark, sf, "documents"), "doc_id", block=R.document_block(c("text"), 40))


@query(
    "prompt_prefix",
    sql_qa_query("conv_id, turn", "'Solve this math problem step by step:' || chr(10) || question", "answer", "MATH", SQL_PAIRS),
)
def prompt_prefix(spark, sf):
    return blocks_of(pairs(spark, sf), ["conv_id", "turn"], R.prompted("gsm8k", c("question")), c("answer"), "MATH")


@query(
    "wiki_example",
    sql_qa_query(
        "doc_id", "'Explain what ' || title || ' is and provide useful factual information about it.'", "substr(t, 1, 4000)",
        "KNOWLEDGE",
        f"(SELECT * FROM (SELECT doc_id, text, {SQL_TITLE} AS title, {sql_clean('text')} AS t FROM documents) "
        "WHERE title <> '' AND text <> '' AND length(t) >= 100)",
    ),
)
def wiki_example(spark, sf):
    docs = titled_documents(spark, sf).filter((c("title") != "") & (c("text") != ""))
    long = let(clean_text(c("text")), lambda t: F.when(F.length(t) >= 100, t))
    kept = non_null(docs, "doc_id", "title", t=long)
    return blocks_of(kept, ["doc_id"], R.title_question("article", c("title")), F.substring("t", 1, 4000), "KNOWLEDGE")


SQL_TURNED = "(SELECT conv_id, turn, question, answer, CASE WHEN turn % 3 = 0 THEN NULL WHEN turn % 3 = 1 THEN '' ELSE question END AS context FROM " + SQL_PAIRS + ")"


@query(
    "with_context",
    f"SELECT conv_id, turn, question || CASE WHEN context IS NULL OR context = '' THEN '' ELSE {NL} || {NL} || 'Context:' || {NL} || context END AS q FROM {SQL_TURNED}",
)
def with_context(spark, sf):
    context = F.when(c("turn") % 3 == 1, "").when(c("turn") % 3 == 2, c("question"))
    return pairs(spark, sf).select("conv_id", "turn", R.with_context(c("question"), context).alias("q"))


SQL_CHOICES = f"CASE WHEN len(choices) = 0 THEN '' ELSE {NL} || 'Choices:' || {NL} || array_to_string(choices, {NL}) END"


@query("choices_lines", f"SELECT row_id, question || {SQL_CHOICES} AS q FROM {SQL_MC}")
def choices_lines(spark, sf):
    return multiple_choice(spark, sf).select("row_id", R.choices_lines(c("question"), c("choices")).alias("q"))


@query(
    "choices_text",
    f"SELECT row_id, question || CASE WHEN lecture IS NULL OR lecture = '' THEN '' ELSE {NL} || 'Choices:' || {NL} || lecture END AS q FROM {SQL_MC}",
)
def choices_text(spark, sf):
    return multiple_choice(spark, sf).select("row_id", R.choices_text(c("question"), c("lecture")).alias("q"))


@query("choices_inline", f"SELECT row_id, question || CASE WHEN len(choices) = 0 THEN '' ELSE {NL} || 'Choices: ' || array_to_string(choices, ', ') END AS q FROM {SQL_MC}")
def choices_inline(spark, sf):
    return multiple_choice(spark, sf).select("row_id", R.choices_inline(c("question"), c("choices")).alias("q"))


SQL_LABELLED = (
    f"coalesce(array_to_string(list_transform(range(1, least(len(choices), len(labels)) + 1), lambda i: labels[i] || ': ' || choices[i]), {NL}), '')"
)


@query(
    "choices_labelled",
    f"SELECT row_id, question || {NL} || 'Choices:' || {NL} || {SQL_LABELLED} AS q, question || {NL} || {SQL_LABELLED} AS bare FROM {SQL_MC}",
)
def choices_labelled(spark, sf):
    args = c("question"), c("labels"), c("choices")
    return multiple_choice(spark, sf).select(
        "row_id", R.choices_labelled(*args, "\nChoices:\n").alias("q"), R.choices_labelled(*args, "\n").alias("bare")
    )


SQL_INDEXED = (
    "CASE WHEN answer IS NULL THEN NULL WHEN len(choices) = 0 THEN 'Answer: ' || answer "
    "WHEN answer >= 0 AND answer < len(choices) THEN 'Answer: ' || choices[answer + 1] END"
)


@query(
    "answer_by_index",
    f"SELECT row_id, {SQL_INDEXED} AS line, CASE WHEN answer >= 0 AND answer < len(choices) "
    f"THEN 'The correct answer is ' || choices[answer + 1] || '.' ELSE coalesce(answer::VARCHAR, 'None') END AS sentence FROM {SQL_MC}",
)
def answer_by_index(spark, sf):
    return multiple_choice(spark, sf).select(
        "row_id", R.indexed_answer(c("answer"), c("choices")).alias("line"),
        R.indexed_sentence(c("answer"), c("choices")).alias("sentence"),
    )


@query(
    "answer_by_value",
    f"SELECT row_id, 'Answer: ' || v AS line, coalesce(v, 'None') AS sentence FROM (SELECT row_id, CASE WHEN row_id % 2 = 0 THEN answer::VARCHAR ELSE answer_key END AS v FROM {SQL_MC})",
)
def answer_by_value(spark, sf):
    """Answers that come as texts, some of them digits, are printed."""
    mc = multiple_choice(spark, sf)
    mixed = mc.withColumn("answer", F.when(c("row_id") % 2 == 0, c("answer").cast("string")).otherwise(c("answer_key")))
    return mixed.select(
        "row_id", R.indexed_answer(c("answer"), c("choices"), integer=False).alias("line"),
        R.indexed_sentence(c("answer"), c("choices"), integer=False).alias("sentence"),
    )


@query("answer_key", f"SELECT row_id, 'The correct answer is ' || coalesce(answer_key, 'None') || '.' AS sentence FROM {SQL_MC}")
def answer_key(spark, sf):
    return multiple_choice(spark, sf).select("row_id", R.key_sentence(c("answer_key")).alias("sentence"))


@query(
    "answer_parts",
    f"SELECT row_id, concat_ws({NL}, nullif(lecture, ''), {SQL_INDEXED}) AS answer FROM {SQL_MC} "
    f"WHERE nullif(lecture, '') IS NOT NULL OR {SQL_INDEXED} IS NOT NULL",
)
def answer_parts(spark, sf):
    parts = R.joined_parts(R.present(c("lecture")), R.indexed_answer(c("answer"), c("choices")))
    return non_null(multiple_choice(spark, sf), "row_id", answer=parts)


@query(
    "fact_qa",
    f"SELECT row_id, 'Question: ' || question || CASE WHEN least(len(choices), len(labels)) = 0 THEN '' ELSE {NL} || {SQL_LABELLED} END "
    f"|| CASE WHEN answer_key IS NULL THEN '' ELSE {NL} || 'Answer: ' || answer_key END AS fact FROM {SQL_MC}",
)
def fact_qa(spark, sf):
    fact = R.fact_qa(c("question"), c("labels"), c("choices"), c("answer_key"))
    return multiple_choice(spark, sf).select("row_id", fact.alias("fact"))


# ---------------------------------------------------------------- dialogues


@query(
    "group_dialogue",
    f"""SELECT split, conv_id, count(*) AS n_turns,
 '[CONVERSATION]' || {NL} || string_agg('Person' || turn % 2 || ': ' || t, {NL} ORDER BY turn) || {NL} || {NL} AS block
 FROM (SELECT CASE WHEN conv_id % 2 = 0 THEN 'train' ELSE 'test' END AS split, conv_id, turn, {sql_clean("text")} AS t
 FROM conversations) WHERE t <> '' GROUP BY ALL HAVING count(*) >= 2""",
)
def group_dialogue(spark, sf):
    rows = table(spark, sf, "conversations").withColumn("split", F.when(c("conv_id") % 2 == 0, "train").otherwise(F.lit("test")))
    keyed = rows.withColumn("_c", F.concat_ws(":", "split", "conv_id"))
    person = F.concat(F.lit("Person"), c("turn") % 2)
    blocks = D.conversation_blocks(keyed, "_c", "turn", person, c("text"))
    parts = F.split("_c", ":")
    return blocks.select(parts[0].alias("split"), parts[1].cast("bigint").alias("conv_id"), "n_turns", "block")


SQL_LONG = f"""SELECT kind, dialogue, sum(length(l) + 1)::BIGINT + 16 AS weight,
 md5('[CONVERSATION]' || {NL} || string_agg(l, {NL} ORDER BY o) || {NL} || {NL}) AS digest FROM (SELECT kind, dialogue, o, speaker || ': ' || t AS l FROM
 (SELECT 'merged' AS kind, conv_id % 3 AS dialogue, conv_id * 4294967296 + turn AS o, CASE role WHEN 'user' THEN 'User' ELSE 'Assistant' END AS speaker,
 {sql_clean("text")} AS t FROM conversations UNION ALL SELECT 'by row', 0, conv_id * 4294967296 + turn, 'Person' || turn % 2, {sql_clean("text")} FROM conversations)
 WHERE t <> '') GROUP BY ALL HAVING count(*) >= 2"""


@query("long_dialogue", SQL_LONG)
def long_dialogue(spark, sf):
    """All conversations in three dialogues ordered by a wide turn, and in one that a recipe orders by its row numbers."""
    rows = table(spark, sf, "conversations").withColumn("row_id", F.shiftleft(c("conv_id").cast("bigint"), 32) + c("turn"))
    speaker = F.when(c("role") == "user", "User").otherwise(F.lit("Assistant"))
    merged = D.conversation_blocks(rows.withColumn("dialogue", c("conv_id") % 3), "dialogue", "row_id", speaker, c("text"))
    utterances = rows.select("row_id", F.lit(0).alias("conv_id"), (c("turn") % 2).alias("speaker_idx"), c("text").alias("utterance"))
    plain = render(RECIPES["C2"], utterances)
    both = [
        merged.select(F.lit("merged").alias("kind"), c("dialogue").cast("bigint").alias("dialogue"), "weight", "block"),
        plain.select(F.lit("by row").alias("kind"), F.lit(0).cast("bigint").alias("dialogue"), "weight", "block"),
    ]
    return both[0].unionByName(both[1]).withColumn("digest", F.md5("block")).drop("block")


# Dialogues as lists: the lines of a document.
SQL_LINES = f"(SELECT doc_id, string_split(text, {NL}) AS dialog FROM documents)"


def dialog_lists(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.split("text", "\n").alias("dialog"))


SQL_ALTERNATE = f"list_transform(range(1, len(dialog) + 1), lambda i: CASE WHEN i % 2 = 1 THEN 'User' ELSE 'Assistant' END || ': ' || {sql_clean('dialog[i]')})"
SQL_SHOWN = "list_filter({0}, lambda x: x <> 'User: ' AND x <> 'Assistant: ')"


@query(
    "alternate_speakers",
    f"SELECT doc_id, '[CONVERSATION]' || {NL} || array_to_string(l, {NL}) || {NL} || {NL} AS block "
    f"FROM (SELECT doc_id, {SQL_SHOWN.format(SQL_ALTERNATE)} AS l FROM {SQL_LINES}) WHERE len(l) >= 2",
)
def alternate_speakers(spark, sf):
    block = R.conversation_block(D.alternate(c("dialog")))
    return non_null(dialog_lists(spark, sf), "doc_id", block=block)


@query(
    "history_reply",
    f"""SELECT doc_id, '[CONVERSATION]' || {NL} || array_to_string(l, {NL}) || {NL} || {NL} AS block FROM (
 SELECT doc_id, list_concat({SQL_SHOWN.format(SQL_ALTERNATE)}, CASE WHEN {sql_clean("lang")} <> '' THEN ['Assistant: ' || lang] ELSE [] END) AS l
 FROM (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN '' ELSE lang END AS lang, string_split(text, {NL}) AS dialog FROM documents)) WHERE len(l) >= 2""",
)
def history_reply(spark, sf):
    rows = table(spark, sf, "documents").select(
        "doc_id", F.split("text", "\n").alias("history"),
        F.array(F.lit("other"), F.when(c("doc_id") % 3 == 0, "").otherwise(c("lang"))).alias("candidates"),
    )
    block = R.conversation_block(D.with_reply(c("history"), F.element_at("candidates", -1)))
    return non_null(rows, "doc_id", block=block)


@query(
    "adjacent_pairs",
    f"SELECT doc_id, unnest(p).q AS question, unnest(p).a AS answer FROM (SELECT doc_id, list_filter(list_transform("
    f"range(1, len(dialog)), lambda i: {{'q': dialog[i], 'a': dialog[i + 1]}}), lambda x: x.q <> '' AND x.a <> '') AS p FROM {SQL_LINES})",
)
def adjacent_pairs(spark, sf):
    rows = dialog_lists(spark, sf).select("doc_id", F.explode(D.adjacent_pairs(c("dialog"))).alias("p"))
    return rows.select("doc_id", "p.question", "p.answer")


SQL_CORRECTIONS = """(SELECT p_partkey, p_name, unnest(CASE WHEN p_size % 4 = 0 THEN NULL WHEN p_size % 4 = 1 THEN []
 ELSE [p_brand, '', p_type] END) AS correction FROM part)"""


@query(
    "explode_corrections",
    "SELECT p_partkey, "
    + sql_qa("'Improve the grammar and fluency of this sentence:' || chr(10) || p_name", "correction", "LANGUAGE")
    + f" AS block FROM {SQL_CORRECTIONS} WHERE correction <> ''",
)
def explode_corrections(spark, sf):
    n = c("p_size") % 4
    corrections = F.when(n == 1, F.array().cast("array<string>")).when(n > 1, F.array("p_brand", F.lit(""), "p_type"))
    rows = table(spark, sf, "part").select("p_partkey", "p_name", F.explode(corrections).alias("correction"))
    return blocks_of(rows.filter(c("correction") != ""), ["p_partkey"], R.prompted("fluency", c("p_name")), c("correction"), "LANGUAGE")


@query(
    "fixed_reply",
    f"SELECT conv_id, turn, '[CONVERSATION]' || {NL} || CASE WHEN role = 'user' THEN 'User: ' ELSE 'Assistant: ' END || t || {NL} || 'Assistant: Understood.' "
    f"|| {NL} || {NL} AS block FROM (SELECT conv_id, turn, role, {sql_clean('text')} AS t FROM conversations) WHERE t <> ''",
)
def fixed_reply(spark, sf):
    speaker = F.when(c("role") == "user", "User").otherwise(F.lit("Assistant"))
    turns = F.array(
        F.struct(speaker.alias("speaker"), c("text").alias("text")), D.turn_of("Assistant", F.lit(R.UNDERSTOOD))
    )
    return non_null(table(spark, sf, "conversations"), "conv_id", "turn", block=R.conversation_block(turns))


@query(
    "messages_to_turns",
    f"""SELECT row_id, '[CONVERSATION]' || {NL} || array_to_string(l, {NL}) || {NL} || {NL} AS block FROM (SELECT p_partkey AS row_id,
 list_filter(['User: ' || p_name, CASE WHEN p_size % 2 = 0 THEN 'Assistant: ' || p_brand END, CASE WHEN p_size % 3 = 0 THEN 'User: ' || p_type END],
 lambda x: x IS NOT NULL) AS l FROM part) WHERE len(l) >= 2""",
)
def messages_to_turns(spark, sf):
    """A system message and empty contents are in the arrays and must go."""
    m = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    messages = F.array(
        m("system", c("p_type")), m("user", c("p_name")),
        m("assistant", F.when(c("p_size") % 2 == 0, c("p_brand")).otherwise(F.lit(""))),
        m("user", F.when(c("p_size") % 3 == 0, c("p_type"))),
    )
    block = R.conversation_block(D.messages_to_turns(messages))
    return non_null(table(spark, sf, "part"), c("p_partkey").alias("row_id"), block=block)
