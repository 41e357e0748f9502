"""The seven corpora, every source filled from the given tables.

Each source is stated twice: as a frame for its recipe, and as SQL that gives its questions and
answers, its conversations or its documents.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from textmill.catalog.base import NL, query, sql_clean, sql_qa, table
from textmill.catalog.cleaning import SQL_TITLE, titled_documents
from textmill.catalog.mixing import sql_budget
from textmill.catalog.rendering import (
    SQL_CHOICES, SQL_INDEXED, SQL_LABELLED, SQL_MC, SQL_PAIRS, multiple_choice, pairs,
)
from textmill.plans.builders import CORPORA, build_corpus, source_report


def c(name):
    return F.col(name)


# ---------------------------------------------------------------- frames

SQL_TALK = f"(SELECT conv_id * 4294967296 + turn AS row_id, conv_id, turn, question, answer FROM {SQL_PAIRS})"
SQL_MSG = """(SELECT conv_id * 4294967296 + turn AS row_id, CASE WHEN conv_id % 3 > 0 THEN 'en' ELSE 'fr' END AS lang,
 CASE role WHEN 'user' THEN 'prompter' ELSE role END AS role, conv_id, turn, text FROM conversations)"""
SQL_TITLED = f"(SELECT doc_id AS row_id, text, lang, {SQL_TITLE} AS title FROM documents)"
SQL_PART = "(SELECT p_partkey AS row_id, p_name, p_brand, p_type, p_size FROM part)"


def talk(spark, sf):
    return pairs(spark, sf).withColumn("row_id", F.shiftleft(c("conv_id").cast("bigint"), 32) + c("turn"))


def messages(spark, sf):
    role = F.when(c("role") == "user", "prompter").otherwise(c("role"))
    lang = F.when(c("conv_id") % 3 > 0, "en").otherwise(F.lit("fr"))
    rows = table(spark, sf, "conversations")
    return rows.select((F.shiftleft(c("conv_id").cast("bigint"), 32) + c("turn")).alias("row_id"), lang.alias("lang"), role.alias("role"), "conv_id", "turn", "text")


def titled(spark, sf):
    return titled_documents(spark, sf).withColumnRenamed("doc_id", "row_id").drop("source")


def parts(spark, sf):
    return table(spark, sf, "part").withColumnRenamed("p_partkey", "row_id")


def lists(spark, sf):
    return titled(spark, sf).select("row_id", F.split("text", "\n").alias("dialog"))


def keyed_choices(spark, sf):
    table_ = F.struct(c("labels").alias("label"), c("choices").alias("text"))
    return multiple_choice(spark, sf).select("row_id", "question", table_.alias("choices"), c("answer_key").alias("answerKey"))


def instructions(spark, sf):
    context = F.when(c("turn") % 3 == 1, "").when(c("turn") % 3 == 2, c("question"))
    return talk(spark, sf).select("row_id", c("question").alias("instruction"), context.alias("context"), c("answer").alias("response"))


def frames(name, spark, sf):
    t, mc, docs, part = talk(spark, sf), multiple_choice(spark, sf), titled(spark, sf), parts(spark, sf)
    cell = docs.withColumn("title", F.when(c("row_id") % 2 == 0, F.concat(F.lit("Cell "), "title")).otherwise(c("title")))
    if name == "math":
        return {
            "H1": t, "H6": t,
            "H2": mc.select("row_id", c("question").alias("Problem"), F.array_join("choices", ", ").alias("options"),
                            c("answer_key").alias("correct"), c("lecture").alias("Rationale")),
            "H3": mc.select("row_id", "question", c("choices").alias("options"), c("answer_key").alias("correct"),
                            c("lecture").alias("rationale")),
            "H4": mc.select("row_id", c("lecture").alias("Body"), c("question").alias("Question"),
                            c("answer").alias("Answer"), c("answer_key").alias("Equation")),
            "H5": t.select("row_id", c("question").alias("body"), c("answer").alias("solution"),
                           F.when(c("turn") % 2 == 0, c("question")).alias("answer")),
        }
    if name == "language":
        n = c("p_size") % 4
        fixes = F.when(n == 1, F.array().cast("array<string>")).when(n > 1, F.array("p_brand", F.lit(""), "p_type"))
        labels = table(spark, sf, "labels").select(c("doc_id").alias("row_id"), c("quality").alias("label"))
        return {
            "G1": t.select("row_id", c("question").alias("input"), c("answer").alias("output")),
            "G2": part.select("row_id", c("p_name").alias("sentence"), fixes.alias("corrections")),
            "G3": part.select("row_id", c("p_name").alias("word"), c("p_type").alias("definition")),
            "G4": docs.join(labels, "row_id").select("row_id", c("title").alias("sentence1"), c("text").alias("sentence2"), "label"),
            "G5": t.select("row_id", "question", c("answer").alias("context"),
                           F.struct(F.array("question", "answer").alias("text")).alias("answers")),
            "G6": lists(spark, sf), "G7": lists(spark, sf),
        }
    if name == "knowledge":
        return {
            "K1": instructions(spark, sf), "K2": messages(spark, sf), "K3": mc, "K4": keyed_choices(spark, sf), "K5": t,
            "K6": part.select("row_id", c("p_name").alias("question"), F.struct(c("p_type").alias("value")).alias("answer")),
            "K7": docs, "K8": mc.select("row_id", "question", c("choices").alias("answers")),
        }
    if name == "science":
        return {
            "N1": mc, "N2": keyed_choices(spark, sf),
            "N3": keyed_choices(spark, sf).withColumnRenamed("question", "question_stem"),
            "N4": t.select("row_id", F.when(c("turn") % 2 == 0, c("question")).otherwise(F.lit("")).alias("question"),
                           c("question").alias("prompt"), c("answer").alias("solution")),
            "N5": mc.select("row_id", "question", c("answer").alias("cop"), c("lecture").alias("exp")),
            "N6": t.select("row_id", "question", F.lit("").alias("answer"), c("answer").alias("explanation")), "N7": cell,
        }
    if name == "conversation":
        said = F.when(c("role") == "prompter", "user").otherwise(c("role"))
        msgs = F.array(F.struct(said.alias("role"), c("text").alias("content")),
                       F.struct(F.lit("assistant").alias("role"), c("lang").alias("content")))
        return {
            "C1": messages(spark, sf),
            "C2": messages(spark, sf).select("row_id", "conv_id", "turn", (c("turn") % 2).alias("speaker_idx"), c("text").alias("utterance")),
            "C3": lists(spark, sf).select("row_id", c("dialog").alias("history"), F.array(F.lit("no"), F.lit("yes")).alias("candidates")),
            "C4": lists(spark, sf), "C5": messages(spark, sf).select("row_id", msgs.alias("messages")),
            "C6": lists(spark, sf).withColumnRenamed("dialog", "dialogue"), "C7": instructions(spark, sf), "C8": messages(spark, sf),
        }
    if name in ("facts", "writing"):
        return {k: three_splits(df) for k, df in document_frames(name, docs, t, keyed_choices(spark, sf)).items()}
    raise KeyError(name)


def three_splits(df):
    """A third of the rows in each split; row ids repeat: those of the train split are found in the others as well."""
    split = F.when(c("row_id") % 3 == 0, "train").otherwise(F.when(c("row_id") % 3 == 1, "test").otherwise(F.lit("validation")))
    other = df.filter(c("row_id") % 3 == 0).withColumn("split", F.lit("test"))
    return df.withColumn("split", split).unionByName(other)


def document_frames(name, docs, t, choices):
    if name == "facts":
        return {
            "F1": docs, "F2": docs.filter(c("lang") == "en"),
            "F3": docs.select("row_id", F.array("title", "lang").alias("source")), "F4": choices,
            "F5": t.select("row_id", c("answer").alias("text")),
        }
    return {"W1": docs, "W2": t.select("row_id", c("question").alias("text")), "W3": docs.filter(c("lang") != "en"),
            "W4": docs.select("row_id", c("text").alias("report"))}


# ---------------------------------------------------------------- SQL twins


def said(prompt: str, q: str) -> str:
    return f"'{prompt}' || {NL} || {q}"


WITH_CONTEXT = f"question || CASE WHEN turn % 3 = 2 THEN {NL} || {NL} || 'Context:' || {NL} || question ELSE '' END"
KEY_SENTENCE = "'The correct answer is ' || coalesce(answer_key, 'None') || '.'"
KEYED = f"question || {NL} || 'Choices:' || {NL} || {SQL_LABELLED}"
REASONS = f"concat_ws({NL}, nullif(lecture, ''), 'Correct answer: ' || answer_key)"
SOME = "(nullif(lecture, '') IS NOT NULL OR answer_key IS NOT NULL)"
OPTIONS = f"CASE WHEN len(choices) = 0 THEN '' ELSE {NL} || 'Choices:' || {NL} || array_to_string(choices, ', ') END"
ADJACENT = (
    f"(SELECT doc_id || ':' || (row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1) AS row_id, q, a FROM (SELECT doc_id, i, l[i] AS q, l[i + 1] AS a FROM "
    f"(SELECT doc_id, l, unnest(range(1, len(l))) AS i FROM (SELECT doc_id, string_split(text, {NL}) AS l FROM documents))) WHERE q <> '' AND a <> '')"
)
FIXES = (
    "(SELECT row_id || ':' || i AS row_id, p_name, CASE i WHEN 0 THEN p_brand ELSE p_type END AS fix FROM "
    f"{SQL_PART}, (SELECT unnest([0, 1]) AS i) WHERE p_size % 4 > 1)"
)
LABELLED_DOCS = f"(SELECT d.*, l.quality FROM {SQL_TITLED} d JOIN labels l ON l.doc_id = d.row_id WHERE l.quality = 1)"
CELLS = f"(SELECT row_id, text, title, 'Cell ' || title AS cell FROM {SQL_TITLED} WHERE row_id % 2 = 0 AND length({sql_clean('text')}) >= 200)"
ARTICLES = f"(SELECT * FROM {SQL_TITLED} WHERE title <> '' AND text <> '' AND length({sql_clean('text')}) >= 100)"

# recipe -> (source, question, answer, condition)
QA = {
    "H1": (SQL_TALK, said("Solve this math problem step by step:", "question"), "answer", "true"),
    "H2": (SQL_MC, f"question || {OPTIONS}", REASONS, SOME),
    "H3": (SQL_MC, f"question || {SQL_CHOICES}", REASONS, SOME),
    "H4": (SQL_MC, f"CASE WHEN nullif(lecture, '') IS NULL THEN '' ELSE lecture || {NL} END || question",
           f"concat_ws({NL}, 'Equation: ' || answer_key, 'Answer: ' || answer)", "(answer_key IS NOT NULL OR answer IS NOT NULL)"),
    "H5": (SQL_TALK, said("Solve this problem and explain the reasoning:", "question"),
           f"concat_ws({NL}, answer, CASE WHEN turn % 2 = 0 THEN 'Answer: ' || question END)", "true"),
    "H6": (SQL_TALK, said("Solve this algebra problem:", "question"), "answer", "true"),
    "G1": (SQL_TALK, said("Correct the grammar in this sentence:", "question"), "answer", "true"),
    "G2": (FIXES, said("Improve the grammar and fluency of this sentence:", "p_name"), "fix", "true"),
    "G3": (SQL_PART, "'What does the word ' || p_name || ' mean?'", "p_type", "true"),
    "G4": (LABELLED_DOCS, said("Rewrite this sentence using different wording while keeping the same meaning:", "title"), "text", "title <> ''"),
    "G5": (SQL_TALK, f"question || {NL} || {NL} || 'Context:' || {NL} || answer", "question", "true"),
    "G6": (ADJACENT, "q", "a", "true"),
    "G7": (ADJACENT, "q", "a", "true"),
    "K1": (SQL_TALK, WITH_CONTEXT, "answer", "true"),
    "K2": (SQL_MSG, "text", "'Please provide a complete and accurate answer.'", "lang = 'en' AND role = 'prompter' AND text <> ''"),
    "K3": (SQL_MC, "question || CASE WHEN len(choices) = 0 THEN '' ELSE chr(10) || 'Choices: ' || array_to_string(choices, ', ') END",
           "CASE WHEN answer >= 0 AND answer < len(choices) THEN 'The correct answer is ' || choices[answer + 1] || '.' ELSE coalesce(answer::VARCHAR, 'None') END", "true"),
    "K4": (SQL_MC, f"question || {NL} || {SQL_LABELLED}", KEY_SENTENCE, "true"),
    "K5": (SQL_TALK, "question", "answer", "true"),
    "K6": (SQL_PART, "p_name", "p_type", "true"),
    "K7": (ARTICLES, "'Explain what ' || title || ' is and provide useful factual information about it.'", f"substr({sql_clean('text')}, 1, 4000)", "true"),
    "K8": (SQL_MC, "question", "array_to_string(choices, ', ')", "len(choices) > 0"),
    "N1": (SQL_MC, f"question || {SQL_CHOICES}", f"concat_ws({NL}, nullif(lecture, ''), {SQL_INDEXED})",
           f"(nullif(lecture, '') IS NOT NULL OR {SQL_INDEXED} IS NOT NULL)"),
    "N2": (SQL_MC, KEYED, KEY_SENTENCE, "true"),
    "N3": (SQL_MC, KEYED, KEY_SENTENCE, "true"),
    "N4": (SQL_TALK, said("Explain and solve this physics question:", "question"), "answer", "true"),
    "N5": (SQL_MC, said("Answer this biology or medical science question:", "question"),
           f"concat_ws({NL}, nullif(lecture, ''), 'Correct option: ' || answer)", "(nullif(lecture, '') IS NOT NULL OR answer IS NOT NULL)"),
    "N6": (SQL_TALK, said("Explain the scientific reasoning behind this question:", "question"), "answer", "true"),
    "N7": (CELLS, "'Explain the scientific topic of ' || cell || ' in a clear and useful way.'", f"substr({sql_clean('text')}, 1, 5000)", "true"),
}

LINES = f"(SELECT doc_id AS row_id, string_split(text, {NL}) AS l FROM documents)"
ALTERNATING = (
    f"list_filter(list_transform(range(1, len(l) + 1), lambda i: CASE WHEN {sql_clean('l[i]')} <> '' THEN CASE WHEN i % 2 = 1 THEN 'User: ' ELSE 'Assistant: ' END || {sql_clean('l[i]')} END), lambda x: x IS NOT NULL)"
)


def two_lines(first: str, second: str) -> str:
    return f"list_filter([{first}, {second}], lambda x: x IS NOT NULL)"


def line(speaker: str, text: str) -> str:
    return f"CASE WHEN {sql_clean(text)} <> '' THEN {speaker} || ': ' || {sql_clean(text)} END"


ASKER = "CASE WHEN role = 'prompter' THEN 'User' ELSE 'Assistant' END"
# recipe -> (source, list of lines, condition)
TALKS = {
    "C1": (SQL_MSG, two_lines(line(ASKER, "text"), "'Assistant: Understood.'"), "lang = 'en' AND text <> ''"),
    "C3": (LINES, f"list_concat({ALTERNATING}, ['Assistant: yes'])", "true"),
    "C4": (LINES, ALTERNATING, "true"),
    "C5": (SQL_MSG, two_lines(f"CASE WHEN role IN ('prompter', 'assistant') THEN {line(ASKER, 'text')} END", "'Assistant: ' || lang"), "true"),
    "C6": (LINES, ALTERNATING, "true"),
    "C7": (SQL_TALK, two_lines(line("'User'", WITH_CONTEXT), line("'Assistant'", "answer")), "true"),
}
# recipe -> (source, text, length, condition), in reading order
DOCS = {
    "facts": {
        "F1": (SQL_TITLED, f"CASE WHEN title = '' THEN text ELSE title || {NL} || text END", 40, "text <> ''"),
        "F2": (f"(SELECT * FROM {SQL_TITLED} WHERE lang = 'en')", "text", 40, "text <> ''"),
        "F3": (SQL_TITLED, "title || ' ' || lang", 40, "true"),
        "F4": (SQL_MC, f"'Question: ' || question || CASE WHEN least(len(choices), len(labels)) = 0 THEN '' ELSE {NL} || {SQL_LABELLED} END "
               f"|| CASE WHEN answer_key IS NULL THEN '' ELSE {NL} || 'Answer: ' || answer_key END", 40, "true"),
        "F5": (SQL_TALK, "answer", 40, "true"),
    },
    "writing": {
        "W1": (SQL_TITLED, "text", 30, "text <> ''"), "W2": (SQL_TALK, "question", 30, "true"),
        "W3": (f"(SELECT * FROM {SQL_TITLED} WHERE lang <> 'en')", "text", 30, "text <> ''"), "W4": (SQL_TITLED, "text", 30, "text <> ''"),
    },
}


def label(key: str) -> str:
    recipe = next(r for corpus in CORPORA.values() for r in corpus.recipes if r.key == key)
    return f"{key}:{recipe.source}"


def sql_qa_source(key: str, tag: str) -> str:
    source, q, a, cond = QA[key]
    return (
        f"SELECT '{label(key)}' AS source, 'train:' || row_id AS row_key, {sql_qa('q_', 'a_', tag)} AS block FROM "
        f"(SELECT row_id, {sql_clean(q)} AS q_, {sql_clean(a)} AS a_ FROM {source} WHERE {cond}) WHERE q_ <> '' AND a_ <> ''"
    )


def sql_talk_source(key: str) -> str:
    source, lines, cond = TALKS[key]
    block = f"'[CONVERSATION]' || {NL} || array_to_string(l_, {NL}) || {NL} || {NL}"
    return (
        f"SELECT '{label(key)}' AS source, 'train:' || row_id AS row_key, {block} AS block FROM "
        f"(SELECT row_id, {lines} AS l_ FROM {source} WHERE {cond}) WHERE len(l_) >= 2"
    )


UTTERANCES = (
    f"SELECT '{label('C2')}' AS source, 'train:' || conv_id AS row_key, '[CONVERSATION]' || {NL} || string_agg('Person' || turn % 2 || ': ' || t, {NL} ORDER BY turn) "
    f"|| {NL} || {NL} AS block FROM (SELECT conv_id, turn, {sql_clean('text')} AS t FROM conversations) WHERE t <> '' GROUP BY conv_id HAVING count(*) >= 2"
)


def sql_corpus(name: str) -> str:
    keys = [r.key for r in CORPORA[name].recipes]
    if name == "conversation":
        return " UNION ALL ".join([*(sql_talk_source(k) for k in keys if k in TALKS), UTTERANCES])
    return " UNION ALL ".join(sql_qa_source(k, name.upper()) for k in keys)


def sql_read_until_full(name: str, limit: int) -> str:
    rows = " UNION ALL ".join(
        f"SELECT {i} AS so, '{label(k)}' AS source, row_id, CASE WHEN {cond} AND length({sql_clean(text)}) >= {n} THEN {sql_clean(text)} || {NL} || {NL} END AS block FROM {source} WHERE row_id % 3 = 0"
        for i, (k, (source, text, n, cond)) in enumerate(DOCS[name].items())
    )
    return (
        "SELECT source, 'train:' || row_id AS row_key, block FROM (SELECT *, coalesce(sum(coalesce(length(block), 0)) OVER (ORDER BY so, row_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, "
        f"row_number() OVER (PARTITION BY so ORDER BY row_id) AS r FROM ({rows})) WHERE (before < {limit} OR r = 1 OR source LIKE 'F4%') AND block IS NOT NULL"
    )


LIMITS = {
    "conversation": 900_000, "language": 900_000, "knowledge": 900_000, "science": 900_000, "math": 400_000,
    "facts": 900_000, "writing": 900_000,
}

# recipe -> rows it counts, where a cleaned text can come out empty after the count
SQL_TRIED = {
    "G6": "documents", "G7": "documents", "G2": "(SELECT * FROM part WHERE p_size % 4 > 1)", "C2": "(SELECT * FROM conversations WHERE text <> '')",
    "C8": f"(SELECT * FROM {SQL_MSG} WHERE lang = 'en' AND text <> '')",
}


def sql_tried(name: str) -> str:
    parts = []
    for r in CORPORA[name].recipes:
        if r.key in SQL_TRIED:
            rows = SQL_TRIED[r.key]
        elif r.key in QA or r.key in TALKS:
            source, *_, cond = (QA if r.key in QA else TALKS)[r.key]
            rows = f"(SELECT * FROM {source} WHERE {cond})"
        else:
            source, _, _, cond = DOCS[name][r.key]
            rows = f"(SELECT * FROM {source} WHERE row_id % 3 = 0 AND {cond})"
        parts.append(f"SELECT '{label(r.key)}' AS source, count(*) AS attempted, 0 AS kept FROM {rows}")
    return " UNION ALL ".join(parts)


def register(name: str) -> None:
    limit = LIMITS[name]
    blocks = sql_read_until_full(name, limit) if CORPORA[name].saturating else sql_corpus(name)

    @query(f"{name}_corpus", f"SELECT source, row_key, running, block FROM {sql_budget(f'({blocks})', limit)}")
    def corpus(spark, sf):
        return build_corpus(name, frames(name, spark, sf), budget=limit).select("source", "row_key", "running", "block")

    @query(
        f"{name}_report",
        f"SELECT source, sum(attempted)::BIGINT AS attempted, sum(kept)::BIGINT AS kept FROM ({sql_tried(name)} UNION ALL "
        f"SELECT source, 0, count(*) FROM ({blocks}) GROUP BY source) GROUP BY source",
    )
    def report(spark, sf):
        return source_report(name, frames(name, spark, sf), limit)


for _name in CORPORA:
    register(_name)
