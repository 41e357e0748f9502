"""The seven corpora: which recipes they mix and how they are cut."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.functions.render import document_block
from textmill.operators import mixture as M
from textmill.operators.prefix import take_while
from textmill.plans import recipes as P
from textmill.session import cut_lineage
from textmill.sources.ordered import KeyRanges, OrderedFiles, Source, measure, ordered, whole


@dataclass(frozen=True)
class Corpus:
    name: str
    recipes: list[P.Recipe]
    budget: int
    saturating: bool = False


CORPORA = {
    c.name: c
    for c in [
        Corpus("conversation", P.CONVERSATION, M.BUDGET_MIXED),
        Corpus("language", P.LANGUAGE, M.BUDGET_MIXED),
        Corpus("knowledge", P.KNOWLEDGE, M.BUDGET_MIXED),
        Corpus("science", P.SCIENCE, M.BUDGET_MIXED),
        Corpus("math", P.MATH, M.BUDGET_MIXED),
        Corpus("facts", P.FACTS, M.BUDGET_FACTS, saturating=True),
        Corpus("writing", P.WRITING, M.BUDGET_WRITING, saturating=True),
    ]
}


def union_blocks(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def build_corpus(
    name: str, frames: Mapping[str, Source | None], *, budget: int | None = None, seed: int = M.SEED
) -> DataFrame:
    """Blocks of a corpus in shuffled order, cut at its budget.

    ``frames`` maps recipe keys to source frames, or to files in order; a missing or unreadable source (None) is left
    out unless its recipe needs it.
    """
    corpus = CORPORA[name]
    limit = corpus.budget if budget is None else budget
    used = []
    for r in corpus.recipes:
        if frames.get(r.key) is not None:
            used.append((r, frames[r.key]))
        elif r.needed:
            raise ValueError(f"source {r.source} of {name} is required")
    if not used:
        raise ValueError(f"no source of {name} can be read")
    if corpus.saturating:
        return _read_until_full(used, limit, seed)
    blocks = union_blocks([P.render(r, whole(df)) for r, df in used])
    return M.char_budget(blocks, limit, seed)


def _documents(i: int, r: P.Recipe, df: DataFrame) -> DataFrame:
    """Rows of a document source; those that fail the filter have a null block. They are read too, so they stay in the order."""
    c = P.Fields(df)
    return df.select(
        F.lit(r.domain).alias("domain"), F.lit(r.key + ":" + r.source).alias("source"), P.row_key(df).alias("row_key"),
        F.when(r.keep(c), document_block(r.text(c), r.min_chars)).alias("block"), F.coalesce(r.keep(c), F.lit(False)).alias("counted"),
        F.lit(i).alias("source_ord"), F.col("row_id").cast("bigint").alias("row_ord"), F.lit(r.checked).alias("checked"),
    )


def _read_source(i: int, r: P.Recipe, parts: OrderedFiles | KeyRanges, room: int) -> tuple[DataFrame | None, int, int]:
    """(documents, rows, characters) of one source, written: parts are read until the room is filled or the recipe's cap is met.

    A part with rows is rendered once, and read even where there is no room, as a source gives its first row in any case.
    """
    read, chars, counted, n = [], 0, 0, 0
    for part in parts.parts("row_id"):
        rows = cut_lineage(_documents(i, r, part).withColumn("weight", F.length("block").cast("bigint")))
        found = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum("weight"), F.lit(0)).alias("c"), F.count_if("counted").alias("k")).first()
        if not found["n"]:
            continue
        read.append(rows)
        n, chars, counted = n + found["n"], chars + found["c"], counted + found["k"]
        if r.checked and chars >= room or r.cap is not None and counted >= r.cap:
            break
    if not read:
        return None, 0, 0
    rows = union_blocks(read)
    # Only sources with a cap stop by the rows kept; with room left, the cap decides what was read.
    if r.cap is not None and counted > r.cap:
        rows = cut_lineage(take_while(rows, F.col("counted"), r.cap, "row_ord"))
        chars = rows.agg(F.coalesce(F.sum("weight"), F.lit(0)).alias("c")).first()["c"]
    return rows, n, chars


def read_until_full(used: list[tuple[P.Recipe, Source]], limit: int) -> tuple[DataFrame, DataFrame]:
    """The documents of the leading parts of the sources, and the sizes (source, row_key, weight) of those read before the corpus is full."""
    documents, n, total = [], 0, 0
    sources = [ordered(source).mapped(partial(P.of_split, r)) for r, source in used]
    measure(sources, "row_id")
    for i, ((r, _), source) in enumerate(zip(used, sources, strict=True)):
        rows, n_rows, chars = _read_source(i, r, source, limit - total)
        if rows is not None:
            documents.append(rows)
            n, total = n + n_rows, total + chars
    if not documents:
        raise ValueError("no source has a row")
    rows = union_blocks(documents)
    read = rows.drop("domain", "block")
    if total >= limit:
        read = M.saturating_sizes(read, limit, source_ord="source_ord", row_ord="row_ord", size="weight", checked=F.col("checked"), rows=n)
    return rows.select("domain", "source", "row_key", "weight", "block"), read.filter(F.col("weight").isNotNull()).select("source", "row_key", "weight")


def _read_until_full(used: list[tuple[P.Recipe, Source]], limit: int, seed: int) -> DataFrame:
    blocks, sizes = read_until_full(used, limit)
    return M.char_budget(blocks.join(sizes.select("source", "row_key"), ["source", "row_key"], "left_semi"), limit, seed)


def source_report(name: str, frames: Mapping[str, Source | None], limit: int | None = None) -> DataFrame:
    """``(source, attempted, kept)``: rows a recipe counts and blocks that come of them, zeros included.

    The two differ, as cleaning can empty a counted row. Document sources are counted as far as they are read before the corpus is full.
    """
    corpus = CORPORA[name]
    used = [(r, frames[r.key]) for r in corpus.recipes if frames.get(r.key) is not None]
    zero = F.lit(0).cast("bigint")
    parts = []
    if corpus.saturating:
        _, sizes = read_until_full(used, corpus.budget if limit is None else limit)
        parts.append(sizes.groupBy("source").agg(F.count("*").alias("kept")).select("source", zero.alias("attempted"), "kept"))
    for r, source in used:
        df = whole(source)
        label = F.lit(r.key + ":" + r.source).alias("source")
        tried = P.chosen_rows(r, df).agg(F.count("*").alias("n"))
        parts.append(tried.select(label, F.col("n").alias("attempted"), zero.alias("kept")))
        if not corpus.saturating:
            kept = P.render(r, df).agg(F.count("weight").alias("n"))
            parts.append(kept.select(label, zero.alias("attempted"), "n"))
    both = union_blocks([p.toDF("source", "attempted", "kept") for p in parts])
    return both.groupBy("source").agg(F.sum("attempted").alias("attempted"), F.sum("kept").alias("kept"))
