"""Source divergence audit: how the term frequencies of each source of a language differ from the other sources' and the language's.

One Arrow pass counts each batch's terms, so that a term reaches the shuffle once per batch, source and language. A term is a run of ASCII
letters and characters beyond ASCII; only A-Z are lower-cased. A language keeps the terms that stand in MIN_DOCS of its documents.
The smoothed frequency of a term is an integer, 1 + floor(SCALE * (count + ALPHA) / (N + ALPHA * V)), in exact decimal arithmetic.

* Terms of a group (language and source) are ranked by count cells. Terms with the same count in the group and in the language share
  all that their value depends on, so the value is worked out once per cell; cells are merged by value and ranked by cumulative
  multiplicity, which tells the values that hold the first TOP_TERMS ranks. Only terms of these values are expanded, in UTF-8 order.
* Pairs of sources are compared in blocks: terms are dealt to buckets, sources of a language to tiles, and a block of a bucket and two tiles is
  a dense matrix of frequencies with as many sums as pairs. So no pair is ever a row per term, and no block grows with the data.

Defined results: null text, language and source read as empty; repeated rows count each; every group that occurs is reported, without
terms too (its pairs have value 0 where the language keeps no term); an empty table gives none. One text is held in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textmill.llm.arrow import chunks, owners, word_bounds
from textmill.session import cut_lineage

MIN_DOCS, ALPHA, SCALE, TOP_TERMS = 30, 5, 1_000_000_000, 50
TILE = 256  # sources
BLOCK_CELLS = 1 << 15  # terms times sources of a block
_CHUNK = 1 << 23

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_OUTSIDE = np.ones(256, bool)  # bytes of no term
_OUTSIDE[65:91] = _OUTSIDE[97:123] = _OUTSIDE[128:] = False


def term_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, term, n, docs): occurrences, and documents with the term; a row with an empty term for each group that occurs."""
    blank = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name) for c, name in ((lang, "lang"), (source, "source"))]
    schema = "lang string, source string, term string, n long, docs long"
    counted = docs.select(*blank, F.col(text).alias("text")).mapInArrow(_count, schema)
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, data, offsets in chunks(batches, "text", _CHUNK):
        group = pa.StructArray.from_arrays([rows.column(0), rows.column(1)], names=["lang", "source"])
        # A group's number is that of its first row here.
        pairs = pc.binary_join_element_wise(pc.cast(pc.binary_length(rows.column(0)), pa.string()), rows.column(0), rows.column(1), " ")
        coded = pairs.dictionary_encode()
        of_row = np.asarray(coded.indices).astype(np.int64)
        _, head = np.unique(of_row, return_index=True)
        starts, ends = word_bounds(data, offsets, _OUTSIDE)
        size = ends - starts
        inside = _LOWER[data[~_OUTSIDE[data]]]
        bounds = np.concatenate([[0], np.cumsum(size)])
        terms = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(bounds), pa.py_buffer(inside)).dictionary_encode()
        n_terms = max(1, len(terms.dictionary))
        # (row, term), then (group, term).
        by_row, n = np.unique(owners(starts, offsets) * n_terms + np.asarray(terms.indices), return_counts=True)
        key, at, n_docs = np.unique(of_row[by_row // n_terms] * n_terms + by_row % n_terms, return_inverse=True, return_counts=True)
        total = np.bincount(at, weights=n, minlength=len(key)).astype(np.int64)
        first = head[np.concatenate([key // n_terms, np.arange(len(head))])]
        term = pa.concat_arrays([terms.dictionary.take(pa.array(key % n_terms)).cast(pa.string()), pa.array([""] * len(head), pa.string())])
        none = np.zeros(len(head), np.int64)
        cols = [group.field(0).take(pa.array(first)), group.field(1).take(pa.array(first)), term, np.concatenate([total, none]), np.concatenate([n_docs, none])]
        yield from pa.Table.from_arrays([pa.array(c) if isinstance(c, np.ndarray) else c for c in cols], names=["lang", "source", "term", "n", "docs"]).to_batches(1 << 16)


def frequency(count: Column, total: Column, kept: Column, alpha: int, scale: int) -> Column:
    """1 + floor(scale * (count + alpha) / (total + alpha * kept)), exactly, for numbers of 19 digits."""
    wide = "decimal(19,0)"
    return F.call_function("div", F.lit(scale).cast(wide) * (count + alpha).cast(wide), (total + alpha * kept).cast(wide)) + 1


class Audit:
    """Counts of the kept terms and the groups, written once and read by both parts."""

    def __init__(self, docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", min_docs: int = MIN_DOCS, alpha: int = ALPHA, scale: int = SCALE):
        self.alpha, self.scale = alpha, scale
        counted = cut_lineage(term_counts(docs, text, lang, source))
        over = W.partitionBy("lang", "term")
        known = counted.where("term <> ''").select("lang", "source", "term", "n", F.sum("n").over(over).alias("lang_n"), F.sum("docs").over(over).alias("lang_docs"))
        self.kept = cut_lineage(known.where(F.col("lang_docs") >= min_docs).drop("lang_docs"))
        sums = self.kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
        langs = self.kept.groupBy("lang", "term").agg(F.first("lang_n").alias("n")).groupBy("lang").agg(F.sum("n").alias("lang_total"), F.count("*").alias("n_kept"))
        groups = counted.where("term = ''").select("lang", "source").join(sums, ["lang", "source"], "left").join(langs, "lang", "left")
        groups = groups.fillna(0, ["total", "lang_total", "n_kept"])
        # One row a group: small, and its written size is what Spark's own rule for broadcasts goes by.
        numbered = groups.withColumn("number", F.row_number().over(W.partitionBy("lang").orderBy("source")) - 1)
        self.groups = cut_lineage(numbered.withColumn("n_sources", F.count("*").over(W.partitionBy("lang"))))

    def _frequency(self, count: Column, total: str = "total") -> Column:
        return frequency(count, F.col(total), F.col("n_kept"), self.alpha, self.scale)

    def terms(self, top: int = TOP_TERMS) -> DataFrame:
        """(lang, source, item, value, rank): terms more frequent in the group than in the language."""
        cells = self.kept.groupBy("lang", "source", "n", "lang_n").agg(F.count("*").alias("size")).join(self.groups, ["lang", "source"])
        cells = cells.select("lang", "source", "n", "lang_n", "size", (self._frequency(F.col("n")) - self._frequency(F.col("lang_n"), "lang_total")).alias("value"))
        cells = cut_lineage(cells.where("value > 0"))
        falling = W.partitionBy("lang", "source").orderBy(F.desc("value"))
        # Each value has a term at least, so the first ranks lie among as many values.
        values = cells.groupBy("lang", "source", "value").agg(F.sum("size").alias("size"))
        values = values.withColumn("place", F.row_number().over(falling)).where(F.col("place") <= top)
        before = F.sum("size").over(falling.rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("size")
        values = cut_lineage(values.withColumn("before", before).where(F.col("before") < top).select("lang", "source", "value", "before"))
        chosen = cells.join(values, ["lang", "source", "value"]).select("lang", "source", "n", "lang_n", "value", "before")
        found = self.kept.join(cut_lineage(chosen), ["lang", "source", "n", "lang_n"])
        rank = F.row_number().over(W.partitionBy("lang", "source").orderBy(F.desc("value"), "term"))
        return found.select("lang", "source", F.col("term").alias("item"), "value", rank.alias("rank")).where(F.col("rank") <= top)

    def pairs(self, tile: int = TILE, block_cells: int = BLOCK_CELLS) -> DataFrame:
        """(lang, source, item, value, rank): every other source of the language, by the sum of differences over all kept terms."""
        wide = F.least(F.col("n_sources"), F.lit(2 * tile))
        per_block = F.greatest(F.lit(1), F.floor(F.lit(block_cells) / wide))
        groups = self.groups.select(
            "lang", "source", "number", F.floor(F.col("number") / tile).alias("tile"), F.floor((F.col("n_sources") - 1) / tile).alias("last"),
            F.greatest(F.lit(1), F.ceil(F.col("n_kept") / per_block)).alias("buckets"), "total", "n_kept", self._frequency(F.lit(0)).alias("base"),
        )
        groups = groups.withColumn("base", F.when(F.col("n_kept") > 0, F.col("base")).otherwise(0))
        # Blocks a tile is in: with each tile, the lower one first.
        other = F.explode(F.sequence(F.lit(0), F.col("last"))).alias("other")

        def placed(df: DataFrame) -> DataFrame:
            df = df.select("*", other)
            return df.withColumns({"low": F.least("tile", "other"), "high": F.greatest("tile", "other")}).drop("tile", "other", "last")

        head = groups.select("lang", "number", "tile", "last", F.explode(F.sequence(F.lit(0), F.col("buckets") - 1)).alias("bucket"), F.lit(None).cast("string").alias("term"), F.col("base").alias("p"))
        terms = self.kept.join(groups, ["lang", "source"]).select(
            "lang", "number", "tile", "last", F.pmod(F.xxhash64("term"), F.col("buckets")).alias("bucket"), "term", self._frequency(F.col("n")).alias("p")
        )
        blocks = placed(head).unionByName(placed(terms)).groupBy("lang", "low", "high", "bucket")
        sums = blocks.applyInArrow(_compare(tile), "lang string, a long, b long, value long, n_seen long").groupBy("lang", "a", "b").agg(F.sum("value").alias("value"), F.sum("n_seen").alias("n_seen"))
        one = groups.select("lang", F.col("number").alias("a"), "source", F.col("base").alias("base_a"), "n_kept")
        two = groups.select("lang", F.col("number").alias("b"), F.col("source").alias("item"), F.col("base").alias("base_b"))
        # Terms that no source of a block has stand in none of its rows; there both sources are at their base.
        unseen = (F.col("n_kept") - F.col("n_seen")) * F.abs(F.col("base_a") - F.col("base_b"))
        found = sums.join(one, ["lang", "a"]).join(two, ["lang", "b"]).withColumn("value", F.col("value") + unseen)
        rank = F.row_number().over(W.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
        return found.select("lang", "source", "item", "value", rank.alias("rank"))


def _compare(tile: int):
    def run(block: pa.Table) -> pa.Table:
        block = block.combine_chunks()
        number, p = (block[c].to_numpy().astype(np.int64) for c in ("number", "p"))
        head = block["term"].is_null().to_numpy(zero_copy_only=False)
        sources, first = np.unique(number[head], return_index=True)
        coded = block["term"].combine_chunks().filter(pa.array(~head)).dictionary_encode()
        # What a source does not have, it has at its base.
        dense = np.repeat(p[head][first][:, None], len(coded.dictionary), axis=1)
        dense[np.searchsorted(sources, number[~head]), np.asarray(coded.indices)] = p[~head]
        low, high = block["low"][0].as_py(), block["high"][0].as_py()
        left, right = (np.flatnonzero(sources // tile == t) for t in (low, high))
        other = dense[right]
        sums = [np.abs(other - dense[a]).sum(axis=1) for a in left]
        a, b = np.repeat(sources[left], len(right)), np.tile(sources[right], len(left))
        value = np.concatenate(sums) if sums else np.zeros(0, np.int64)
        if low != high:
            a, b, value = np.concatenate([a, b]), np.concatenate([b, a]), np.concatenate([value, value])
        kept = a != b
        lang = pa.array([block["lang"][0].as_py()] * int(kept.sum()), pa.string())
        n_seen = np.full(int(kept.sum()), dense.shape[1], np.int64)
        return pa.table({"lang": lang, "a": a[kept], "b": b[kept], "value": value[kept], "n_seen": n_seen})

    return run


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", top: int = TOP_TERMS, min_docs: int = MIN_DOCS, alpha: int = ALPHA, scale: int = SCALE) -> DataFrame:
    """(lang, source, part, item, value, rank): both parts of the audit."""
    found = Audit(docs, text, lang, source, min_docs, alpha, scale)

    def part(rows: DataFrame, name: str) -> DataFrame:
        return rows.select("lang", "source", F.lit(name).alias("part"), "item", "value", "rank")

    return part(found.pairs(), "pair").unionByName(part(found.terms(top), "term"))
