"""Links between texts that share a hash key, verified by exact Jaccard likeness, and the classes they form.

A text has an array of keys, one for each table of an index (bands, tries). Texts of one key form a group; a group is cut
into blocks, and each pair of blocks is the work of one task, however large the group. A pair that shares several keys is
verified at the first alone. Out comes one row per text and block pair - how many links, and a root in the local
forest of links - never one row per pair. Roots are joined to classes by alternating stars.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm.arrow import chunks, shingles
from textmill.session import cut_lineage

BLOCK = 1024  # texts of a block
BLOCK_SHINGLES = 1 << 21  # and shingles of a block

_GROUP = ["slot", "hash", "low", "high"]
_PLACED = "slot int, hash long, low long, high long, id long, block long, n_copies long, keys array<long>"

Keys = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows of one group after the other, from rows sorted by group; groups may span batches."""
    rest: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        cols = [b.column(b.schema.get_field_index(x)).to_numpy() for x in _GROUP]
        new = np.zeros(b.num_rows, bool)
        for c in cols:
            new[1:] |= c[1:] != c[:-1]
        last = [rest[-1].column(rest[-1].schema.get_field_index(x))[-1].as_py() for x in _GROUP] if rest else None
        new[0] = last is not None and last != [c[0].item() for c in cols]
        at = 0
        for cut in [*np.flatnonzero(new).tolist(), b.num_rows]:
            if cut > at:
                rest.append(b.slice(at, cut - at))
            if cut < b.num_rows:
                yield pa.Table.from_batches(rest)
                rest, at = [], cut
    if rest:
        yield pa.Table.from_batches(rest)


def _column(group: pa.Table, name: str) -> np.ndarray:
    return group.column(name).to_numpy()


def _keys(group: pa.Table) -> np.ndarray:
    values = group.column("keys").combine_chunks()
    return values.flatten().to_numpy().reshape(group.num_rows, -1)


def _fresh(keys: np.ndarray, slot: int, one: int, others: np.ndarray) -> np.ndarray:
    """Which others share no earlier key with the text ``one``."""
    return ~(keys[others, :slot] == keys[one, :slot]).any(1) if slot else np.ones(len(others), bool)


def _partners(group: pa.Table) -> Iterator[tuple[int, np.ndarray]]:
    """Each text with the texts after it that this group is the first to pair it with, across blocks or within one."""
    slot, low, high = (group.column(x)[0].as_py() for x in ("slot", "low", "high"))
    block, keys = _column(group, "block"), _keys(group)
    n = group.num_rows
    left = np.flatnonzero(block == low)
    right = np.flatnonzero(block == high)
    for i in left.tolist():
        others = right if low != high else np.arange(i + 1, n)
        others = others[_fresh(keys, slot, i, others)]
        if len(others):
            yield i, others


def _needed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of texts with a partner in their group: only these need their shingles."""
    for group in _groups(batches):
        if group.num_rows == 1:
            continue
        kept = np.zeros(group.num_rows, bool)
        for i, others in _partners(group):
            kept[i] = True
            kept[others] = True
        yield from group.filter(pa.array(kept)).combine_chunks().to_batches()


def _verify(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[np.ndarray, ...]] = []
        size = 0
        for group in _groups(batches):
            out.append(_verified(group, threshold))
            size += group.num_rows
            if size > 4096:
                yield _links_batch(out)
                out, size = [], 0
        if out:
            yield _links_batch(out)

    return run


def _links_batch(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*parts, strict=True)], names=["id", "n_links", "n_docs", "root"])


def _verified(group: pa.Table, threshold: float) -> tuple[np.ndarray, ...]:
    """(id, links, documents linked, local root) of the texts of a group that have a link."""
    ids, copies = _column(group, "id"), _column(group, "n_copies")
    sets = [np.frombuffer(x, np.uint64) for x in group.column("shingles").to_pylist()]
    size = np.array([len(s) for s in sets])
    at = np.concatenate([[0], np.cumsum(size)])
    values, local = np.unique(np.concatenate(sets), return_inverse=True)
    local = local.astype(np.int32)
    here = np.zeros(len(values), np.int32)
    root = np.arange(len(ids))
    links, docs = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
    ends = np.arange(len(ids))
    for i, others in _partners(group):
        # A likeness of the threshold needs sizes in that ratio.
        others = others[(np.minimum(size[i], size[others]) >= threshold * np.maximum(size[i], size[others])) & (size[others] > 0)]
        if not len(others):
            continue
        own = local[at[i] : at[i + 1]]
        here[own] = 1
        if len(others) * 4 > len(ids):
            both = np.add.reduceat(here[local], at[:-1][size > 0])[np.searchsorted(ends[size > 0], others)]
        else:
            both = np.array([here[local[at[j] : at[j + 1]]].sum() for j in others.tolist()])
        here[own] = 0
        # both / (size_i + size_j - both) >= threshold, without rounding trouble at equality
        linked = others[both * (1 + threshold) >= threshold * (size[i] + size[others]) - 1e-9]
        if not len(linked):
            continue
        links[i] += len(linked)
        docs[i] += copies[linked].sum()
        links[linked] += 1
        docs[linked] += copies[i]
        tops = np.unique(root[np.append(linked, i)])
        root[np.isin(root, tops)] = tops[ids[tops].argmin()]
    with_link = links > 0
    return ids[with_link], links[with_link], docs[with_link], ids[root[with_link]]


def _keyed(keys: Keys):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in chunks(batches, "text"):
            found, n = keys(data, offsets)
            some = np.flatnonzero(n)
            flat_keys = pa.ListArray.from_arrays(pa.array(np.arange(len(some) + 1, dtype=np.int32) * found.shape[1]), pa.array(found[some].ravel()))
            yield pa.RecordBatch.from_arrays(
                [rows.column(0).take(pa.array(some)), rows.column(1).take(pa.array(some)), pa.array(n[some].astype(np.int64)), flat_keys],
                names=["id", "n_copies", "n", "keys"],
            )

    return run


def _shingled(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in chunks(batches, "text"):
            hashed, at = shingles(data, offsets, size)
            sets = [np.unique(hashed[a:b]).tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(sets, pa.binary())], names=["id", "shingles"])

    return run


def link(texts: DataFrame, keys: Keys, threshold: float, size: int) -> DataFrame:
    """(id, n_links, n_docs, root): partial counts of verified links, to be summed by id, and edges id - root.

    ``texts`` has (id, n_copies, text) with unique ids; ``keys`` gives the keys of a flat array of texts and their
    numbers of shingles. Texts are read once for the keys and once, those with a partner, for their shingles.
    """
    known = cut_lineage(texts.mapInArrow(_keyed(keys), "id long, n_copies long, n long, keys array<long>"))
    member = known.select("id", "n", F.posexplode("keys").alias("slot", "hash"))
    groups = member.groupBy("slot", "hash").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("s")).where("c > 1")
    blocks = F.greatest(F.ceil(F.col("c") / BLOCK), F.ceil(F.col("s") / BLOCK_SHINGLES))
    dealt = member.drop("n").join(groups.select("slot", "hash", blocks.alias("blocks")), ["slot", "hash"])
    block = F.pmod(F.xxhash64("id"), F.col("blocks"))
    paired = dealt.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    paired = paired.select("slot", "hash", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "id", "block")
    placed = paired.join(known.select("id", "n_copies", "keys"), "id").select("slot", "hash", "low", "high", "id", "block", "n_copies", "keys")
    needed = placed.repartition(*_GROUP).sortWithinPartitions(*_GROUP, "id").mapInArrow(_needed, _PLACED)
    needed = cut_lineage(needed)
    wanted = texts.join(needed.select("id").distinct(), "id", "left_semi").select("id", "text")
    sets = wanted.mapInArrow(_shingled(size), "id long, shingles binary")
    full = needed.join(sets, "id").repartition(*_GROUP).sortWithinPartitions(*_GROUP, "id")
    return cut_lineage(full.mapInArrow(_verify(threshold), "id long, n_links long, n_docs long, root long"))


def components(edges: DataFrame) -> DataFrame:
    """(id, top): the smallest id each id is connected to, for ids that have an edge (id, root).

    Alternating large and small stars; each round is a written table, and rounds end when a round changes nothing.
    """
    edges = cut_lineage(edges.where("id <> root").select(F.col("id").alias("u"), F.col("root").alias("v")).distinct())
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = large.where("u <> v")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        edges = cut_lineage(small.where("u <> v").distinct())
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("top"))
        before = state


def classes(docs: DataFrame, linked: Callable[[DataFrame], DataFrame], text: str, key: str) -> DataFrame:
    """One row per document: (key, class_id, copy_of, n_copies, n_links, n_link_docs).

    ``copy_of`` is the smallest key with the same text (null and empty are the same), ``n_copies`` how many have it, ``class_id``
    the smallest key of all texts connected by links, ``n_links`` how many different texts are linked to this one and ``n_link_docs``
    how many documents have those texts. A key that repeats with other texts is linked by the smallest. Rows with a null key are left out of classes: they are a class of their own
    each, with null numbers. Copies are told by a digest of the text, so that none is gathered anywhere.
    """
    rows = docs.select(F.col(key).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    known = rows.where("id IS NOT NULL").withColumn("digest", F.unhex(F.md5("text")))
    copies = known.groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n_copies"))
    member = cut_lineage(known.select("id", "digest").join(copies, "digest").select("id", "first", "n_copies"))
    first = member.where("id = first").select("id", "n_copies").distinct()
    texts = known.select("id", "text").join(first, "id").select("id", "n_copies", "text")
    again = cut_lineage(member.where("id = first").groupBy("id").count().where("count > 1").select("id"))
    if not again.isEmpty():  # rows that repeat a key: the smallest text stands for it
        one = texts.join(again, "id").groupBy("id").agg(F.max("n_copies").alias("n_copies"), F.min("text").alias("text"))
        texts = texts.join(again, "id", "left_anti").unionByName(one)
    found = linked(texts)
    counts = found.groupBy("id").agg(F.sum("n_links").alias("n_links"), F.sum("n_docs").alias("n_link_docs"))
    facts = counts.join(components(found.select("id", "root")), "id", "left").select(F.col("id").alias("first"), "n_links", "n_link_docs", F.coalesce("top", "id").alias("class_id"))
    out = member.join(facts, "first", "left").select(
        F.col("id").alias("key"), F.coalesce("class_id", "first").alias("class_id"), F.col("first").alias("copy_of"), "n_copies",
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), F.coalesce("n_link_docs", F.lit(0).cast("long")).alias("n_link_docs"),
    )
    nothing = F.lit(None).cast("long")
    nulls = rows.where("id IS NULL").select(F.col("id").alias("key"), *(nothing.alias(c) for c in out.columns[1:]))
    return out.unionByName(nulls)
