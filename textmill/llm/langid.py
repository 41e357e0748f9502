"""Language identification by prediction by partial matching.

For each language a context tree of up to ORDER bytes is learned once and frozen: a symbol is coded in the longest context
seen, with probability n / (T + D); else an escape of probability D / (T + D) leads to the next shorter context, whose
symbols already ruled out are excluded (T occurrences, D distinct symbols left). The language with the shortest exact
code of the whole text wins.

A tree gives each (ORDER + 1)-gram one code length, so trees are compiled into a table of grams seen in training; grams
never seen are computed from the same trees. Scoring adds table rows, vectorised over Arrow batches.

Defined results: a null text and one without a letter are ``und`` with score 0; ties go to the language first by name;
rows that repeat are scored each; without training rows all are ``und``. The model is bounded: SAMPLE_BYTES of text per
language are learned from, whatever the size of the table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm.arrow import chunks
from textmill.llm.sampling import bounded

ORDER = 3
SAMPLE_BYTES = 2_000_000
MAX_MODEL_BYTES = 256 << 20
_PAD = 10  # the context before a text: line ends


def grams(data: np.ndarray, offsets: np.ndarray, order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """One (order + 1)-gram per byte, packed, and the n + 1 offsets; texts are padded in front."""
    n = len(offsets) - 1
    padded = np.full(len(data) + order * n, _PAD, np.uint8)
    lengths = np.diff(offsets)
    place = np.arange(len(data)) + order * (np.repeat(np.arange(n), lengths) + 1)
    padded[place] = data
    packed = np.zeros(len(data), np.uint32)
    for k in range(order, -1, -1):
        packed = (packed << np.uint32(8)) | padded[place - k]
    return packed, offsets


class Tree:
    """The frozen context tree of one language."""

    def __init__(self, packed: np.ndarray, counts: np.ndarray, order: int = ORDER):
        self.order, self.levels = order, []
        for k in range(order + 1):
            mask = np.uint64((1 << (8 * (k + 1))) - 1)
            keys, inverse = np.unique(packed.astype(np.uint64) & mask, return_inverse=True)
            n = np.bincount(inverse, counts, len(keys))
            contexts, of = np.unique(keys >> np.uint64(8), return_inverse=True)
            total, distinct = np.bincount(of, n), np.bincount(of).astype(float)
            if k:  # occurrences, one context shorter, of the symbols seen here
                below = self.levels[k - 1]
                n_below = below["n"][np.searchsorted(below["keys"], keys & np.uint64((1 << (8 * k)) - 1))]
                ruled_out = np.bincount(of, n_below)
            else:
                ruled_out = np.zeros(len(contexts))
            self.levels.append({"keys": keys, "n": n, "contexts": contexts, "total": total, "distinct": distinct, "ruled_out": ruled_out})

    def bits(self, packed: np.ndarray) -> np.ndarray:
        """Exact code length of the last symbol of each gram after the bytes before it."""
        packed = packed.astype(np.uint64)
        cost = np.zeros(len(packed))
        open_ = np.ones(len(packed), bool)
        out_t, out_d = np.zeros(len(packed)), np.zeros(len(packed))
        for k in range(self.order, -1, -1):
            level = self.levels[k]
            key = packed & np.uint64((1 << (8 * (k + 1))) - 1)
            at, seen = _find(level["keys"], key)
            c, there = _find(level["contexts"], key >> np.uint64(8))
            t = np.where(there, level["total"][c] - out_t, 0)
            d = np.where(there, level["distinct"][c] - out_d, 0)
            hit = open_ & seen
            cost[hit] -= np.log2(level["n"][at[hit]] / (t[hit] + d[hit]))
            open_ &= ~seen
            escape = open_ & (d > 0)
            cost[escape] -= np.log2(d[escape] / (t[escape] + d[escape]))
            out_t = np.where(there, level["ruled_out"][c], 0)
            out_d = np.where(there, level["distinct"][c], 0)
        cost[open_] += np.log2(256 - len(self.levels[0]["keys"])) if open_.any() else 0
        return cost


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


class Model:
    """Trees of all languages, compiled to one row of code lengths per gram seen."""

    def __init__(self, counts: dict[str, tuple[np.ndarray, np.ndarray]], order: int = ORDER):
        self.order, self.langs = order, sorted(counts)
        self.trees = [Tree(*counts[x], order) for x in self.langs]
        self.seen = np.unique(np.concatenate([counts[x][0] for x in self.langs])) if self.langs else np.zeros(0, np.uint32)
        self.table = np.stack([t.bits(self.seen) for t in self.trees]).astype(np.float32) if self.langs else None
        # One probe of a sparse hash table finds most grams; the rest are looked up by bisection.
        self.shift = np.uint32(32 - max(12, int(np.ceil(np.log2(8 * len(self.seen) + 1)))))
        slots = self._slot(self.seen)
        self.slots = np.full(1 << (32 - int(self.shift)), -1, np.int32)
        self.slots[slots] = np.arange(len(self.seen))

    def _slot(self, packed: np.ndarray) -> np.ndarray:
        return (packed * np.uint32(2654435769)) >> self.shift

    def nbytes(self) -> int:
        trees = sum(a.nbytes for t in self.trees for level in t.levels for a in level.values())
        return trees + self.slots.nbytes + (self.table.nbytes if self.langs else 0)

    def bits(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Code length of each text in each language, (texts, languages)."""
        packed, _ = grams(data, offsets, self.order)
        out = np.zeros((len(offsets) - 1, len(self.langs)))
        if not len(packed):
            return out
        at = self.slots[self._slot(packed)]
        missed = np.flatnonzero((at < 0) | (self.seen[at] != packed))
        other, inverse = np.unique(packed[missed], return_inverse=True)
        where, known = _find(self.seen, other)
        new = other[~known]
        where[~known] = len(self.seen) + np.arange(len(new))
        at[missed] = where[inverse]
        full = np.flatnonzero(np.diff(offsets))
        for i, tree in enumerate(self.trees):
            lengths = np.concatenate([self.table[i], tree.bits(new).astype(np.float32)]) if len(new) else self.table[i]
            out[full, i] = np.add.reduceat(lengths[at], offsets[full], dtype=np.float64)
        return out


def _counter(order: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in chunks(batches, "text"):
            packed, _ = grams(data, offsets, order)
            langs, index = np.unique(np.asarray(rows.column(0).to_pylist(), object), return_inverse=True)
            of = np.repeat(index, np.diff(offsets)).astype(np.uint64)
            keys, n = np.unique((of << np.uint64(32)) | packed, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(langs[(keys >> np.uint64(32)).astype(int)], pa.string()), pa.array((keys & np.uint64(0xFFFFFFFF)).astype(np.int64)), pa.array(n.astype(np.int64))],
                names=["lang", "gram", "n"],
            )

    return count


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", sample_bytes: int = SAMPLE_BYTES, order: int = ORDER) -> Model:
    """The model of the rows given, from about ``sample_bytes`` of whole texts per language, counted in Spark."""
    rows = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    rows = rows.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"), F.col(key).alias("key"))
    sample = bounded(rows, "lang", "key", sample_bytes, F.octet_length("text")).select("lang", "text")
    counted = sample.mapInArrow(_counter(order), "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    found = counted.toArrow()
    name, gram, n = found.column(0), found.column(1).to_numpy().astype(np.uint32), found.column(2).to_numpy().astype(float)
    counts = {}
    for x in pc.unique(name).to_pylist():
        own = pc.equal(name, x).to_numpy()
        counts[x] = (gram[own], n[own])
    return Model(counts, order)


def predict(docs: DataFrame, model: Model, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, lang_pred, score, bits_per_byte) per row; score is the posterior of the language under equal priors."""
    if model.nbytes() > MAX_MODEL_BYTES:
        raise ValueError("the model is larger than is sent to every executor: lower sample_bytes or the order")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        names = np.array([*model.langs, "und"], object)
        for rows, data, offsets in chunks(batches, "text"):
            spoken = pc.fill_null(pc.match_substring_regex(rows.column(1), r"\p{L}"), False).to_numpy(zero_copy_only=False)
            best = np.full(rows.num_rows, len(model.langs))
            sure, rate = np.zeros(rows.num_rows), np.zeros(rows.num_rows)
            if model.langs:
                bits = model.bits(data, offsets)
                top = bits.argmin(1)
                shortest = bits.min(1)
                best = np.where(spoken, top, best)
                sure = np.where(spoken, 1 / np.exp2(-np.minimum(bits - shortest[:, None], 1000)).sum(1), 0)
                rate = np.where(spoken, shortest / np.maximum(1, np.diff(offsets)), 0)
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array(names[best], pa.string()), pa.array(sure), pa.array(rate)], names=["key", "lang_pred", "score", "bits_per_byte"]
            )

    kind = dict(docs.dtypes)[key]
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(score, f"key {kind}, lang_pred string, score double, bits_per_byte double")
