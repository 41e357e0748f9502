"""Quality classifier: histogram gradient-boosted trees over document statistics.

The statistics of whole texts are vectorised over Arrow batches; trees are grown in numpy on binned values of a bounded,
labelled sample and flattened into arrays that a vectorised walk goes through.

Defined results: null and empty texts have the statistics of no bytes and are scored like any; without labelled rows
of both classes the score is the share of label 1 (0.5 without any); repeated rows are scored each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm.arrow import chunks, owners, word_bounds, word_hashes
from textmill.llm.sampling import bounded

SAMPLE_ROWS = 6_000  # per class
BINS, TREES, DEPTH, RATE, LAMBDA = 64, 60, 4, 0.2, 1.0

_CLASSES = ["lower", "upper", "digit", "space", "line", "stop", "mark", "bar", "sign", "quote", "slash", "control", "high"]
_CLASS = np.full(256, _CLASSES.index("control"), np.uint8)
for _name, _bytes in {
    "lower": b"abcdefghijklmnopqrstuvwxyz", "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789", "space": b" \t",
    "line": b"\n\r", "stop": b".,;:", "mark": b"!?", "bar": b"|", "sign": b"#$%&*@+=<>^~_", "quote": b"\"'`()[]{}-", "slash": b"/\\",
}.items():
    _CLASS[list(_bytes)] = _CLASSES.index(_name)
_CLASS[128:] = _CLASSES.index("high")
_LINE = np.zeros(256, bool)
_LINE[[10, 13]] = True

FEATURES = [
    "log_bytes", *(f"share_{x}" for x in _CLASSES), "word_length", "longest_word", "words_per_line", "upper_words", "signed_words",
    "distinct_words", "same_as_before", "distinct_triples", "distinct_lines", "top_line", "end_stop",
]


def _distinct(row: np.ndarray, value: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Number of distinct values per row, and the count of the most frequent."""
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    first = np.ones(len(row), bool)
    first[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    at = np.flatnonzero(first)
    counts = np.diff(np.append(at, len(row)))
    most = np.zeros(n)
    np.maximum.at(most, row[at], counts)
    return np.bincount(row[at], minlength=n).astype(float), most


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(texts, FEATURES) of whole texts."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    one = np.maximum(1, size)
    kind = _CLASS[data]
    row = np.repeat(np.arange(n), size)
    share = np.bincount(row * len(_CLASSES) + kind, minlength=n * len(_CLASSES)).reshape(n, -1) / one[:, None]
    starts, ends = word_bounds(data, offsets)
    word_row = owners(starts, offsets)
    words = np.bincount(word_row, minlength=n).astype(float)
    some = np.maximum(1, words)
    length = (ends - starts).astype(float)
    longest = np.zeros(n)
    np.maximum.at(longest, word_row, length)
    lines = np.bincount(row[kind == _CLASSES.index("line")], minlength=n) + 1.0
    upper = np.concatenate([[0], np.cumsum(kind == _CLASSES.index("upper"))])
    shouted = np.bincount(word_row, (upper[ends] - upper[starts]) * 2 > length, n) / some
    signed = np.bincount(word_row, np.isin(kind[ends - 1], [_CLASSES.index(x) for x in ("mark", "bar", "sign")]), n) / some
    hashed = word_hashes(data, starts, ends)
    distinct, _ = _distinct(word_row, hashed, n)
    again = np.zeros(n)
    triples = np.ones(n)
    if len(hashed) > 1:
        same = (hashed[1:] == hashed[:-1]) & (word_row[1:] == word_row[:-1])
        again = np.bincount(word_row[1:], same, n) / some
    if len(hashed) > 2:
        whole = word_row[2:] == word_row[:-2]
        three = (hashed[:-2] * np.uint64(3) + hashed[1:-1]) * np.uint64(5) + hashed[2:]
        kinds, _ = _distinct(word_row[2:][whole], three[whole], n)
        triples = np.where(words > 2, kinds / np.maximum(1, words - 2), 1)
    line_starts, line_ends = word_bounds(data, offsets, _LINE)
    line_row = owners(line_starts, offsets)
    full = np.maximum(1, np.bincount(line_row, minlength=n))
    line_kinds, top = _distinct(line_row, word_hashes(data, line_starts, line_ends), n)
    stopped = np.bincount(line_row, kind[line_ends - 1] == _CLASSES.index("stop"), n) / full
    return np.column_stack(
        [np.log1p(size), share, length_mean(word_row, length, n, some), longest, words / lines, shouted, signed, distinct / some, again, triples, line_kinds / full, top / full, stopped]
    )


def length_mean(row: np.ndarray, length: np.ndarray, n: int, some: np.ndarray) -> np.ndarray:
    return np.bincount(row, length, n) / some


class Forest:
    """Boosted trees as arrays: feature, threshold, left and right child (a leaf is its own child) and value of each node."""

    def __init__(self, base: float):
        self.base, self.roots = base, []
        self.feature, self.threshold, self.left, self.right, self.value = (np.zeros(0) for _ in range(5))

    def freeze(self, nodes: list[tuple], depth: int) -> Forest:
        self.depth = depth
        cols = list(zip(*nodes, strict=True)) if nodes else [()] * 5
        kinds = (np.int32, np.float64, np.int32, np.int32, np.float64)
        self.feature, self.threshold, self.left, self.right, self.value = (np.array(c, t) for c, t in zip(cols, kinds, strict=True))
        return self

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            for _ in range(self.depth):
                at = np.where(x[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
            out += self.value[at]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -60, 60)))


def grow(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE, bins: int = BINS) -> Forest:
    """Second-order boosting of the logistic loss; splits are the best of all histogram edges."""
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if len(y) else 0.5
    forest = Forest(float(np.log(share / (1 - share))))
    if len(y) == 0 or y.min() == y.max():
        return forest.freeze([], depth)
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)], 1)
    n_f, nodes = x.shape[1], []
    flat = binned + np.arange(n_f) * bins
    margin = np.full(len(y), forest.base)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, np.maximum(1e-6, p * (1 - p))
        forest.roots.append(len(nodes))
        nodes.append(None)
        todo = [(len(nodes) - 1, np.arange(len(y)), 0)]
        while todo:
            at, rows, level = todo.pop()
            gs, hs = g[rows].sum(), h[rows].sum()
            best = (1e-6, None, None)
            if level < depth and len(rows) >= 20:
                cells = flat[rows].ravel()
                hg = np.bincount(cells, np.repeat(g[rows], n_f), n_f * bins).reshape(n_f, bins).cumsum(1)
                hh = np.bincount(cells, np.repeat(h[rows], n_f), n_f * bins).reshape(n_f, bins).cumsum(1)
                gain = hg**2 / (hh + LAMBDA) + (gs - hg) ** 2 / (hs - hh + LAMBDA) - gs**2 / (hs + LAMBDA)
                gain[(hh < 1e-3) | (hs - hh < 1e-3)] = 0
                for f, e in enumerate(edges):  # the last bin has no edge
                    gain[f, len(e) :] = 0
                f, b = np.unravel_index(gain.argmax(), gain.shape)
                if gain[f, b] > best[0]:
                    best = (gain[f, b], int(f), int(b))
            if best[1] is None:
                value = -rate * gs / (hs + LAMBDA)
                nodes[at] = (0, 0.0, at, at, value)
                margin[rows] += value
                continue
            low = binned[rows, best[1]] <= best[2]
            left, right = len(nodes), len(nodes) + 1
            nodes += [None, None]
            nodes[at] = (best[1], float(edges[best[1]][best[2]]), left, right, 0.0)
            todo += [(left, rows[low], level + 1), (right, rows[~low], level + 1)]
    return forest.freeze(nodes, depth)


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, data, offsets in chunks(batches, "text"):
        x = statistics(data, offsets)
        yield pa.RecordBatch.from_arrays([pa.array(rows.column(0)), *map(pa.array, x.T)], names=["label", *FEATURES])


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", text: str = "text", key: str = "doc_id", sample_rows: int = SAMPLE_ROWS) -> Forest:
    """A forest from at most about ``sample_rows`` labelled rows per class; ``labels`` has (key, label)."""
    kept = labels.where(F.col(label).isNotNull()).select(F.col(key).alias("__key"), F.col(label).cast("double").alias("__label"))
    sample = F.broadcast(bounded(kept, "__label", "__key", sample_rows))  # its size is bounded
    own = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    rows = own.join(sample, F.col("key") == F.col("__key")).select(F.col("__label").alias("label"), "text")
    found = rows.mapInArrow(_measure, "label double, " + ", ".join(f"{x} double" for x in FEATURES)).toArrow()
    table = np.column_stack([c.to_numpy() for c in found.columns]) if found.num_rows else np.zeros((0, 1 + len(FEATURES)))
    table = table[np.lexsort(table.T)]  # the same forest whatever order the rows arrive in
    return grow(table[:, 1:], table[:, 0])


def predict(docs: DataFrame, forest: Forest, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, score) per row."""
    shared = docs.sparkSession.sparkContext.broadcast(forest)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in chunks(batches, "text"):
            s = shared.value.score(statistics(data, offsets))
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(s)], names=["key", "score"])

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(score, f"key {dict(docs.dtypes)[key]}, score double")
