"""Toxicity: bags of subword embeddings, averaged into a linear softmax, trained jointly in numpy.

Words are lower-cased (ASCII) runs of letters, digits and non-ASCII bytes, with a mark on either side. Every character n-gram
of MIN_N to MAX_N bytes inside a marked word has an embedding in a hashed table, so that a misspelling never seen
shares most vectors with the word. Windows of WINDOW words slide over a text by half their length; each window's embeddings are averaged into the
softmax, and a text is as toxic as its worst window, so that length dilutes nothing. Training starts on
random windows of labelled texts and goes on with the worst. FOLDS models each leave a part of the rows out; where those left out are told apart
best is the score THRESHOLD, at every number of rows, and the model is the mean of the folds' models.

Once trained, embeddings and softmax collapse to one number per n-gram, so that scoring is one lookup per n-gram.

Defined results: a text without an n-gram (null, empty, only marks) has the score of the bias alone; without training rows of
both classes the score is the share of label 1 (0.5 without any); with one row of a class nothing can be left out, and the
score is the model's own; repeated rows are scored each. At most about
SAMPLE_ROWS labelled rows per class are learned from.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm.arrow import chunks, flat, mix64, word_hashes
from textmill.llm.sampling import bounded

SAMPLE_ROWS = 2_000  # per class
MIN_N, MAX_N, BITS, DIM, WINDOW, FLOOR = 3, 6, 18, 8, 24, 336
SHIFTS = (0, WINDOW // 2)
EPOCHS, RANDOM_EPOCHS, BATCH, LEARN, DECAY = 14, 3, 128, 0.5, 1e-6
STEPS = 280  # of training, at least
THRESHOLD, FOLDS, FALSE_ALARM = 0.7, 3, 8  # a false alarm weighs as much as 8 misses

_FOLD = np.full(256, 32, np.uint8)  # byte to lower-case letter, digit, high byte, or the mark 32
for _b in range(256):
    if _b >= 128 or chr(_b).isalnum():
        _FOLD[_b] = ord(chr(_b).lower()) if _b < 128 else _b


def marked(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Folded bytes with a mark before each text and after the last, and the n + 1 offsets of texts after their marks."""
    n = len(offsets) - 1
    out = np.full(len(data) + n + 1, 32, np.uint8)
    out[np.arange(len(data)) + np.repeat(np.arange(1, n + 1), np.diff(offsets))] = _FOLD[data]
    return out, offsets + np.arange(1, n + 2)


def ngrams(folded: np.ndarray, kept: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length: bucket of the n-gram at each position, and whether it lies inside one marked word that counts."""
    mark = np.concatenate([[0], np.cumsum(folded == 32, dtype=np.int32)])
    hashed = np.zeros(len(folded), np.uint32)
    for n in range(1, MAX_N + 1):
        if len(folded) < n:
            return
        hashed = hashed[: len(folded) - n + 1] * np.uint32(0x01000193) + folded[n - 1 :] + np.uint32(1)
        if n >= MIN_N:
            inner = (mark[n - 1 : n - 1 + len(hashed)] == mark[1 : 1 + len(hashed)]) & kept[: len(hashed)]
            bucket = (hashed ^ (hashed >> np.uint32(15))) * np.uint32(0x85EBCA6B) >> np.uint32(32 - BITS)
            yield bucket, inner


def windows(folded: np.ndarray, offsets: np.ndarray, shift: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Position of the first byte of each window, the text it belongs to, and which bytes start n-grams that count.

    Every text has a window; with a ``shift`` the first is so many words shorter. A window starts at the mark before its first word, so that the n-grams of a word lie in one.
    """
    begin = offsets[:-1] - 1
    word = np.flatnonzero((folded[:-1] == 32) & (folded[1:] != 32))
    ends = np.flatnonzero((folded[:-1] != 32) & (folded[1:] == 32)) + 1
    texts = np.searchsorted(begin, word, "right") - 1
    rank = np.arange(len(word)) - np.searchsorted(word, begin)[texts] if len(word) else word
    inner = ((rank + shift) % WINDOW == 0) & (rank > 0)
    starts = np.concatenate([begin, word[inner]])
    order = np.argsort(starts, kind="stable")
    starts, of = starts[order], np.concatenate([np.arange(len(begin)), texts[inner]])[order]
    own = np.searchsorted(starts, word, "right").astype(np.uint64)
    _, first = np.unique(word_hashes(folded, word + 1, ends) ^ mix64(own), return_index=True)
    step = np.zeros(len(folded) + 1, np.int8)
    step[word[first]] += 1
    step[ends[first]] -= 1
    return starts, of, np.cumsum(step[:-1], dtype=np.int8) > 0


class Model:
    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights.astype(np.float32), bias

    def odds(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log-odds of each window, and the text it belongs to."""
        folded, at = marked(data, offsets)
        total, number = np.zeros(len(folded), np.float32), np.zeros(len(folded), np.int32)
        for bucket, inner in ngrams(folded, np.ones(len(folded), bool)):
            total[: len(bucket)] += self.weights[bucket] * inner
            number[: len(bucket)] += inner
        odds, of = [], []
        for shift in SHIFTS:
            starts, texts, kept = windows(folded, at, shift)
            odds.append(self.bias + _sums(total * kept, starts) / np.maximum(FLOOR, _sums(number * kept, starts)))
            of.append(texts)
        texts = np.concatenate(of)
        order = np.argsort(texts, kind="stable")
        return np.concatenate(odds)[order], texts[order]

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        odds, texts = self.odds(data, offsets)
        worst = np.maximum.reduceat(odds, np.searchsorted(texts, np.arange(len(offsets) - 1))) if len(offsets) > 1 else np.zeros(0)
        return 1 / (1 + np.exp(-np.clip(worst, -60, 60)))


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, starts, dtype=np.float64) if len(starts) else np.zeros(0)


class _Bags:
    """The n-grams of all windows of the training texts, in parts of some texts each."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.parts, texts, part_of, within = [], [], [], []
        for lo in range(0, len(offsets) - 1, 64):
            hi = min(lo + 64, len(offsets) - 1)
            folded, own = marked(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
            for shift in SHIFTS:
                starts, text, kept = windows(folded, own, shift)
                found = [(np.flatnonzero(inner).astype(np.int32), bucket[inner].astype(np.int32)) for bucket, inner in ngrams(folded, kept)]
                place = np.concatenate([p for p, _ in found] or [np.zeros(0, np.int32)])
                order = np.argsort(place, kind="stable")
                bucket = np.concatenate([b for _, b in found] or [place])[order]
                bounds = np.searchsorted(place[order], np.append(starts, len(folded)))
                self.parts.append((bucket, bounds))
                texts.append(text + lo)
                part_of.append(np.full(len(text), len(self.parts) - 1))
                within.append(np.arange(len(text)))
        self.texts, self.part_of, self.within = np.concatenate(texts), np.concatenate(part_of), np.concatenate(within)
        # The windows of a text side by side; ``order`` tells where each lies in the parts laid end to end.
        self.order = np.argsort(self.texts, kind="stable")
        self.texts, self.part_of, self.within = self.texts[self.order], self.part_of[self.order], self.within[self.order]
        self.first = np.searchsorted(self.texts, np.arange(len(offsets)))

    def worst(self, weights: np.ndarray) -> np.ndarray:
        """The window of the highest log-odds of each text."""
        odds = []
        for bucket, bounds in self.parts:
            sums = np.concatenate([[0.0], np.cumsum(weights[bucket], dtype=np.float64)])
            odds.append(np.diff(sums[bounds]) / np.maximum(FLOOR, np.diff(bounds)))
        order = np.lexsort((np.concatenate(odds)[self.order], self.texts))
        return order[self.first[1:] - 1]

    def gather(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The n-grams of the windows, and the place of each one's window among those chosen."""
        own = []
        for w in chosen.tolist():
            bucket, bounds = self.parts[self.part_of[w]]
            k = self.within[w]
            own.append(bucket[bounds[k] : bounds[k + 1]])
        return np.concatenate(own), np.repeat(np.arange(len(own)), [len(x) for x in own])


def train(data: np.ndarray, offsets: np.ndarray, label: np.ndarray, seed: int = 7) -> Model:
    """The mean of models that each leave out a part of either class, its score THRESHOLD where the parts left out are told apart best."""
    number = int(min(FOLDS, (label == 1).sum(), (label == 0).sum())) if len(label) else 0
    if number < 2:
        return _train(data, offsets, label, seed)
    size = np.diff(offsets)

    def part(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return data[np.repeat(rows, size)], np.concatenate([[0], np.cumsum(size[rows])])

    fold, odds, models = np.zeros(len(label), np.int64), np.zeros(len(label)), []
    for k in (0, 1):
        fold[label == k] = np.arange((label == k).sum()) % number
    for k in range(number):
        models.append(_train(*part(fold != k), label[fold != k], seed + k))
        p = np.clip(models[-1].score(*part(fold == k)), 1e-12, 1 - 1e-12)
        odds[fold == k] = np.log(p / (1 - p))
    order = np.argsort(-odds, kind="stable")
    right = np.cumsum(label[order])
    wrong = np.arange(1, len(right) + 1) - right
    cost = right[-1] - right + FALSE_ALARM * wrong
    at = np.flatnonzero(cost == cost.min())[-1]
    below = odds[order[min(at + 1, len(order) - 1)]]
    bias = np.mean([m.bias for m in models]) + np.log(THRESHOLD / (1 - THRESHOLD)) - (odds[order[at]] + below) / 2
    return Model(np.mean([m.weights for m in models], axis=0), float(bias))


def _train(data: np.ndarray, offsets: np.ndarray, label: np.ndarray, seed: int) -> Model:
    """Adagrad on embeddings, softmax and bias together."""
    share = float(label.mean()) if len(label) else 0.5
    if len(label) == 0 or label.min() == label.max():
        return Model(np.zeros(1 << BITS), float(np.clip(np.log((share + 1e-9) / (1 - share + 1e-9)), -30, 30)))
    rng = np.random.default_rng(seed)
    bags = _Bags(data, offsets)
    vectors = rng.normal(0, 0.01, (1 << BITS, DIM)).astype(np.float32)
    softmax, bias = rng.normal(0, 1, (2, DIM)).astype(np.float32), np.zeros(2, np.float32)
    seen_v, seen_s, seen_b = np.full((1 << BITS, 1), 1e-6, np.float32), np.full((2, DIM), 1e-6, np.float32), np.full(2, 1e-6, np.float32)
    balance = np.where(label == 1, 0.5 / share, 0.5 / (1 - share)).astype(np.float32)
    # Few rows make few batches: they are gone through more often.
    more = max(1, -(-STEPS // (EPOCHS * -(-len(label) // BATCH))))
    for epoch in range(EPOCHS * more):
        if epoch < RANDOM_EPOCHS * more:
            n = np.diff(bags.first)
            chosen = bags.first[:-1] + (rng.random(len(n)) * n).astype(int)
        else:
            chosen = bags.worst((vectors @ (softmax[1] - softmax[0])).astype(np.float32))
        order = rng.permutation(len(label))
        for lo in range(0, len(order), BATCH):
            texts = order[lo : lo + BATCH]
            bucket, row = bags.gather(chosen[texts])
            if not len(bucket):
                continue
            own, inverse = np.unique(bucket, return_inverse=True)
            # The batch as a sparse matrix (windows x own buckets) of shares, kept as cells that sum equal pairs.
            cell, n = np.unique(row.astype(np.int64) * len(own) + inverse, return_counts=True)
            r, c = cell // len(own), cell % len(own)
            w = (n / np.maximum(FLOOR, np.bincount(row, minlength=len(texts)))[r]).astype(np.float32)
            e = vectors[own]
            mean = np.stack([np.bincount(r, w * e[c, d], len(texts)) for d in range(DIM)], 1).astype(np.float32)
            odds = mean @ softmax.T + bias
            p = np.exp(odds - odds.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(texts)), label[texts].astype(int)] -= 1
            p *= balance[texts][:, None] / len(texts)
            back = p @ softmax
            g_s, g_b = p.T @ mean, p.sum(0)
            g_v = np.stack([np.bincount(c, w * back[r, d], len(own)) for d in range(DIM)], 1).astype(np.float32) + DECAY * e
            seen_s += g_s**2
            seen_b += g_b**2
            seen_v[own] += (g_v**2).mean(1, keepdims=True)
            softmax -= LEARN * g_s / np.sqrt(seen_s)
            bias -= 0.2 * LEARN * g_b / np.sqrt(seen_b)
            vectors[own] -= LEARN * g_v / np.sqrt(seen_v[own])
    return Model(vectors @ (softmax[1] - softmax[0]), float(bias[1] - bias[0]))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", text: str = "text", key: str = "doc_id", sample_rows: int = SAMPLE_ROWS) -> Model:
    """A model from at most about ``sample_rows`` labelled rows per class; ``labels`` has (key, label)."""
    kept = labels.where(F.col(label).isNotNull()).select(F.col(key).alias("__key"), F.col(label).cast("double").alias("__label"))
    sample = F.broadcast(bounded(kept, "__label", "__key", sample_rows))  # its size is bounded
    own = docs.select(F.col(key).alias("key"), F.coalesce(text, F.lit("")).alias("text"))
    rows = own.join(sample, F.col("key") == F.col("__key")).select("key", "__label", "text")
    found = rows.toArrow().combine_chunks().sort_by([("key", "ascending"), ("text", "ascending")])
    column = found.column(2).combine_chunks() if found.num_rows else None
    data, offsets = flat(column) if column is not None else (np.zeros(0, np.uint8), np.zeros(1, np.int64))
    return train(data, offsets, found.column(1).to_numpy())


def keep_clean(docs: DataFrame, model: Model, threshold: float = THRESHOLD, text: str = "text") -> DataFrame:
    """The rows, with all their columns, whose score is below the threshold; no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in chunks(batches, text):
            yield rows.filter(pa.array(shared.value.score(data, offsets) < threshold))

    return docs.mapInArrow(run, docs.schema)


def predict(docs: DataFrame, model: Model, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, score) per row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in chunks(batches, "text"):
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(shared.value.score(data, offsets))], names=["key", "score"])

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(score, f"key {dict(docs.dtypes)[key]}, score double")
