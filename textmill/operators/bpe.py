"""Byte-level BPE: train, encode and decode over document tables.

Every row is a sequence of its own; no pair crosses a row. Training cuts rows down to what the next merges can touch
(``bpe_training``).
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.functions.tokens import (
    SURROGATES_SIZE, SURROGATES_START, byte_tokens, bytes_to_text, char_of, code_id, id_of, packed,
)
from textmill.operators.bpe_training import BORDER, DENSE, PairCounts, ids_of_text, learn, slices
from textmill.session import cut_lineage, spread_few

# The special tokens and the default sizes.
SPECIALS = ("<PAD>", "<UNK>", "<BOS>", "<EOS>")
VOCAB_SIZE = 4096
MIN_PAIR_FREQUENCY = 2
BYTES = 256

# Candidate pairs looked at where none is merged.
CANDIDATES = 256


@dataclass
class Tokenizer:
    """Learned merges and vocabulary; its size is bounded by the vocabulary size."""

    merges: list[tuple[int, int]]
    vocab: dict[int, bytes]
    specials: dict[str, int]
    log: list[tuple[int, int, int, int, int]] = field(default_factory=list)

    @property
    def bpe_vocab_size(self) -> int:
        return len(self.vocab)

    @property
    def vocab_size(self) -> int:
        return len(self.vocab) + len(self.specials)

    def tables(self, spark: SparkSession) -> tuple[DataFrame, DataFrame, DataFrame]:
        vocab = spark.createDataFrame(
            [(i, bytearray(b)) for i, b in sorted(self.vocab.items())], "id int, bytes binary"
        )
        merges = spark.createDataFrame(
            [(r, a, b) for r, (a, b) in enumerate(self.merges)], "rank int, left int, right int"
        )
        specials = spark.createDataFrame(list(self.specials.items()), "token string, id int")
        return vocab, merges, specials


def make_tokenizer(
    merges: Sequence[tuple[int, int]], *, special_ids: str = "distinct", log: list | None = None
) -> Tokenizer:
    """Vocabulary of a merge list. Specials get the ids after it: distinct ones, or one shared id."""
    vocab = {i: bytes([i]) for i in range(BYTES)}
    for left, right in merges:
        vocab[len(vocab)] = vocab[left] + vocab[right]
    step = 0 if special_ids == "shared" else 1
    specials = {name: len(vocab) + step * i for i, name in enumerate(SPECIALS)}
    return Tokenizer(list(merges), vocab, specials, list(log or []))


# ---------------------------------------------------------------- pair statistics


def _flat_codes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Packed token rows laid end to end, and where each begins, with the end of the last."""
    lengths = pc.binary_length(column).to_numpy(zero_copy_only=False) // 2
    flat = np.frombuffer(b"".join(column.to_pylist()), dtype=">u2").astype(np.uint16)
    return flat, np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])


def _pair_keys(flat: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs that lie within a row, and the pairs as numbers."""
    inside = np.ones(max(0, len(flat) - 1), bool)
    inside[starts[(starts > 0) & (starts < len(flat))] - 1] = False
    at = np.flatnonzero(inside)
    return at, (flat[at].astype(np.int64) << 16) | flat[at + 1]


def _count_neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Neighbour pairs of packed token rows, counted slice by slice and summed per task."""
    counts = PairCounts()
    for batch in batches:
        for part in slices(batch, column="t"):
            flat, starts = _flat_codes(part["t"])
            if len(flat) and flat.max() == BORDER:
                counts.rest.add(_pair_keys(flat, starts)[1], 1)
            else:
                counts.add(np.insert(flat, starts, BORDER))
    pairs, n = counts.sums()
    yield pa.RecordBatch.from_arrays(
        [pa.array((pairs >> 16).astype(np.int32)), pa.array((pairs & 0xFFFF).astype(np.int32)), pa.array(n)], names=["a", "b", "n"]
    )


def pair_counts(df: DataFrame, tokens: str) -> DataFrame:
    """``(a, b, n)``: how often the characters a and b are neighbours, overlaps included.

    Counted per task before the shuffle, in slices of some megabytes: at most one row per pair and task is moved.
    """
    data = df.filter(F.length(tokens) > 1).select(packed(F.col(tokens)).alias("t"))
    counts = data.mapInArrow(_count_neighbours, "a int, b int, n bigint")
    return counts.groupBy("a", "b").agg(F.sum("n").alias("n"))


def _count_and_meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Neighbour pairs of (order, packed tokens) rows with their number and first place, per slice."""
    for batch in batches:
        order = batch.schema.names[0]
        for part in slices(batch, [order], "t"):
            flat, starts = _flat_codes(part["t"])
            at, keys = _pair_keys(flat, starts)
            width = int(flat.max(initial=0)) + 1
            if width * width <= DENSE:
                cells = flat[at].astype(np.int32) * np.int32(width) + flat[at + 1]
                met = np.zeros(width * width, np.int64)
                met[cells[::-1]] = at[::-1]
                n = np.bincount(cells, minlength=width * width)
                a, b = np.divmod(np.flatnonzero(n), width)
                first, n = met[n > 0], n[n > 0]
            else:
                pairs, first, n = np.unique(keys, return_index=True, return_counts=True)
                a, b, first = pairs >> 16, pairs & 0xFFFF, at[first]
            row = np.searchsorted(starts, first, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32)), pa.array(n),
                 part[order].take(pa.array(row)), pa.array(first - starts[row])],
                names=["a", "b", "n", "row", "at"],
            )


def top_pairs(df: DataFrame, tokens: str, order: str, k: int = CANDIDATES) -> list[tuple[str, int]]:
    """The ``k`` most frequent pairs; of equals the one met first comes first.

    Numbers and first places come from one pass, at most one row per pair and slice of it; ``k`` rows come back.
    """
    data = df.filter(F.length(tokens) > 1).select(order, packed(F.col(tokens)).alias("t"))
    kind = data.schema[order].dataType.simpleString()
    met = data.mapInArrow(_count_and_meet, f"a int, b int, n bigint, row {kind}, at bigint")
    counts = met.groupBy("a", "b").agg(F.sum("n").alias("n"), F.min(F.struct("row", "at")).alias("met"))
    rows = counts.orderBy(F.desc("n"), "met").limit(k).collect()
    return [(chr(r["a"]) + chr(r["b"]), r["n"]) for r in rows]


def independent_prefix(pairs: Sequence[tuple[Sequence, int]], min_frequency: int, room: int) -> list[tuple[Sequence, int]]:
    """The leading pairs that are sure to be the next merges in this order.

    Merging (a, b) takes the tokens a that a b follows, and the tokens b that an a precedes. So pairs (a, c) and (c, b) keep
    their counts and first places; only a pair that begins with b or ends with a can lose, and the run ends before the first of
    those. A pair made with the new token stands where such a pair stood, so it is no more frequent, nor met before one that
    ranks above that pair: it begins one place earlier, where the merged pair itself stood. Pairs of one token twice
    end the run, as their product can follow itself.
    """
    out: list[tuple[Sequence, int]] = []
    begins, ends = set(), set()
    for pair, n in pairs:
        if len(out) >= room or n < min_frequency or pair[0] in ends or pair[1] in begins:
            break
        out.append((pair, n))
        begins.add(pair[0])
        ends.add(pair[1])
        if pair[0] == pair[1]:
            break
    return out


# ---------------------------------------------------------------- training


def bpe_train(
    df: DataFrame, text: str, order: str, *, vocab_size: int = VOCAB_SIZE,
    min_pair_frequency: int = MIN_PAIR_FREQUENCY, special_ids: str = "distinct",
) -> Tokenizer:
    """Learn merges from a text column; ``order`` is the row order that settles ties.

    Stops at the size, when no pair is left, or below the minimum frequency.
    """
    goal = vocab_size - len(SPECIALS)
    if goal <= BYTES:
        raise ValueError(f"vocab_size must be greater than {BYTES + len(SPECIALS)}")
    char_of(goal - 1)
    # Spread once where there are few parts: every later pass reads this table.
    state = cut_lineage(spread_few(ids_of_text(df, text, order), order))
    left = state.agg(F.sum(F.length("ids")).alias("n")).first()["n"]
    if not left:
        raise ValueError("the training text is empty")

    def choose(ranked: list, room: int) -> list:
        return independent_prefix(ranked, min_pair_frequency, room)

    merges: list[tuple[int, int]] = []
    log: list[tuple[int, int, int, int, int]] = []
    for a, b, n, merged in learn(state, order, choose, BYTES, goal, [1] * BYTES, min_pair_frequency):
        merges.append((a, b))
        left -= merged
        log.append((len(merges), a, b, n, left))
    return make_tokenizer(merges, special_ids=special_ids, log=log)


# ---------------------------------------------------------------- encode and decode


def merge_steps(tok: Tokenizer) -> list[tuple[str, str]]:
    """``(pair, product)`` strings in rank order; equal byte strings give the last id."""
    by_bytes = {b: i for i, b in sorted(tok.vocab.items())}
    steps = []
    for a, b in tok.merges:
        product = tok.vocab[a] + tok.vocab[b]
        if product not in by_bytes:
            raise ValueError(f"the product of ({a}, {b}) is not in the vocabulary")
        steps.append((char_of(a) + char_of(b), char_of(by_bytes[product])))
    return steps


class BatchEncoder:
    """Encodes many byte strings at once over flat id arrays.

    The lowest rank present is always merged first, and a merge only makes pairs of higher rank. So one sweep over
    the ranks merges all places of a rank in all strings together: ids stand in a linked list, and the places of a pair are
    kept by its rank. The work is that of the merges done, whatever the length of a string or the size of the vocabulary.
    """

    CHUNK = 1 << 20  # bytes encoded in one sweep
    _STOP = 1 << 30

    def __init__(self, tok: Tokenizer):
        steps = merge_steps(tok)
        rank: dict[int, int] = {}
        for r, (pair, _) in enumerate(steps):
            rank.setdefault(id_of(pair[0]) << 32 | id_of(pair[1]), r)
        self.product = [id_of(out) for _, out in steps]
        self.pairs = [(id_of(pair[0]), id_of(pair[1])) for pair, _ in steps]
        self.kind = np.min_scalar_type(len(steps))  # numbers of one or two bytes are sorted by radix
        self.keys = np.array(sorted(rank), np.uint64)
        self.ranks = np.array([rank[int(k)] for k in self.keys], np.int64)
        # One probe of a sparse table finds most pairs; what shares a slot is looked up by bisection.
        bits = max(10, int(np.ceil(np.log2(16 * len(self.keys) + 1))))
        self.shift = np.uint64(64 - bits)
        self.slots = np.full(1 << bits, -1, np.int64)
        self.slots[self._slot(self.keys)] = np.arange(len(self.keys))
        # Texts begin as bytes, whose pairs index tables of their own.
        self.byte_ranks = np.full(1 << 16, -1, np.int64)
        left, right = self.keys >> np.uint64(32), self.keys & np.uint64(0xFFFFFFFF)
        of_bytes = (left < BYTES) & (right < BYTES)
        self.byte_ranks[(left[of_bytes] << np.uint64(8)) | right[of_bytes]] = self.ranks[of_bytes]
        self.merged_bytes = self.byte_ranks >= 0

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 for those that are not merged."""
        keys = (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)
        at = self.slots[self._slot(keys)]
        out = np.full(len(keys), -1, np.int64)
        if not len(self.keys):
            return out
        hit = (at >= 0) & (self.keys[at] == keys)
        out[hit] = self.ranks[at[hit]]
        other = np.flatnonzero((at >= 0) & ~hit)
        near = np.minimum(np.searchsorted(self.keys, keys[other]), len(self.keys) - 1)
        out[other] = np.where(self.keys[near] == keys[other], self.ranks[near], -1)
        return out

    def _sweep(self, data: list[bytes]) -> list[str]:
        flat = np.frombuffer(b"\0" + b"".join(x + b"\0" for x in data), np.uint8)
        n = len(flat)
        ids = flat.astype(np.int32)
        stops = np.concatenate([[0], np.cumsum([len(x) + 1 for x in data])])
        ids[stops] = self._STOP  # a stop before each string and after the last
        follow, before = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n - 1, dtype=np.int32)
        places: dict[int, list[np.ndarray]] = {}

        def keep(at: np.ndarray, rank: np.ndarray) -> None:
            at, rank = at[rank >= 0], rank[rank >= 0].astype(self.kind)
            order = np.argsort(rank, kind="stable")
            at, rank = at[order], rank[order]
            cuts = np.flatnonzero(np.diff(rank)) + 1
            for part, r in zip(np.split(at, cuts), rank[np.append(0, cuts)].tolist() if len(rank) else (), strict=False):
                places.setdefault(r, []).append(part)

        # Only pairs of bytes that some rank merges; a stop is none, whatever byte stood for it.
        pairs = (flat[:-1].astype(np.uint16) << np.uint16(8)) | flat[1:]
        found = self.merged_bytes[pairs]
        found[stops[:-1]] = found[stops[1:] - 1] = False
        at = np.flatnonzero(found).astype(np.int32)
        keep(at, self.byte_ranks[pairs[at]])
        for r in range(len(self.product)):
            found = places.pop(r, None)
            if found is None:
                continue
            at = np.concatenate(found)
            left, right = self.pairs[r]
            # Places whose ids have changed meanwhile, and those kept twice, are left out.
            at = at[ids[at] == left]
            at = np.sort(at[ids[follow[at]] == right])
            if len(at) > 1:
                at = at[np.append(True, at[1:] != at[:-1])]
            if not len(at):
                continue
            # Of places that overlap, every other from the left.
            first = np.ones(len(at), bool)
            first[1:] = follow[at[:-1]] != at[1:]
            if not first.all():
                index = np.arange(len(at))
                at = at[(index - np.maximum.accumulate(np.where(first, index, 0))) % 2 == 0]
            gone = follow[at]
            after = follow[gone]
            ids[at] = self.product[r]
            ids[gone] = -1
            follow[at] = after
            before[after] = at
            at = np.concatenate([before[at], at])
            keep(at, self._rank(ids[at], ids[follow[at]]))
        ids = ids[ids >= 0]
        stops = np.flatnonzero(ids == self._STOP)
        ids[stops] = 32
        ids[ids >= SURROGATES_START] += SURROGATES_SIZE
        text = ids.astype("<u4").tobytes().decode("utf-32-le")
        return [text[a + 1 : b] for a, b in zip(stops[:-1].tolist(), stops[1:].tolist(), strict=True)]

    def encode(self, data: list[bytes]) -> list[str]:
        out: list[str] = []
        part: list[bytes] = []
        size = 0
        for x in data:
            part.append(x)
            size += len(x)
            if size >= self.CHUNK:
                out += self._sweep(part)
                part, size = [], 0
        return out + self._sweep(part) if part else out


def in_parts(texts: pa.Array, work: Callable[[pa.Array], pa.Array], kind: pa.DataType, size: int = 0) -> pa.Array:
    """Texts or lists worked on a million bytes or items at a time; a longer row is a part of its own."""
    length = pc.list_value_length if pa.types.is_nested(texts.type) else pc.binary_length
    ends = pc.fill_null(length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64).cumsum()
    out, at = [], 0
    while at < len(texts):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + (size or BatchEncoder.CHUNK), "right")))
        out.append(work(texts.slice(at, stop - at)).cast(kind))
        at = stop
    return pa.concat_arrays(out) if out else pa.array([], kind)


def _encoder(tok: Tokenizer, pattern: str | None) -> Callable[[Column], Column]:
    """Arrow UDF of ``BatchEncoder``; with a pattern, special tokens in the text become their ids."""
    marks = {n: char_of(i) for n, i in tok.specials.items()}
    encoder = BatchEncoder(tok)

    def part(texts: pa.Array) -> pa.Array:
        if pattern is None:
            done = encoder.encode(pc.fill_null(texts, "").cast(pa.binary()).to_pylist())
            return pc.if_else(texts.is_valid(), pa.array(done, pa.string()), pa.scalar(None, pa.string()))
        parts = [re.split(f"({pattern})", t) for t in pc.fill_null(texts, "").to_pylist()]
        done = iter(encoder.encode([p.encode() for row in parts for p in row[::2]]))
        joined = ["".join(marks[p] if i % 2 else next(done) for i, p in enumerate(row)) for row in parts]
        return pc.if_else(texts.is_valid(), pa.array(joined, pa.string()), pa.scalar(None, pa.string()))

    def encode(texts: pa.Array) -> pa.Array:
        return in_parts(texts, part, pa.string())

    return F.arrow_udf(encode, "string")


def encode_text(text: Column, tok: Tokenizer) -> Column:
    """Text to a token string, in Arrow batches; the same way for every vocabulary."""
    return _encoder(tok, None)(text)


def word_tokenizer(words: Sequence[str], *, special_ids: str = "distinct") -> Tokenizer:
    """A tokenizer whose tokens are the words given and their beginnings, without training."""
    ids: dict[bytes, int] = {bytes([i]): i for i in range(BYTES)}
    merges: list[tuple[int, int]] = []
    for word in words:
        data = word.encode()
        for end in range(2, len(data) + 1):
            if data[:end] not in ids:
                merges.append((ids[data[: end - 1]], data[end - 1]))
                ids[data[:end]] = len(ids)
    return make_tokenizer(merges, special_ids=special_ids)


def _special_pattern(tok: Tokenizer) -> str:
    names = sorted(tok.specials, key=len, reverse=True)
    return "|".join(names)


def encode_with_specials(text: Column, tok: Tokenizer) -> Column:
    """Like ``encode_text``, but literal special tokens in the text become their ids.

    Text between them is encoded on its own. Patterns try the longest name first.
    """
    return _encoder(tok, _special_pattern(tok))(text)


def with_bos_eos(tokens: Column, tok: Tokenizer, *, bos: bool = True, eos: bool = True) -> Column:
    for name, wanted in (("<BOS>", bos), ("<EOS>", eos)):
        if wanted and name not in tok.specials:
            raise ValueError(f"the tokenizer has no {name}")
    head = F.lit(char_of(tok.specials["<BOS>"])) if bos else F.lit("")
    tail = F.lit(char_of(tok.specials["<EOS>"])) if eos else F.lit("")
    return F.concat(head, tokens, tail)


class BatchDecoder:
    """Bytes of many id sequences at once, gathered from the vocabulary laid end to end."""

    def __init__(self, known: dict[int, bytes]):
        size = max(known, default=-1) + 1
        self.length = np.array([len(known[i]) if i in known else -1 for i in range(size)], np.int32)
        self.start = np.concatenate([[0], np.cumsum(np.maximum(0, self.length))])[:-1].astype(np.int32)
        self.data = np.frombuffer(b"".join(known.get(i, b"") for i in range(size)), np.uint8)

    def decode(self, ids: np.ndarray, counts: np.ndarray, valid: pa.Array) -> pa.Array:
        """Binary rows of ``counts`` ids each; an unknown id is an error."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.length) or self.length[ids].min() < 0):
            raise ValueError("unknown token id")
        n = self.length[ids]
        ends = np.concatenate([[0], np.cumsum(n, dtype=np.int64)])
        if ends[-1] > np.iinfo(np.int32).max:
            raise ValueError("a part of more than 2 GB")
        ends = ends.astype(np.int32)
        data = self.data[np.repeat(self.start[ids] - ends[:-1], n) + np.arange(ends[-1], dtype=np.int32)]
        offsets = ends[np.concatenate([[0], np.cumsum(counts)])]
        rows = pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])
        return pc.if_else(valid, rows, pa.scalar(None, pa.binary()))


def _known_bytes(tok: Tokenizer, skip_specials: bool) -> dict[int, bytes]:
    """Bytes of every id; with a shared special id the last name stands for it."""
    return {**tok.vocab, **{i: b"" if skip_specials else n.encode() for n, i in tok.specials.items()}}


def decode_ids(ids: Column, tok: Tokenizer, *, skip_specials: bool = True) -> Column:
    """Ids to text: bytes joined, then UTF-8 with replacement. An unknown id is an error."""
    decoder = BatchDecoder(_known_bytes(tok, skip_specials))

    def part(lists: pa.Array) -> pa.Array:
        counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        return decoder.decode(lists.flatten().to_numpy(zero_copy_only=False), counts, lists.is_valid())

    def look_up(lists: pa.Array) -> pa.Array:
        return in_parts(lists, part, pa.binary())

    return bytes_to_text(F.arrow_udf(look_up, "binary")(ids))


def decode_tokens(tokens: Column, tok: Tokenizer, *, skip_specials: bool = True) -> Column:
    """Token string to text, like ``decode_ids``."""
    return _decode_tokens(tokens, BatchDecoder(_known_bytes(tok, skip_specials)))


def decode_by_table(tokens: Column, vocab: DataFrame) -> Column:
    """Token string to text by a table of ``(id, bytes)``, which no vocabulary makes longer than the ids there are. An id that it lacks is an error."""
    return _decode_tokens(tokens, BatchDecoder({r["id"]: bytes(r["bytes"]) for r in vocab.select("id", "bytes").collect()}))


def _decode_tokens(tokens: Column, decoder: BatchDecoder) -> Column:
    def part(texts: pa.Array) -> pa.Array:
        rows = pc.fill_null(texts, "").to_pylist()
        codes = np.frombuffer("".join(rows).encode("utf-32-le"), "<i4")
        ids = np.where(codes < SURROGATES_START, codes, codes - SURROGATES_SIZE) if codes.max(initial=0) >= SURROGATES_START else codes
        return decoder.decode(ids, np.array([len(t) for t in rows], np.int64), texts.is_valid())

    def look_up(texts: pa.Array) -> pa.Array:
        return in_parts(texts, part, pa.binary())

    return bytes_to_text(F.arrow_udf(look_up, "binary")(tokens))


def round_trip_failures(df: DataFrame, text: str, tok: Tokenizer) -> DataFrame:
    """Rows whose text does not survive encoding and decoding."""
    return df.filter(decode_tokens(encode_text(F.col(text), tok), tok) != F.col(text))


def present_pairs(df: DataFrame, tokens: str, merges: DataFrame) -> DataFrame:
    """Merges of the table that occur in the data: ``(rank, left, right, n)``."""
    counts = pair_counts(df, tokens).select(code_id(F.col("a")).alias("left"), code_id(F.col("b")).alias("right"), "n")
    return counts.join(merges, ["left", "right"]).select("rank", "left", "right", "n")
