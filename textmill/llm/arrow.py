"""Arrow batches of texts as flat byte arrays, and word hashes over them, for vectorised numpy passes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 20  # bytes of text worked on at once; a longer text makes a chunk of its own
_SEGMENT = 1 << 19

WHITE = np.zeros(256, bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True
_MULT = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix64(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: every bit of the input reaches every bit of the result."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix64(np.arange(1, 257, dtype=np.uint64))


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the n + 1 offsets into them; null is empty."""
    column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) else "").cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8) if len(column) else np.zeros(1, np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(batches: Iterator[pa.RecordBatch], column: str, size: int = CHUNK) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of rows of about ``size`` bytes of text, each with its bytes and offsets."""
    for batch in batches:
        data, offsets = flat(batch.column(batch.schema.get_field_index(column)))
        at = 0
        while at < batch.num_rows:
            stop = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
            yield batch.slice(at, stop - at), data[offsets[at] : offsets[stop]], offsets[at : stop + 1] - offsets[at]
            at = stop


def owners(positions: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The row each byte position belongs to."""
    return np.searchsorted(offsets[:-1], positions, "right") - 1


def word_bounds(data: np.ndarray, offsets: np.ndarray, white: np.ndarray = WHITE) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of words: longest runs without white bytes within a row."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = ~white[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    begin = inside.copy()
    begin[1:] &= ~inside[:-1] | cut[1:-1]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | cut[1:-1]
    return np.flatnonzero(begin), np.flatnonzero(end) + 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, by differences of running sums over segments of many words."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        first = starts[at]
        stop = max(at + 1, int(np.searchsorted(ends, first + _SEGMENT, "right")))
        part = data[first : ends[stop - 1]]
        power = np.full(len(part) + 1, _MULT)
        power[0] = 1
        np.multiply.accumulate(power, out=power)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_BYTE[part] * power[:-1], out=sums[1:])
        back = np.full(len(part) + 1, _INVERSE)
        back[0] = 1
        np.multiply.accumulate(back, out=back)
        s, e = starts[at:stop] - first, ends[at:stop] - first
        out[at:stop] = mix64((sums[e] - sums[s]) * back[s] + (e - s).astype(np.uint64))
        at = stop
    return out


def shingles(data: np.ndarray, offsets: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words per row and n + 1 offsets; fewer words make one shingle, no word makes none."""
    starts, ends = word_bounds(data, offsets)
    hashed = word_hashes(data, starts, ends)
    upto = np.searchsorted(starts, offsets)
    return shingle_runs(hashed, upto, size)


def shingle_runs(hashed: np.ndarray, upto: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of rows given by word hashes and n + 1 offsets into them."""
    n_words = np.diff(upto)
    n = np.where(n_words >= size, n_words - size + 1, np.minimum(n_words, 1))
    out_at = np.concatenate([[0], np.cumsum(n)])
    if not out_at[-1]:
        return np.zeros(0, np.uint64), out_at
    row = np.repeat(np.arange(len(n)), n)
    first = np.arange(out_at[-1]) - out_at[row] + upto[row]
    last = upto[row + 1]
    total = np.zeros(len(first), np.uint64)
    for k in range(size):
        at = first + k
        there = at < last
        total = total * _MULT + np.where(there, hashed[np.minimum(at, len(hashed) - 1)], np.uint64(k + 1))
    return mix64(total), out_at
