"""Fill-in-middle: each text is cut into prefix, middle and suffix at unit bounds and put in a new order for training.

A chunk of texts is one sequence of character classes, held in a wavelet matrix: three bit planes, each sorted stably by the bit above,
with running bit counts per 64-bit word. The rank of a class up to a place takes three lookups. Combinations of ranks give the number
of units (lines, words or characters) and of characters between two places; a cut after k units is found by bisection on ranks, for
all texts of the chunk at once.

Units: ``lines`` end after each line feed, the last one at the end of the text; ``words`` are runs of other than ASCII white space
with the white space before them (a tail of white space is a unit); ``chars`` are code points.

A text that is empty or holds a marker stays plain, as does one that the draw leaves out; so outputs can always be taken apart
again. Draws come from a hash of the key, the same on every cluster.

Defined results: null text is empty and plain, with no units; a null key draws as the empty string; repeated rows give equal rows;
texts of any length; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.llm.arrow import WHITE, chunks

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SEED = 7
FIM_SHARE, SPM_SHARE = 100, 50  # in hundredths
UNITS = ("lines", "words", "chars")
# Classes of bytes: what follows the first byte of a code point, word characters, the first of a word, white space, line feeds.
_FOLLOW, _WORD, _FIRST, _BLANK, _FEED = range(5)
_PLANES = 3


def classes(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The class of each byte of texts laid end to end."""
    if not len(data):
        return np.zeros(0, np.uint8)
    out = np.full(len(data), _WORD, np.uint8)
    white = WHITE[data]
    first = ~white
    begins = np.zeros(len(data), bool)
    begins[offsets[:-1][offsets[:-1] < len(data)]] = True
    first[1:] &= white[:-1] | begins[1:]
    out[(data & 0xC0) == 0x80] = _FOLLOW
    out[white] = _BLANK
    out[data == 10] = _FEED
    out[first] = _FIRST
    return out


class Bits:
    """A bit sequence with the number of ones before any place."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 8, np.uint8)
        packed = np.packbits(bits, bitorder="little")
        padded[: len(packed)] = packed
        self.words = padded.view("<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])

    def ones(self, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & below)


class WaveletMatrix:
    """Ranks of symbols below 8 in a sequence, by bit planes from the highest."""

    def __init__(self, symbols: np.ndarray):
        self.planes = []
        for level in reversed(range(_PLANES)):
            bits = (symbols >> level & 1).astype(bool)
            self.planes.append((Bits(bits), len(bits) - int(bits.sum())))
            symbols = np.concatenate([symbols[~bits], symbols[bits]])

    def rank(self, symbol: int, at: np.ndarray) -> np.ndarray:
        """How often the symbol stands before each place."""
        low, high = np.zeros(1, np.int64), np.asarray(at, np.int64)
        for level, (bits, zeros) in zip(reversed(range(_PLANES)), self.planes, strict=True):
            if symbol >> level & 1:
                low, high = zeros + bits.ones(low), zeros + bits.ones(high)
            else:
                low, high = low - bits.ones(low), high - bits.ones(high)
        return high - low


class Units:
    """Unit bounds of the texts of a chunk, all by ranks."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, unit: str):
        if unit not in UNITS:
            raise ValueError(f"unit is one of {', '.join(UNITS)}")
        self.matrix, self.offsets, self.unit = WaveletMatrix(classes(data, offsets)), offsets, unit
        self.start, self.stop = offsets[:-1], offsets[1:]
        whole = self.marks(self.stop) - self.marks(self.start)
        # What follows the last mark is a unit of its own; for characters there is nothing.
        self.tail = np.zeros(len(whole), bool)
        full = np.flatnonzero(self.stop > self.start)
        if unit != "chars" and len(full):
            last = self.stop[full] - 1
            ends = data[last] == 10 if unit == "lines" else ~WHITE[data[last]]
            self.tail[full] = ~ends
        self.count = whole + self.tail

    def marks(self, at: np.ndarray) -> np.ndarray:
        """Marks before places: line feeds, ends of words (as their first characters), or code points."""
        if self.unit == "lines":
            return self.matrix.rank(_FEED, at)
        if self.unit == "words":
            return self.matrix.rank(_FIRST, at)
        return at - self.matrix.rank(_FOLLOW, at)

    def chars(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Code points between places."""
        return b - a - self.matrix.rank(_FOLLOW, b) + self.matrix.rank(_FOLLOW, a)

    def ends(self, k: np.ndarray) -> np.ndarray:
        """The place after the first k units of each text: the least one that has as many marks before it."""
        before = self.marks(self.start)
        low, high = self.start.copy(), self.stop.copy()
        while (open_ := low < high).any():
            mid = (low + high) >> 1
            enough = self.marks(mid) - before >= k
            high = np.where(open_ & enough, mid, high)
            low = np.where(open_ & ~enough, mid + 1, low)
        if self.unit == "chars":  # the code point's last byte
            return self._past(_FOLLOW, low)
        if self.unit == "words":  # from the first character to the word's end
            return np.where(k > 0, self._past(_WORD, low, _FOLLOW), low)
        return low

    def _past(self, symbol: int, at: np.ndarray, other: int | None = None) -> np.ndarray:
        """The end of the run of one or two symbols from each place on, by bisection: as many of them as places."""

        def n(place):
            return self.matrix.rank(symbol, place) + (self.matrix.rank(other, place) if other is not None else 0)

        low, high, base = at.copy(), self.stop.copy(), n(at)
        while (open_ := low < high).any():
            mid = (low + high + 1) >> 1
            inside = n(mid) - base == mid - at
            low = np.where(open_ & inside, mid, low)
            high = np.where(open_ & ~inside, mid - 1, high)
        return low


@dataclass(frozen=True)
class Markers:
    prefix: bytes = PREFIX
    suffix: bytes = SUFFIX
    middle: bytes = MIDDLE

    def inside(self, text: bytes) -> bool:
        return self.prefix in text or self.suffix in text or self.middle in text

    def join(self, form: str, prefix: bytes, middle: bytes, suffix: bytes) -> bytes:
        if form == "spm":
            return b"".join([self.suffix, suffix, self.prefix, prefix, self.middle, middle])
        return b"".join([self.prefix, prefix, self.suffix, suffix, self.middle, middle])

    def restore(self, output: bytes, form: str) -> bytes:
        """The text again, from an output and its form."""
        if form == "plain":
            return output
        first, second = (self.suffix, self.prefix) if form == "spm" else (self.prefix, self.suffix)
        one, rest = output[len(first) :].split(second, 1)
        two, middle = rest.split(self.middle, 1)
        return two + middle + one if form == "spm" else one + middle + two


def draws(key: Column, seed: int = SEED) -> list[Column]:
    """Four numbers below 2**32 from the SHA-256 of seed and key."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def transform(
    docs: DataFrame, text: str = "text", key: str = "doc_id", unit: str = "lines", seed: int = SEED, fim_share: int = FIM_SHARE,
    spm_share: int = SPM_SHARE, markers: Markers = Markers(),
) -> DataFrame:
    """(key, n, form, prefix_chars, middle_chars, output, restored): outputs, and the texts rebuilt from output and form alone.

    n is the number of units; the lengths count code points and are null for plain rows.
    """
    numbers = [d.alias(f"h{i}") for i, d in enumerate(draws(F.col(key), seed), 1)]
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), *numbers)
    schema = f"key {rows.schema['key'].dataType.simpleString()}, n long, form string, prefix_chars long, middle_chars long, output string, restored string"
    return rows.mapInArrow(_transform(unit, fim_share, spm_share, markers), schema)


def _transform(unit: str, fim_share: int, spm_share: int, markers: Markers):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in chunks(batches, "text"):
            units = Units(data, offsets, unit)
            h1, h2, h3, h4 = (rows.column(i).to_numpy(zero_copy_only=False) for i in range(2, 6))
            a, b = h1 % (units.count + 1), h2 % (units.count + 1)
            cut, end = units.ends(np.minimum(a, b)), units.ends(np.maximum(a, b))
            prefix, middle = units.chars(offsets[:-1], cut), units.chars(cut, end)
            raw = data.tobytes()
            forms, outputs, restored = [], [], []
            for lo, hi, p, m, keep, spm in zip(*(x.tolist() for x in (offsets[:-1], offsets[1:], cut, end, h3 % 100 < fim_share, h4 % 100 < spm_share)), strict=True):
                whole = raw[lo:hi]
                form = "plain" if not whole or not keep or markers.inside(whole) else "spm" if spm else "psm"
                out = whole if form == "plain" else markers.join(form, raw[lo:p], raw[p:m], raw[m:hi])
                forms.append(form)
                outputs.append(out)
                restored.append(markers.restore(out, form))
            plain = np.array([f == "plain" for f in forms], bool)
            cols = [
                rows.column(0), pa.array(units.count, pa.int64()), pa.array(forms, pa.string()), pa.array(prefix, pa.int64(), mask=plain),
                pa.array(middle, pa.int64(), mask=plain), pa.array(outputs, pa.binary()).cast(pa.string()), pa.array(restored, pa.binary()).cast(pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(cols, names=["key", "n", "form", "prefix_chars", "middle_chars", "output", "restored"])

    return run
