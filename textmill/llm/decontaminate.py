"""Benchmark decontamination: passages of documents within a small edit distance of a benchmark item.

Candidates come in two ways, and each candidate passage is verified by its exact edit distance to the whole item.

Items are sampled. A CGK random walk embeds a window: step j puts out the letter under the pointer, and a random bit of (j, letter)
says whether the pointer moves on, so that after an edit two walks soon fall into step again. Bit-sampling LSH joins a few of the
symbols put out to a key; windows of documents that share a key with a window of an item are candidates.

* A walk in step with another still agrees in two of three symbols after 12 steps at MAX_SHARE edits per character, but in one of three
  after 96. So a walk is a few words long, and an item has one at each of its words (in scripts without spaces at each character).
* Items fall into classes by their number of windows. How many repetitions a class needs is found by trial: copies of its items with
  MAX_SHARE random edits per character are searched, and the least number that finds RECALL of them is taken.
* How many symbols make a key, and so how long a walk is, follows from how often windows of different items meet: chance meetings
  stay in proportion to the documents, whatever the number of items.
* Walks that met must agree in AGREEING of all their steps, and the item's next SEGMENT letters must be nearby, within LOCAL_SHARE
  edits per letter, before the whole item is verified.

Classes that MAX_REPEATS repetitions do not bring to RECALL (short items) and items whose windows stand in more than SHARED items are
counted, which loses no passage. An item within its number of edits has a segment (SEGMENT characters at
most) within that segment's share of them, and of a segment's pieces of two to four characters all but one an edit occur as they are, on
diagonals no further apart than the edits. Pieces are looked up at every character of a document, whatever its script, and
counted by diagonal; where enough meet, the edit distance of the segment is computed for many places at once.

An item of n characters may have int(n * MAX_SHARE) edits, whatever its length. Items are held in blocks of bounded size; a
benchmark of several blocks is scanned block by block.

Defined results: null and empty texts and items match nothing (items are trimmed); passages of one item do not overlap, the best
wins; repeated rows and repeated items are each reported; an empty table on either side gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from textmill.llm.arrow import chunks, mix64, owners

PER_SYMBOL, PER_WALK, MAX_REPEATS = 3, 4, 8  # steps of a walk to a symbol of its keys, keys of a walk, repetitions
RECALL, TRIALS, TRIAL_CHARS = 0.99, 200, 400_000
SHARED = 32  # distinct items that may have the same window
AGREEING = 0.58  # share of the steps of two walks with the same symbol
SYMBOLS = (6, 8, 9, 10)  # of a key, the last three for many windows
CHANCE = 0.5  # windows of other items that a window meets in a repetition
BLOCK_ITEMS, BLOCK_CHARS = 20_000, 16_000_000
MAX_SHARE = 0.2  # edits per character of the item at which a passage still counts
LOCAL_SHARE, _DRIFT = 0.35, 8
SEGMENT, SEGMENTS = 64, 1 << 14  # characters of a segment, a bit each; segments counted together
_AT_ONCE, _CELLS, _HITS, _LANES = 8192, 1 << 22, 1 << 21, 4096  # characters, cells, hits and places worked on at once
_WALKS = 1 << 14  # walks made side by side
_MASK = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def walk_bits(walk: int, steps: int) -> np.ndarray:
    """(steps, 256) random bits of one walk."""
    drawn = mix64(np.arange(steps * 256, dtype=np.uint64) + np.uint64((walk + 1) << 40))
    return (drawn >> np.uint64(63)).astype(np.int32).reshape(steps, 256)


def embed(letters: np.ndarray, starts: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """(steps, windows) symbols of the CGK walks from ``starts``; letters have a tail as long as a walk."""
    out = np.empty((len(bits), len(starts)), np.uint8)
    at = starts.astype(np.int32)
    for j, row in enumerate(bits):
        symbol = letters[at]
        out[j] = symbol
        at += row[symbol]
    return out


def sampled_steps(repeat: int, sampled: int) -> np.ndarray:
    """Steps of a key, one from each of as many equal stretches of the walk, as steps side by side often show one letter."""
    drawn = mix64(np.arange(sampled, dtype=np.uint64) + np.uint64((repeat + 1) << 20))
    return np.arange(sampled) * PER_SYMBOL + (drawn % np.uint64(PER_SYMBOL)).astype(np.int64)


def window_keys(letters: np.ndarray, starts: np.ndarray, repeats: int, sampled: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(repetition, number of the first window, keys, symbols) of some windows at a time; a key is the sampled symbols side by side, hashed beyond eight."""
    for first in range(0, len(starts), _WALKS):
        some = starts[first : first + _WALKS]
        for r in range(repeats):
            if r % PER_WALK == 0:
                symbols_of = embed(letters, some, walk_bits(r // PER_WALK, PER_SYMBOL * sampled))
            key = np.zeros((len(some), 8 if sampled <= 8 else 16), np.uint8)
            for i, j in enumerate(sampled_steps(r, sampled)):
                key[:, i] = symbols_of[j]
            key = key.view("<u8")
            yield r, first, key[:, 0] if sampled <= 8 else key[:, 0] * _SPREAD ^ mix64(key[:, 1]), symbols_of


def window_starts(symbol: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Places where walks start: first characters of words, and characters of three bytes or more."""
    white = (symbol <= 32) & ((symbol == 32) | ((symbol >= 9) & (symbol <= 13)))
    border = np.zeros(len(symbol) + 1, bool)
    border[rows] = True
    start = symbol > 0xFFFF
    start[1:] |= white[:-1]
    start |= border[:-1]
    return np.flatnonzero(start & ~white)


def distance(passage: str, item: str, most: int) -> tuple[int, int, int] | None:
    """Least edit distance of the item to a part of the passage, with the part's start and end; None above ``most``.

    Bit-parallel dynamic programming, a column per character; the start is found by the same pass backwards.
    """
    found = _search(passage, item)
    if found is None or found[0] > most:
        return None
    best, end = found
    back = _search(passage[:end][::-1], item[::-1], whole=best)
    return best, end - back[1], end


def _search(text: str, pattern: str, whole: int | None = None) -> tuple[int, int] | None:
    """(distance, end) of the best match ending anywhere in the text, the first of equals.

    With ``whole`` the match starts at the beginning of the text, and the first end at that distance is returned.
    """
    m = len(pattern)
    if not m:
        return None
    places: dict[str, int] = {}
    for i, ch in enumerate(pattern):
        places[ch] = places.get(ch, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    best = (m, 0)
    for j, ch in enumerate(text):
        eq = places.get(ch, 0)
        diagonal = (((eq & plus) + plus) ^ plus) | eq | minus
        up = minus | (full & ~(diagonal | plus))
        down = plus & diagonal
        score += bool(up & top) - bool(down & top)
        up = (up << 1 | (whole is not None)) & full
        down = (down << 1) & full
        plus = down | (full & ~(diagonal | up))
        minus = up & diagonal
        if score < best[0]:
            best = (score, j + 1)
            if score == whole:
                break
    return best


def symbols(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte of each code point, and its bytes as one number."""
    at = np.flatnonzero((data & 0xC0) != 0x80)
    if len(at) == len(data):
        return at, data.astype(np.uint32)
    four = np.ndarray((len(data),), "<u4", np.append(data, np.zeros(3, np.uint8)), strides=(1,))
    return at, four[at] & _MASK[np.minimum(np.diff(np.append(at, len(data))), 4)]


def _gram_slots(symbol: np.ndarray, size: int, bits: int) -> np.ndarray:
    """Hash of the ``size`` symbols from each place on."""
    n = max(0, len(symbol) - size + 1)
    total = np.zeros(n, np.uint32)
    for i in range(size):
        total = total * np.uint32(0x01000193) + symbol[i : i + n] + np.uint32(1)
    return (total ^ (total >> np.uint32(15))) * np.uint32(0x85EBCA6B) >> np.uint32(32 - bits)


def _letters(symbol: np.ndarray) -> np.ndarray:
    """Symbols as 256 letters: ASCII keeps its own, others may share one."""
    return ((symbol ^ (symbol >> np.uint32(9)) ^ (symbol >> np.uint32(18))) & np.uint32(0xFF)).astype(np.int64)


class Segments:
    """Segments of items, found wherever they occur within their numbers of edits."""

    def __init__(self, parts: list[tuple[int, int, np.ndarray, int]]):
        """``parts``: item, place in the item, symbols, edits."""
        self.item, self.place, self.most = (np.array([p[k] for p in parts], np.int64) for k in (0, 1, 3))
        self.size = np.array([len(p[2]) for p in parts], np.int64)
        self.equal = np.zeros((len(parts), 256), np.uint64)
        for i, (_, _, symbol, _) in enumerate(parts):
            np.bitwise_or.at(self.equal[i], _letters(symbol), np.uint64(1) << np.arange(len(symbol), dtype=np.uint64))
        # Pieces of four characters are rarer, but of a short segment they leave too few to count, or none.
        four, three = self.size // 4 - self.most, self.size // 3 - self.most
        length = np.select([four >= 3, three >= 2, four >= 1, three >= 1], [4, 3, 4, 3], 2)
        self.enough = self.size // length - self.most
        self.tables = []
        for q in (2, 3, 4):
            own = np.flatnonzero(length == q)
            if not len(own):
                continue
            n = self.size[own] // q
            bits = int(np.clip(np.ceil(np.log2(8 * n.sum())), 12, 24))
            slots = np.concatenate([_gram_slots(parts[i][2], q, bits)[: k * q : q] for i, k in zip(own.tolist(), n.tolist(), strict=True)])
            order = np.argsort(slots, kind="stable")
            number = np.bincount(slots, minlength=1 << bits)
            seg = np.repeat(np.arange(len(own)), n)[order]
            places = np.concatenate([np.arange(k) * q for k in n.tolist()])[order]
            step = max(512, min(_AT_ONCE, 16 * _CELLS // len(own))) // 16 * 16
            # A segment and a diagonal are one number, a row of cells of 16 diagonals for each segment.
            row = step + 4 * SEGMENT
            lead = (seg * row + SEGMENT - places).astype(np.int32)
            self.tables.append((q, bits, own, step, row, number.astype(np.int32), (np.cumsum(number) - number).astype(np.int32), lead))

    def find(self, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(segment, diagonal) of places that hold a segment within its edits; the passage's own diagonals are as near as its edits, or 7 more."""
        found = [np.zeros(0, np.int64)]
        for q, bits, own, step, row, number, first, lead in self.tables:
            slots = _gram_slots(symbol, q, bits)
            enough, most = self.enough[own], self.most[own]
            spans = [(a, min(a + step + 2 * SEGMENT, len(slots))) for a in range(0, len(slots), step)]
            while spans:
                a, b = spans.pop()
                slot = slots[a:b]
                n = number[slot]
                some = np.flatnonzero(n)
                slot, n = slot[some], n[some]
                upto = np.cumsum(n, dtype=np.int32)
                total = int(upto[-1]) if len(upto) else 0
                if total > _HITS and b - a > 6 * SEGMENT:  # both halves hold what spans their border
                    half = (a + b) // 2
                    spans += [(a, half + SEGMENT), (half - SEGMENT, b)]
                    continue
                key = lead[np.repeat(first[slot] - (upto - n), n) + np.arange(total, dtype=np.int32)]
                key += np.repeat(some.astype(np.int32), n)
                # A segment's pieces lie on diagonals no further apart than its edits, fewer than 16: in two cells side by side.
                cell = key >> 4
                counts = np.bincount(cell, minlength=len(own) * row // 16).astype(np.int16).reshape(-1, row // 16)
                pair = counts[:, :-1] + counts[:, 1:] >= enough[:, None].astype(np.int16)
                flag = np.zeros(counts.shape, bool)
                flag[:, :-1] = pair
                flag[:, 1:] |= pair
                key = np.sort(key[flag.ravel()[cell]])
                of = key // row
                last = np.arange(len(key)) + enough[of] - 1
                good = (last < len(key)) & (key[np.minimum(last, len(key) - 1)] - key <= most[of])
                key, of = key[good], of[good]
                # One of eight neighbours stands for them.
                found.append((own[of] << 40) + ((key - of * row + (a + SEGMENT)) >> 3))
        key = np.sort(np.concatenate(found))
        key = key[np.append(True, key[1:] != key[:-1])] if len(key) else key
        of, diagonal = key >> 40, ((key & ((1 << 40) - 1)) << 3) - 2 * SEGMENT
        letters = padded(_letters(symbol).astype(np.uint8))
        near = [self._near(letters, of[i : i + _LANES], diagonal[i : i + _LANES]) for i in range(0, len(of), _LANES)]
        near = np.concatenate(near) if near else np.zeros(0, bool)
        return of[near], diagonal[near]

    def _near(self, letters: np.ndarray, of: np.ndarray, diagonal: np.ndarray) -> np.ndarray:
        """Whether the segment is within its edits about the diagonal."""
        most, size = self.most[of], self.size[of]
        return near(letters, diagonal - most + 4 * SEGMENT, self.equal, of, size, most, int((size + 2 * most).max()) + 8)


def near(letters: np.ndarray, at: np.ndarray, equal: np.ndarray, of: np.ndarray, size: np.ndarray, most: np.ndarray, columns: int) -> np.ndarray:
    """Whether the pattern ``of`` of each lane ends within its edits among the letters from ``at`` on: the columns of ``_search``, for all lanes at once."""
    rows, equal = of * 256, equal.ravel()
    word = equal.dtype.type
    top, one = (size - 1).astype(word), word(1)
    plus, minus = np.full(len(of), ~word(0)), np.zeros(len(of), word)
    score = size.astype(word)
    best = score.copy()
    across, up, bit = (np.empty_like(plus) for _ in range(3))
    for j in range(columns):
        eq = equal[rows + letters[at + j]]
        np.bitwise_and(eq, plus, out=across)
        across += plus
        across ^= plus
        across |= eq
        across |= minus
        np.bitwise_or(across, plus, out=up)
        np.invert(up, out=up)
        up |= minus
        plus &= across  # now those that go down
        np.right_shift(up, top, out=bit)
        bit &= one
        score += bit
        np.right_shift(plus, top, out=bit)
        bit &= one
        score -= bit
        up <<= one
        plus <<= one
        np.bitwise_and(up, across, out=minus)
        across |= up
        np.invert(across, out=across)
        plus |= across
        np.minimum(best, score, out=best)
    return best <= most.astype(word)


def segments(item: int, text: str, share: float = MAX_SHARE) -> list[tuple[int, int, np.ndarray, int]]:
    """Segments of about equal size with numbers of edits of which one holds if the item is within its own."""
    _, symbol = symbols(np.frombuffer(text.encode(), np.uint8))
    n = -(-len(symbol) // SEGMENT)
    bounds = np.arange(n + 1) * len(symbol) // n
    # If each segment had one edit more than it may, there were more than the item may have.
    edits = np.diff(np.arange(n + 1) * (int(len(symbol) * share) + 1) // n) - 1
    return [(item, a, symbol[a:b], e) for a, b, e in zip(bounds[:-1].tolist(), bounds[1:].tolist(), edits.tolist(), strict=True) if e >= 0]


def padded(letters: np.ndarray) -> np.ndarray:
    """Letters with room on both sides for searches that reach beyond."""
    return np.concatenate([np.zeros(4 * SEGMENT, np.uint8), letters, np.zeros(4 * SEGMENT + PER_SYMBOL * SYMBOLS[-1], np.uint8)])


class Windows:
    """Keys of the windows of items, looked up for those of documents."""

    def __init__(self, symbols_of: list[np.ndarray], repeats: np.ndarray, starts: list[np.ndarray], sampled: int):
        """``starts`` are the windows of each item, of which the first ``repeats`` repetitions are kept."""
        self.sampled, self.repeats = sampled, int(repeats.max(initial=0))
        self.size = np.array([len(x) for x in symbols_of], np.int64)
        self.first = np.cumsum(self.size) - self.size
        self.letters = _letters(np.concatenate([*symbols_of, np.zeros(PER_SYMBOL * SYMBOLS[-1], np.uint32)])).astype(np.uint8)
        item = np.repeat(np.arange(len(starts)), [len(x) for x in starts])
        place = np.concatenate([np.zeros(0, np.int64), *starts])
        self.bits = int(np.clip(np.ceil(np.log2(max(1, len(place)))) + 7, 12, 26))
        self.tables, self.maps = [], []
        keys = [[np.zeros(0, np.uint64)] for _ in range(self.repeats)]
        for r, _, key, _ in window_keys(self.letters, self.first[item] + place, self.repeats, sampled):
            keys[r].append(key)
        for r in range(self.repeats):
            key = np.concatenate(keys[r])
            own = repeats[item] > r
            order = np.flatnonzero(own)[np.argsort(key[own], kind="stable")]
            present = np.zeros(1 << self.bits, bool)
            present[self._slot(key[order])] = True
            self.tables.append(np.packbits(present, bitorder="little"))
            self.maps.append((key[order], item[order].astype(np.int32), place[order].astype(np.int32)))

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return (key * _SPREAD >> np.uint64(64 - self.bits)).astype(np.int64)

    def meetings(self, letters: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(repetition, place in the letters, item, place in the item) of windows that share a key and have the item's next letters nearby."""
        found = [(np.zeros(0, np.int64),) * 4]
        for r, first, key, symbols_of in window_keys(letters[4 * SEGMENT :], starts, self.repeats, self.sampled):
            slot = self._slot(key)
            hit = np.flatnonzero(self.tables[r][slot >> 3] >> (slot & 7).astype(np.uint8) & 1)
            keys, item, place = self.maps[r]
            low = np.searchsorted(keys, key[hit], "left")
            n = np.searchsorted(keys, key[hit], "right") - low
            at = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
            hit = np.repeat(hit, n)
            # The distance of the walks is known whole, not only where it was sampled.
            walks = embed(self.letters, self.first[item[at]] + place[at], walk_bits(r // PER_WALK, PER_SYMBOL * self.sampled))
            close = (walks == symbols_of[:, hit]).mean(axis=0) >= AGREEING
            at, hit = at[close], hit[close]
            found.append((np.full(len(at), r), starts[first + hit], item[at], place[at]))
        repeat, start, item, place = (np.concatenate(c).astype(np.int64) for c in zip(*found, strict=True))
        # Meetings of one diagonal and stretch of an item are looked at once.
        head = np.minimum(place // 16 * 16, np.maximum(0, self.size[item] - SEGMENT))
        diagonal = start - place + head
        stretch = (self.first[item] + head) << 36 | (diagonal + (1 << 34)) >> 2
        _, one, back = np.unique(stretch, return_index=True, return_inverse=True)
        good = np.zeros(len(one), bool)
        for i in range(0, len(one), _LANES):
            lanes = one[i : i + _LANES]
            for word in (np.uint32, np.uint64):
                lanes = lanes[self._next_letters(letters, item[lanes], head[lanes], diagonal[lanes], word)]
            good[i : i + _LANES] = np.isin(one[i : i + _LANES], lanes)
        kept = good[back]
        return repeat[kept], start[kept], item[kept], place[kept]

    def _next_letters(self, letters: np.ndarray, item: np.ndarray, head: np.ndarray, diagonal: np.ndarray, word: type) -> np.ndarray:
        """Whether as many of the item's letters as a word has bits are near."""
        if not len(item):
            return np.zeros(0, bool)
        place = self.first[item] + head
        heads, of = np.unique(place, return_inverse=True)
        size = np.minimum(self.size[item] - head, 8 * word().itemsize)
        length = np.zeros(len(heads), np.int64)
        length[of] = size
        equal = np.zeros((len(heads), 256), word)
        pattern = np.repeat(np.arange(len(heads)), length)
        bit = np.arange(len(pattern)) - np.repeat(np.cumsum(length) - length, length)
        np.bitwise_or.at(equal, (pattern, self.letters[heads[pattern] + bit]), word(1) << bit.astype(word))
        most = (size * LOCAL_SHARE).astype(np.int64)
        return near(letters, diagonal - _DRIFT + 4 * SEGMENT, equal, of, size, most, int(size.max()) + 2 * _DRIFT + 4)


def edited(symbol: np.ndarray, share: float, seed: int) -> np.ndarray:
    """A copy with as many random edits as the share allows: letters lost, changed and added alike."""
    draw = np.random.default_rng(seed)
    places = draw.integers(0, len(symbol), int(len(symbol) * share))
    kind, other = draw.integers(0, 3, len(places)), symbol[draw.integers(0, len(symbol), len(places))]
    out = symbol.copy()
    out[places[kind == 1]] = other[kind == 1]
    n = np.ones(len(symbol), np.int64)
    n[places[kind == 0]] = 0
    np.add.at(n, places[kind == 2], 1)
    out = np.repeat(out, n)
    # Added letters stand where a letter was doubled.
    added = np.searchsorted(np.cumsum(n), places[kind == 2], "right")
    out[np.minimum(np.cumsum(n)[np.minimum(places[kind == 2], len(n) - 1)] - 1, len(out) - 1)] = other[kind == 2] if len(added) else 0
    return out


def trial_shares(symbols_of: list[np.ndarray], starts: list[np.ndarray], sampled: int, share: float, copies: int) -> np.ndarray:
    """The share of edited copies of the items found by the first 1, 2, ... MAX_REPEATS repetitions."""
    index = Windows(symbols_of, np.full(len(symbols_of), MAX_REPEATS), starts, sampled)
    found = np.zeros((copies, MAX_REPEATS), bool)
    for c in range(copies):
        i = c % len(symbols_of)
        # Between its item's neighbours, as a document would have it between other words.
        copy = np.concatenate([np.full(1, 32, np.uint32), edited(symbols_of[i], share, c), np.full(1, 32, np.uint32), symbols_of[i][:64][::-1]])
        repeat, _, item, _ = index.meetings(padded(_letters(copy).astype(np.uint8)), window_starts(copy, np.array([0, len(copy)])))
        found[c, repeat[item == i]] = True
    return np.logical_or.accumulate(found, axis=1).mean(axis=0)


class Items:
    """A block of items: keys of the windows of those sampled, segments of those counted."""

    def __init__(self, ids: list, texts: list[str], repeats: int = MAX_REPEATS, share: float = MAX_SHARE, recall: float = RECALL):
        self.share = share
        numbers: dict[str, list] = {}
        for key, text in zip(ids, texts, strict=True):
            numbers.setdefault(text, []).append(key)
        self.texts, self.ids = list(numbers), list(numbers.values())
        symbols_of = [symbols(np.frombuffer(t.encode(), np.uint8))[1] for t in self.texts]
        self.repeats, self.windows = np.zeros(len(symbols_of), np.int64), []
        for sampled, starts in self._windows(symbols_of):
            found = self._repeats(symbols_of, [s if not r else s[:0] for s, r in zip(starts, self.repeats.tolist(), strict=True)], sampled, repeats, recall)
            if found.any():
                self.windows.append(Windows(symbols_of, found, [s if r else s[:0] for s, r in zip(starts, found.tolist(), strict=True)], sampled))
            self.repeats += found
        most = [int(len(x) * share) for x in symbols_of]
        self.plain = [(i, t.encode()) for i, t in enumerate(self.texts) if not most[i]]
        parts = [x for i in np.flatnonzero(self.repeats == 0).tolist() if most[i] for x in segments(i, self.texts[i], share)]
        self.segments = [Segments(parts[i : i + SEGMENTS]) for i in range(0, len(parts), SEGMENTS)]

    def _windows(self, symbols_of: list[np.ndarray]) -> Iterator[tuple[int, list[np.ndarray]]]:
        """(symbols of a key, windows of each item): first the least number at which a window meets those of few other items, then fewer, for shorter items."""
        for i, sampled in enumerate(SYMBOLS):
            starts, meets = self._usable(symbols_of, sampled)
            if i and meets <= CHANCE:
                break
        yield sampled, starts
        for fewer in SYMBOLS[:i][:2][::-1]:
            yield fewer, self._usable(symbols_of, fewer)[0]

    @staticmethod
    def _usable(symbols_of: list[np.ndarray], sampled: int) -> tuple[list[np.ndarray], float]:
        """Windows with a walk's length before the item's end, and how many windows of other items one meets.

        Windows that more than SHARED items have, as items made by one template do, tell nothing and are left out.
        """
        letters = _letters(np.concatenate([*symbols_of, np.zeros(PER_SYMBOL * SYMBOLS[-1], np.uint32)])).astype(np.uint8)
        size = np.array([len(x) for x in symbols_of], np.int64)
        begins = [window_starts(x, np.array([0, len(x)])) for x in symbols_of]
        begins = [b[b + PER_SYMBOL * sampled <= n] for b, n in zip(begins, size.tolist(), strict=True)]
        of = np.repeat(np.arange(len(begins)), [len(b) for b in begins])
        if not len(of):
            return begins, 0.0
        at = np.concatenate(begins)
        keys = np.concatenate([key for _, _, key, _ in window_keys(letters, (np.cumsum(size) - size)[of] + at, 1, sampled)])
        _, kind = np.unique(keys, return_inverse=True)
        _, one = np.unique(kind * (len(size) + 1) + of, return_index=True)
        n = np.bincount(kind[one])
        kept = n[kind] <= SHARED
        n = n[n <= SHARED]
        return np.split(at[kept], np.searchsorted(of[kept], np.arange(1, len(size)))), float((n * (n - 1)).sum() / max(1, n.sum()))

    def _repeats(self, symbols_of: list[np.ndarray], starts: list[np.ndarray], sampled: int, most: int, recall: float) -> np.ndarray:
        """Repetitions of each item, found by trial for each class; 0 for those that are counted."""
        out = np.zeros(len(starts), np.int64)
        level = np.array([len(s).bit_length() for s in starts], np.int64)
        for k in np.unique(level[level > 0]).tolist():
            own = np.flatnonzero(level == k)
            some = own[np.linspace(0, len(own) - 1, min(len(own), TRIALS)).astype(int)].tolist()
            length = sum(len(symbols_of[i]) for i in some) / len(some)
            copies = int(np.clip(TRIAL_CHARS / length, 8, TRIALS))
            some = some[:copies]
            shares = trial_shares([symbols_of[i] for i in some], [starts[i] for i in some], sampled, self.share, copies)
            enough = np.flatnonzero(shares[:most] >= recall)
            out[own] = enough[0] + 1 if len(enough) else 0
        return out

    def candidates(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(row, byte of the window, item, character of the item's window), a row for each meeting."""
        found = [(np.zeros(0, np.int64),) * 3]
        raw = data.tobytes() if self.plain else b""
        for item, wanted in self.plain:
            at = raw.find(wanted)
            while at >= 0:
                found.append((np.array([at]), np.array([item]), np.array([0])))
                at = raw.find(wanted, at + 1)
        if len(data) and (self.segments or self.windows):
            at, symbol = symbols(data)
            rows = np.searchsorted(at, offsets)
            letters, begins = padded(_letters(symbol).astype(np.uint8)), window_starts(symbol, rows[rows < len(symbol)])
            for index in self.windows:
                _, start, item, place = index.meetings(letters, begins)
                found.append((at[start], item, place))
            found += [self._placed(s, at, symbol, rows) for s in self.segments]
        start, item, place = (np.concatenate(c) for c in zip(*found, strict=True))
        return owners(start, offsets), start, item, place

    def _placed(self, counted: Segments, at: np.ndarray, symbol: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(byte, item, character of the item there) of the places of segments, for each row they reach into."""
        of, diagonal = counted.find(symbol)
        low, high = (np.clip(x, 0, len(at) - 1) for x in (diagonal - SEGMENT, diagonal + 2 * SEGMENT))
        first = owners(low, rows)
        n = owners(high, rows) - first + 1
        of, diagonal = np.repeat(of, n), np.repeat(diagonal, n)
        row = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
        full = rows[row + 1] > rows[row]
        of, diagonal, row = of[full], diagonal[full], row[full]
        inside = np.clip(diagonal, rows[row], rows[row + 1] - 1)
        return at[inside], counted.item[of], inside - diagonal + counted.place[of]

    def passages(self, text: str, windows: np.ndarray, items: np.ndarray, places: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(item, start, end, distance) of verified passages of a text; candidates whose passages may overlap are verified together."""
        for item in np.unique(items).tolist():
            pattern = self.texts[item]
            most = int(len(pattern) * self.share)
            own = items == item
            begin = np.unique(windows[own] - places[own])
            # A candidate's passage may begin so many characters before or after where its window says.
            slack = 2 * most + 8
            for part in np.split(begin, np.flatnonzero(np.diff(begin) > slack) + 1):
                lo, hi = max(0, int(part[0]) - slack), min(len(text), int(part[-1]) + len(pattern) + slack)
                for start, end, edits in _within(text, lo, hi, pattern, most):
                    yield item, start, end, edits


def _within(text: str, lo: int, hi: int, pattern: str, most: int) -> list[tuple[int, int, int]]:
    """(start, end, distance) of passages between two places, one after the other."""
    if hi - lo < len(pattern) - most or not (found := distance(text[lo:hi], pattern, most)):
        return []
    edits, start, end = found[0], lo + found[1], lo + found[2]
    return [*_within(text, lo, start, pattern, most), (start, end, edits), *_within(text, end, hi, pattern, most)]


def _blocks(items: DataFrame, key: str, text: str) -> Iterator[tuple[list, list[str]]]:
    """Items block by block; the driver holds one block at a time."""
    ids, texts, size = [], [], 0
    for r in items.select(F.col(key), F.trim(F.col(text))).where(F.length(F.trim(F.col(text))) > 0).orderBy(key, text).toLocalIterator():
        if ids and (len(ids) >= BLOCK_ITEMS or size + len(r[1]) > BLOCK_CHARS):
            yield ids, texts
            ids, texts, size = [], [], 0
        ids.append(r[0])
        texts.append(r[1])
        size += len(r[1])
    if ids:
        yield ids, texts


def find_passages(
    docs: DataFrame, items: DataFrame, text: str = "text", key: str = "doc_id", item_key: str = "item_id", item_text: str = "text",
    share: float = MAX_SHARE, recall: float = RECALL,
) -> DataFrame:
    """(key, item, start, end, distance): passages (code points, end exclusive) within ``share`` edits per character of an item."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = to_arrow_type(items.schema[item_key].dataType)
    schema = f"key {dict(docs.dtypes)[key]}, item {dict(items.dtypes)[item_key]}, start long, `end` long, distance long"
    out = None
    for ids, texts in _blocks(items, item_key, item_text):
        shared = docs.sparkSession.sparkContext.broadcast(Items(ids, texts, MAX_REPEATS, share, recall))
        found = rows.mapInArrow(_scan(shared, kind), schema)
        out = found if out is None else out.unionByName(found)
    return out if out is not None else docs.sparkSession.createDataFrame([], schema)


def drop_contaminated(
    docs: DataFrame, items: DataFrame, text: str = "text", item_key: str = "item_id", item_text: str = "text",
    share: float = MAX_SHARE, recall: float = RECALL,
) -> DataFrame:
    """The rows, with all their columns, that hold no passage of an item; no shuffle."""
    for ids, texts in _blocks(items, item_key, item_text):
        shared = docs.sparkSession.sparkContext.broadcast(Items(ids, texts, MAX_REPEATS, share, recall))
        docs = docs.mapInArrow(_filter(shared, text), docs.schema)
    return docs


def _filter(shared, column: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in chunks(batches, column):
            kept = np.ones(rows.num_rows, bool)
            kept[[x[0] for x in _found(shared.value, data, offsets)]] = False
            yield rows.filter(pa.array(kept))

    return run


def _found(index: Items, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """(row, item, start, end, distance) of all verified passages of a chunk of texts."""
    row, window, item, place = index.candidates(data, offsets)
    found = []
    for r in np.unique(row).tolist():
        own = row == r
        part = data[offsets[r] : offsets[r + 1]]
        chars = np.cumsum((part & 0xC0) != 0x80)[window[own] - offsets[r]] - 1
        found += [(r, *x) for x in index.passages(part.tobytes().decode(), chars, item[own], place[own])]
    return found


def _scan(shared, kind: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: Items = shared.value
        for rows, data, offsets in chunks(batches, "text"):
            found = [(r, key, *numbers) for r, item, *numbers in _found(index, data, offsets) for key in index.ids[item]]
            row, item, *numbers = zip(*found, strict=True) if found else [[]] * 5
            cols = [rows.column(0).take(pa.array(row, pa.int64())), pa.array(item, kind), *(pa.array(c, pa.int64()) for c in numbers)]
            yield pa.RecordBatch.from_arrays(cols, names=["key", "item", "start", "end", "distance"])

    return run
