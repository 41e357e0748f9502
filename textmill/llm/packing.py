"""Packing of tokenised documents into training sequences by the sum-of-squares rule.

A document is its ids and an end id. Whole sequences are cut off its front; the rest is placed online, as one piece, into the open
window whose new level leaves the least sum of squared numbers of windows per level. The numbers are a level array, so a
placement is one difference of two of its slices. Squares keep the levels evenly used, so that some level fits what comes next.

Every task packs its own rows: no shuffle, and what it holds is the level array and the open windows. Where these hold HELD
ids, and at the end, the emptier windows are emptied into the gaps of the fuller ones, cutting pieces; what is left at the very end, less than
one sequence a task, becomes sequences of power-of-two lengths. So nothing is padded.

Ids come from a tokenizer whose pieces never cross white space: words apart by ASCII white space are encoded once per chunk
and gathered, which gives exactly the ids of the whole text.

Defined results: null and empty texts are the end id alone; repeated rows are packed each; rows of any length; keys of any type, null
too; an empty table gives none. Sequence ids are unique, not consecutive: the task's number in the upper bits. A task run again
gives the same pieces if its rows come in the same order, as those of a written table do.
"""

from __future__ import annotations

import json
import os
from collections import deque
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from textmill.llm.arrow import WHITE, chunks, word_bounds

SIZE = 4096
END_ID = 2
HELD = 1 << 23  # ids of open windows
_CHUNK = 1 << 23
_NONE = -(1 << 30)
_OUT_ROWS, _OUT_IDS = 4096, 1 << 21
KNOWN = 1 << 20
_BETWEEN, _JOINED = "\x00", 64
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
# Fixed value: the pattern of pre-tokens that are runs of letters, single digits and runs of signs, but for English endings after an apostrophe.
_RUNS = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
# ASCII letters, signs, and the apostrophe, which may belong to what follows.
_KIND = np.zeros(256, np.uint8)
_KIND[[*range(65, 91), *range(97, 123)]] = 1
_KIND[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = 2
_KIND[39] = 3


class Encoder:
    """Ids of many texts at once, each with the end id. Words met before are kept, KNOWN of them at most."""

    def __init__(self, definition: str, end_id: int = END_ID):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.encode_special_tokens = True
        self.end = np.uint32(end_id).tobytes()
        self.known: dict[str, bytes] = {}
        # New words go in one text, a control character between them, if that has an id of its own.
        self.between = len(self.tokenizer.encode(f" {_BETWEEN} ", add_special_tokens=False).ids) == 1
        normalizer = json.loads(definition).get("normalizer") or {}
        # Where all is lower-cased anyway, forms of a word are one word.
        self.folds = "Lowercase" in [n.get("type") for n in normalizer.get("normalizers", [normalizer])]
        self.runs = _RUNS in _patterns(json.loads(definition).get("pre_tokenizer"))
        self.letters = self._letters() if self.folds and self.runs else None

    def _letters(self):
        """The tokenizer for words of a to z, which its normaliser and its byte alphabet leave as they are."""
        from tokenizers import Tokenizer, pre_tokenizers

        plain = Tokenizer(self.tokenizer.model)
        plain.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        words = ["a", "the", "unbelievable", "zzyzx", "."]
        same = [t.encode(w, add_special_tokens=False).ids for w in words for t in (plain, self.tokenizer)]
        return plain if same[::2] == same[1::2] and len(same[-1]) == 1 else None

    def bounds(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of what is encoded by itself: words, and where pieces are runs of letters or of signs, these."""
        starts, ends = word_bounds(data, offsets)
        if not self.runs or not len(data):
            return starts, ends
        kind = _KIND[data]
        cut = 1 + np.flatnonzero(((kind[:-1] == 1) & (kind[1:] >= 2)) | ((kind[:-1] == 2) & (kind[1:] == 1)))
        return tuple(np.flatnonzero(_marked(len(data), at, cut)) for at in (starts, ends))

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids laid end to end, and n + 1 offsets into them."""
        starts, ends = self.bounds(data, offsets)
        size = ends - starts
        inside = data[~WHITE[data]]
        if self.folds:
            inside = _LOWER[inside]
        bounds = np.concatenate([[0], np.cumsum(size)])
        words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(bounds), pa.py_buffer(inside)).dictionary_encode()
        known = [*self._ids(words.dictionary.to_numpy(zero_copy_only=False).tolist()), self.end]
        length = np.fromiter(map(len, known), np.int64, len(known)) // 4
        first = np.cumsum(length) - length
        flat = np.frombuffer(b"".join(known), np.uint32)
        upto = np.searchsorted(starts, offsets)
        code = np.insert(np.asarray(words.indices), upto[1:], len(known) - 1)
        n = length[code]
        at = np.concatenate([[0], np.cumsum(n)])
        ids = flat[np.repeat(first[code] - at[:-1], n) + np.arange(at[-1])]
        return ids, at[upto + np.arange(len(upto))]

    def _ids(self, words: list[str]) -> list[bytes]:
        if len(self.known) > KNOWN:
            self.known.clear()
        new = [w for w in words if w not in self.known]
        if self.letters is not None:
            plain = [w for w in new if w.isascii() and w.isalpha()]
            self._learn(self.letters, plain, ".")
            new = [w for w in new if not (w.isascii() and w.isalpha())]
        if self.between:
            self._learn(self.tokenizer, [w for w in new if _BETWEEN not in w], _BETWEEN)
            new = [w for w in new if _BETWEEN in w]
        for word, found in zip(new, self.tokenizer.encode_batch_fast(new, add_special_tokens=False), strict=True):
            self.known[word] = np.array(found.ids, np.uint32).tobytes()
        return [self.known[w] for w in words]

    def _learn(self, tokenizer, words: list[str], between: str) -> None:
        """Ids of words, many in one text, with something between them that none of them holds."""
        if not words:
            return
        mark = tokenizer.encode(f" {between} ", add_special_tokens=False).ids[0]
        texts = [f" {between} ".join(words[i : i + _JOINED]) for i in range(0, len(words), _JOINED)]
        flat = np.concatenate([np.array(e.ids + [mark], np.uint32) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)])
        stops = 4 * np.flatnonzero(flat == mark)
        starts, raw = np.concatenate([[0], stops[:-1] + 4]), flat.tobytes()
        self.known.update(zip(words, map(raw.__getitem__, map(slice, starts.tolist(), stops.tolist())), strict=True))


def _marked(size: int, *places: np.ndarray) -> np.ndarray:
    mask = np.zeros(size + 1, bool)
    for at in places:
        mask[at] = True
    return mask


def _patterns(definition) -> list[str]:
    """Patterns of the splits of a pre-tokenizer."""
    if not definition:
        return []
    parts = definition.get("pretokenizers", [definition])
    return [p["pattern"].get("Regex") for p in parts if p.get("type") == "Split"]


# A worker keeps its encoder, and so the words of its earlier tasks.
_encoder: dict[tuple[str, int], Encoder] = {}


def encoder(definition: str, end_id: int) -> Encoder:
    name = (sha256(definition.encode()).hexdigest(), end_id)
    if name not in _encoder:
        _encoder.clear()
        _encoder[name] = Encoder(definition, end_id)
    return _encoder[name]


class Levels:
    """Numbers of open windows by the ids they hold, and the windows themselves."""

    def __init__(self, size: int):
        self.size = size
        # Twice the numbers, as levels that are reached and as levels that are left; where no window is, none can be left.
        self.reached = np.zeros(size + 1, np.int64)
        self.left = np.full(size + 1, _NONE, np.int64)
        self.reached[size], self.left[0] = -1, 1  # a full window counts no more; a new one was not counted before
        self.windows: dict[int, list] = {}

    def best(self, n: int) -> int:
        """The level that a piece of n ids goes to, 0 for a new window; of equals the fullest."""
        change = self.reached[n:] - self.left[: self.size + 1 - n]
        return len(change) - 1 - int(change[::-1].argmin())

    def take(self, level: int):
        window = self.windows[level].pop()
        self._count(level)
        return window

    def put(self, level: int, window) -> None:
        self.windows.setdefault(level, []).append(window)
        self._count(level)

    def _count(self, level: int) -> None:
        n = len(self.windows[level])
        self.reached[level] = 2 * n
        self.left[level] = 2 * n if n else _NONE

    def clear(self) -> list:
        """All open windows, fullest first."""
        out = [w for level in sorted(self.windows, reverse=True) for w in self.windows[level]]
        self.__init__(self.size)
        return out


class Window:
    __slots__ = ("number", "fill", "pieces")

    def __init__(self, number: int):
        self.number, self.fill, self.pieces = number, 0, []

    def add(self, piece: tuple) -> None:
        self.pieces.append(piece)
        self.fill += len(piece[3])


class Packer:
    """Takes documents one by one and gives finished windows. A piece is (key, tokens of its document, start, ids)."""

    def __init__(self, size: int = SIZE, held: int = HELD, first: int = 0):
        self.size, self.held, self.next = size, held, first
        self.levels, self.open_ids = Levels(size), 0

    def _window(self) -> Window:
        self.next += 1
        return Window(self.next - 1)

    def add(self, key, ids: np.ndarray) -> Iterator[Window]:
        rest = len(ids) // self.size * self.size
        for start in range(0, rest, self.size):
            window = self._window()
            window.add((key, len(ids), start, ids[start : start + self.size]))
            yield window
        if rest == len(ids):
            return
        piece = (key, len(ids), rest, ids[rest:].copy())
        level = self.levels.best(len(piece[3]))
        window = self.levels.take(level) if level else self._window()
        window.add(piece)
        if window.fill == self.size:
            self.open_ids -= level
            yield window
            return
        self.levels.put(window.fill, window)
        self.open_ids += len(piece[3])
        if self.open_ids > self.held:
            *full, last = self._level_out()
            yield from full
            self.levels.put(last.fill, last) if last.fill < self.size else (yield last)
            self.open_ids = last.fill % self.size

    def _level_out(self) -> Iterator[Window]:
        """Open windows, the gaps of the fuller filled from the emptier: all are full but the last."""
        rows = deque(self.levels.clear())
        while rows:
            window = rows.popleft()
            while window.fill < self.size and rows:
                giver, gap = rows[-1], self.size - window.fill
                key, total, start, ids = giver.pieces.pop()
                giver.fill -= len(ids)
                window.add((key, total, start, ids[:gap]))
                if len(ids) > gap:
                    giver.add((key, total, start + gap, ids[gap:]))
                if not giver.fill:
                    rows.pop()
            yield window

    def finish(self) -> Iterator[Window]:
        """The rest: full windows, then windows of power-of-two lengths."""
        for window in self._level_out():
            if window.fill == self.size:
                yield window
                continue
            pieces, left = deque(window.pieces), window.fill
            part = Window(window.number)
            while left:
                room = 1 << left.bit_length() - 1
                while part.fill < room:
                    key, total, start, ids = pieces.popleft()
                    gap = room - part.fill
                    part.add((key, total, start, ids[:gap]))
                    if len(ids) > gap:
                        pieces.appendleft((key, total, start + gap, ids[gap:]))
                yield part
                left -= room
                part = self._window() if left else part


def pack(docs: DataFrame, definition: str, text: str = "text", key: str = "doc_id", size: int = SIZE, end_id: int = END_ID, held: int = HELD) -> DataFrame:
    """(key, start, length, ids, doc_tokens, sequence_id, offset): the pieces of all documents; ids are little-endian unsigned 32-bit numbers.

    ``definition`` is the tokenizer's JSON text, a few megabytes, sent to each executor once.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = to_arrow_type(rows.schema["key"].dataType)
    shared = docs.sparkSession.sparkContext.broadcast(definition)
    schema = f"key {rows.schema['key'].dataType.simpleString()}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    return rows.mapInArrow(_pack(shared, kind, size, end_id, held), schema)


def _pack(shared, kind: pa.DataType, size: int, end_id: int, held: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        packer = Packer(size, held, (context.partitionId() if context else 0) << 40)
        yield from _batches(_windows(batches, packer, encoder(shared.value, end_id)), kind)

    return run


def _windows(batches: Iterator[pa.RecordBatch], packer: Packer, encode: Encoder) -> Iterator[Window]:
    for rows, data, offsets in chunks(batches, "text", _CHUNK):
        ids, at = encode(data, offsets)
        for i, key in enumerate(rows.column(0).to_pylist()):
            yield from packer.add(key, ids[at[i] : at[i + 1]])
    yield from packer.finish()


def _batches(windows: Iterator[Window], kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    out, held = [], 0
    for window in windows:
        offset = 0
        for key, total, start, ids in window.pieces:
            out.append((key, start, len(ids), ids.astype("<u4").tobytes(), total, window.number, offset))
            offset += len(ids)
        held += window.fill
        if len(out) >= _OUT_ROWS or held >= _OUT_IDS:
            yield _batch(out, kind)
            out, held = [], 0
    if out:
        yield _batch(out, kind)


def _batch(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    types = [kind, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
    names = ["key", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)
