"""Incremental training of byte-pair merges: rows are cut down to what the next merges can touch, and only what a merge changes is counted.

The state is a table of rows, each the ids of a text. A pair less frequent than a merge cannot be crossed by it: whatever stands on both
sides later, it meets no more often than the pair did. So training goes in phases. A phase counts all pairs, takes those that are at least
a quarter as frequent as the first for hot, and cuts the rows where a pair is not hot. What remains are short runs, most of them
met often: a table of the different ones with their number and first place. Merges down to that frequency are found
in this table alone, and are then applied to the rows at once. Phases grow with the logarithm of the frequencies, and the table of runs
with the number of different runs.

A pass over the runs is one job. It brings them up to date with the merges since they were last written, applies the next ones, and
counts only the pairs about the merged places: those that went, less than nothing, and those that came. The driver holds the number
of each pair of the runs, bounded by the square of the vocabulary, adds the changes, and finds the next merges in it. Of equal pairs the one met first
is next, so a pass also tells where the leading pairs and those with new ids first occur; a row order and a byte of a row name a place, and
neither moves when tokens merge.

Within a pass a slice of rows is one flat array with a border between rows, which no pair crosses.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.session import cut_lineage

BORDER = 0xFFFF  # no id: between rows
SLICE = 1 << 21  # bytes of rows worked on at once
HELD = 1 << 25  # bytes of different runs that a task gathers before it gives them out
HOT_SHARE = 4  # a phase makes the merges down to this part of its first one's frequency
LEADING = 512  # pairs whose first places a pass tells, and all as frequent as the last of them
MERGES_PER_WRITE = 96  # merges after which the rows are written anew
_BLOCK = 1 << 16  # tokens looked through at once for first places
DENSE = 1 << 21  # pairs of so few ids are counted in one array

Merge = tuple[int, int, int]  # left, right, product


def ids_of_text(df: DataFrame, text: str, order: str) -> DataFrame:
    """(order, ids): the bytes of each text; empty and null texts are left out."""
    return df.select(order, F.encode(text, "UTF-8").alias("ids")).filter(F.length("ids") > 0)


def slices(batch: pa.RecordBatch, keys: Sequence[str] = (), column: str = "ids") -> Iterator[pa.RecordBatch]:
    """Parts of SLICE bytes of a column, in the order of the keys. A longer row is a part of its own; no more than a part is copied."""
    if keys:
        order = pc.sort_indices(batch, sort_keys=[(k, "ascending") for k in keys])
        size = pc.binary_length(batch[column]).take(order)
    else:
        order, size = None, pc.binary_length(batch[column])
    size = pc.fill_null(size, 0).to_numpy(zero_copy_only=False).astype(np.int64).cumsum()
    at = 0
    while at < batch.num_rows:
        stop = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + SLICE, "right")))
        yield batch.slice(at, stop - at) if order is None else batch.take(order[at:stop])
        at = stop


def flat_ids(column: pa.Array, kind: type = np.uint16) -> np.ndarray:
    """Rows laid end to end, a border before each and after the last."""
    border = np.uint16(BORDER).tobytes()
    rows = column.to_pylist() if kind is np.uint16 else (np.frombuffer(x, kind).astype(np.uint16).tobytes() for x in column.to_pylist())
    return np.frombuffer(border + b"".join(x + border for x in rows), np.uint16)


def places_of(ids: np.ndarray, left: int, right: int) -> np.ndarray:
    """Where the pair is merged: from the left, no token twice."""
    at = np.flatnonzero((ids[:-1] == left) & (ids[1:] == right))
    if left == right and len(at):
        # In a run of one token every second pair overlaps the one before.
        begins = np.append(True, np.diff(at) > 1)
        first = np.flatnonzero(begins)
        at = at[(np.arange(len(at)) - first[np.cumsum(begins) - 1]) % 2 == 0]
    return at


def _keys(ids: np.ndarray, at: np.ndarray | None = None) -> np.ndarray:
    """Pairs that begin at places (at all), as one number; those with a border are left out."""
    a, b = (ids[:-1], ids[1:]) if at is None else (ids[at], ids[at + 1])
    inner = (a != BORDER) & (b != BORDER)
    return (a[inner].astype(np.uint32) << np.uint32(16)) | b[inner]


def _inner(ids: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether no border is in the pair that begins at each place."""
    return (ids[at] != BORDER) & (ids[at + 1] != BORDER)


def _about(size: int, *places: np.ndarray) -> np.ndarray:
    """Places in order, each once."""
    mask = np.zeros(size, bool)
    for at in places:
        mask[at] = True
    return np.flatnonzero(mask)


def _merged(ids: np.ndarray, step: Merge) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
    """(ids after the merge, places kept, places merged, places of pairs that went, that came); None where there is none."""
    left, right, product = step
    at = places_of(ids, left, right)
    if not len(at):
        return None
    gone = _about(len(ids), at - 1, at, at + 1)
    kept = np.ones(len(ids), bool)
    kept[at + 1] = False
    after = ids.copy()
    after[at] = product
    after = after[kept]
    new = at - np.arange(len(at))
    return after, kept, at, gone, _about(len(after), new - 1, new)


def merge(ids: np.ndarray, step: Merge) -> tuple[np.ndarray, int, np.ndarray, np.ndarray]:
    """(ids after the merge, places merged, pairs that went, pairs that came)."""
    done = _merged(ids, step)
    if done is None:
        none = np.zeros(0, np.int64)
        return ids, 0, none, none
    after, _, at, gone, came = done
    return after, len(at), _keys(ids, gone), _keys(after, came)


def commuting(steps: Sequence[Merge]) -> list[list[Merge]]:
    """Merges in turn, put into groups whose places never overlap: each group can be done in one sweep. A token with itself is a group of its own."""
    groups: list[list[Merge]] = []
    begins, ends, products = set(), set(), set()
    for step in steps:
        left, right, product = step
        if not groups or left == right or begins & ends or left in ends or right in begins or left in products or right in products:
            groups.append([])
            begins, ends, products = set(), set(), set()
        groups[-1].append(step)
        begins.add(left)
        ends.add(right)
        products.add(product)
    return groups


def merge_group(ids: np.ndarray, group: Sequence[Merge]) -> np.ndarray:
    """The ids after a group of merges whose places never overlap."""
    if len(group) == 1:
        at = places_of(ids, *group[0][:2])
        product: np.ndarray | int = group[0][2]
    else:
        # Numbers of the lefts and rights of the group from 1 on, 0 for every other id.
        codes = np.zeros((2, BORDER + 1), np.uint16)
        sides = [{x: i for i, x in enumerate(dict.fromkeys(step[k] for step in group), 1)} for k in (0, 1)]
        for side, known in enumerate(sides):
            codes[side, list(known)] = list(known.values())
        table = np.zeros((len(sides[0]) + 1, len(sides[1]) + 1), np.uint16)
        for left, right, out in reversed(group):
            table[sides[0][left], sides[1][right]] = out
        at = np.flatnonzero(codes[0][ids[:-1]])
        found = table[codes[0][ids[at]], codes[1][ids[at + 1]]]
        at, product = at[found > 0], found[found > 0]
    if not len(at):
        return ids
    after = ids.copy()
    after[at] = product
    kept = np.ones(len(ids), bool)
    kept[at + 1] = False
    return after[kept]


class Changes:
    """Sums of changes by pair."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, keys: np.ndarray, sign: int, times: np.ndarray | None = None) -> None:
        """Each key once, or as often as ``times`` says."""
        if len(keys):
            if times is None:
                pairs, n = np.unique(keys, return_counts=True)
            else:
                pairs, at = np.unique(keys, return_inverse=True)
                n = np.zeros(len(pairs), np.int64)
                np.add.at(n, at, times)
            self.put(pairs.astype(np.int64), sign * n)

    def put(self, pairs: np.ndarray, n: np.ndarray) -> None:
        self.parts.append((pairs, n))
        self.size += len(pairs)
        if self.size > 1 << 20:
            self.parts = [self.sums()]
            self.size = len(self.parts[0][0])

    def sums(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        pairs, at = np.unique(np.concatenate([p for p, _ in self.parts]), return_inverse=True)
        n = np.zeros(len(pairs), np.int64)
        np.add.at(n, at, np.concatenate([x for _, x in self.parts]))
        return pairs[n != 0], n[n != 0]


class PairCounts:
    """Neighbour pairs of flat ids by number: few ids in one array, many as sums by pair."""

    def __init__(self) -> None:
        self.dense, self.width, self.rest = np.zeros(0, np.int64), 0, Changes()

    def add(self, ids: np.ndarray) -> None:
        inner = ids != BORDER
        width = int(ids.max(initial=0, where=inner)) + 1
        if (width + 1) ** 2 > DENSE:
            self.rest.add(_keys(ids), 1)
            return
        if width > self.width:
            wider = np.zeros((width + 1, width + 1), np.int64)
            wider[: self.width, : self.width] = self.dense.reshape(self.width + 1, -1)[: self.width, : self.width] if self.width else 0
            self.dense, self.width = wider.reshape(-1), width
        # A border counts as an id of its own, which is left out in the end.
        low = np.minimum(ids, self.width).astype(np.int32)
        n = np.bincount(low[:-1] * np.int32(self.width + 1) + low[1:], minlength=len(self.dense))
        self.dense += n

    def sums(self) -> tuple[np.ndarray, np.ndarray]:
        at = np.flatnonzero(self.dense)
        a, b = np.divmod(at, self.width + 1)
        inner = (a < self.width) & (b < self.width)
        self.rest.put((a[inner] << 16) | b[inner], self.dense[at[inner]])
        self.dense, self.width = np.zeros(0, np.int64), 0
        return self.rest.sums()


def _count_all(kind: type):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = PairCounts()
        for batch in batches:
            for part in slices(batch):
                counts.add(flat_ids(part["ids"], kind))
        pairs, n = counts.sums()
        yield pa.RecordBatch.from_arrays([pa.array(pairs, pa.int64()), pa.array(n, pa.int64())], names=["pair", "n"])

    return run


def hot_places(ids: np.ndarray, hot: np.ndarray) -> np.ndarray:
    """Whether the pair that begins at each place but the last is one of ``hot``, which is sorted."""
    width = int((hot & 0xFFFF).max(initial=0)), int((hot >> 16).max(initial=0))
    width = max(width) + 1
    if (width + 1) ** 2 <= 8 * DENSE:
        table = np.zeros((width + 1) ** 2, bool)
        table[(hot >> 16) * (width + 1) + (hot & 0xFFFF)] = True
        low = np.minimum(ids, width).astype(np.int32)
        return table[low[:-1] * np.int32(width + 1) + low[1:]]
    begins = np.zeros(BORDER + 1, bool)
    begins[hot >> 16] = True
    at = np.flatnonzero(begins[ids[:-1]])
    key = (ids[at].astype(np.int64) << 16) | ids[at + 1]
    out = np.zeros(len(ids) - 1, bool)
    out[at] = hot[np.minimum(np.searchsorted(hot, key), len(hot) - 1)] == key
    return out


def _each_once(parts: Sequence[pa.RecordBatch], order: str) -> pa.RecordBatch:
    """Runs of several slices put together: the sum of their numbers, the first of their places."""
    rows = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
    coded = rows["ids"].dictionary_encode()
    index = coded.indices.to_numpy()
    places = pc.sort_indices(rows, sort_keys=[(order, "ascending"), ("at", "ascending")], null_placement="at_start").to_numpy()
    first, n = np.zeros(len(coded.dictionary), np.int64), np.zeros(len(coded.dictionary), np.int64)
    first[index[places[::-1]]] = places[::-1]
    np.add.at(n, index, rows["n"].to_numpy())
    met = rows.take(pa.array(first))
    return pa.RecordBatch.from_arrays([met[order], met["at"], pa.array(n), coded.dictionary], names=rows.schema.names)


def _hot_runs(hot: np.ndarray, lengths: np.ndarray, kind: type, order: str):
    """The Arrow pass that gives the different runs of hot pairs with their number and first place, each once per HELD bytes of them."""

    def of_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, [order]):
                ids = flat_ids(part["ids"], kind)
                inside = hot_places(ids, hot)
                edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
                begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) + 1
                if not len(begin):
                    continue
                kept = np.zeros(len(ids), bool)
                kept[:-1] = inside
                kept[1:] |= inside
                offsets = np.concatenate([[0], np.cumsum(end - begin)]) * ids.itemsize
                texts = pa.Array.from_buffers(pa.binary(), len(begin), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(ids[kept])])
                coded = texts.dictionary_encode()
                index = coded.indices.to_numpy()
                first = np.zeros(len(coded.dictionary), np.int64)
                first[index[::-1]] = begin[::-1]
                borders = np.flatnonzero(ids == BORDER)
                row = np.searchsorted(borders, first, "right") - 1
                if kind is np.uint8:
                    at = first - borders[row] - 1
                else:
                    size = np.where(ids == BORDER, 0, lengths[np.minimum(ids, len(lengths) - 1)])
                    before = np.concatenate([[0], np.cumsum(size)])
                    at = before[first] - before[borders[row]]
                yield pa.RecordBatch.from_arrays(
                    [part[order].take(pa.array(row)), pa.array(at, pa.int64()), pa.array(np.bincount(index, minlength=len(first)), pa.int64()), coded.dictionary],
                    names=[order, "at", "n", "ids"],
                )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for rows in of_slices(batches):
            held.append(rows)
            size += rows.nbytes
            if size > HELD:
                held = [_each_once(held, order)]
                size = held[0].nbytes
                if size > HELD // 2:
                    yield held.pop()
                    size = 0
        if held:
            yield _each_once(held, order)

    return run


def hot_runs(state: DataFrame, order: str, hot: np.ndarray, lengths: Sequence[int], kind: type) -> DataFrame:
    """(order, at, n, ids): the different runs of tokens whose neighbours all are hot pairs, their number, and the row and byte where each is met first."""
    schema = f"`{order}` {state.schema[order].dataType.simpleString()}, at long, n long, ids binary"
    found = state.mapInArrow(_hot_runs(hot, np.array(lengths, np.int64), kind, order), schema)
    met = found.groupBy("ids").agg(F.sum("n").alias("n"), F.min(F.struct(order, "at")).alias("met"))
    return met.select(F.col(f"met.{order}").alias(order), "met.at", "n", "ids")


def first_places(ids: np.ndarray, wanted: np.ndarray, from_id: int) -> tuple[np.ndarray, np.ndarray]:
    """(pairs, place in the array) of the wanted pairs and of those with an id from ``from_id`` on."""
    found_keys, found_at = [], []
    left = wanted
    for start in range(0, len(ids) - 1, _BLOCK):
        part = ids[start : start + _BLOCK + 1]
        mark = (part >= from_id) & (part != BORDER)
        new = mark[:-1] | mark[1:] if mark.any() else np.zeros(len(part) - 1, bool)
        if len(left):
            key = (part[:-1].astype(np.int64) << 16) | part[1:]
            slot = np.searchsorted(left, key)
            new |= left[np.minimum(slot, len(left) - 1)] == key
        at = np.flatnonzero(new)
        at = at[(part[at] != BORDER) & (part[at + 1] != BORDER)]
        if len(at):
            pairs, first = np.unique((part[at].astype(np.int64) << 16) | part[at + 1], return_index=True)
            found_keys.append(pairs)
            found_at.append(start + at[first])
            left = left[~np.isin(left, pairs)] if len(left) else left
        if not len(left) and from_id >= BORDER:
            break
    keys, at = np.concatenate([np.zeros(0, np.int64), *found_keys]), np.concatenate([np.zeros(0, np.int64), *found_at])
    pairs, first = np.unique(keys, return_index=True)
    return pairs, at[first]


def _pass(order: str, done: Sequence[Merge], steps: Sequence[Merge], wanted: np.ndarray | None, lengths: np.ndarray):
    """The Arrow pass over runs: changes by the steps, places merged by each, and first places. Without ``wanted`` every pair is counted and placed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        changes, merged = Changes(), np.zeros(len(steps), np.int64)
        kind = pa.int64()
        for batch in batches:
            kind = batch[order].type
            for part in slices(batch, [order, "at"]):
                ids = flat_ids(part["ids"])
                for group in commuting(done):
                    ids = merge_group(ids, group)
                # How often the run of a token occurs; a border has the number of the run after it.
                runs = part["n"].to_numpy()
                times = np.append(runs, 0)[np.cumsum(ids == BORDER) - 1]
                for k, step in enumerate(steps):
                    did = _merged(ids, step)
                    if did is None:
                        continue
                    after, kept, at, gone, came = did
                    merged[k] += times[at].sum()
                    changes.add(_keys(ids, gone), -1, times[gone[_inner(ids, gone)]])
                    ids, times = after, times[kept]
                    changes.add(_keys(ids, came), 1, times[came[_inner(ids, came)]])
                if wanted is None:
                    changes.add(_keys(ids), 1, times[:-1][_inner(ids, np.arange(len(ids) - 1))])
                pairs, at = first_places(ids, np.zeros(0, np.int64) if wanted is None else wanted, 0 if wanted is None else steps[0][2] if steps else BORDER)
                starts = np.flatnonzero(ids == BORDER)
                row = np.searchsorted(starts, at, "right") - 1
                size = np.where(ids == BORDER, 0, lengths[np.minimum(ids, len(lengths) - 1)])
                before = np.concatenate([[0], np.cumsum(size)])
                place = part["at"].to_numpy()[row] + before[at] - before[starts[row]]
                yield _rows(kind, pairs, None, part[order].take(pa.array(row)), place)
        pairs, n = changes.sums()
        yield _rows(kind, np.concatenate([pairs, -1 - np.arange(len(steps))]), np.concatenate([n, merged]), None, None)

    return run


def _rows(kind: pa.DataType, pairs: np.ndarray, n: np.ndarray | None, row: pa.Array | None, at: np.ndarray | None) -> pa.RecordBatch:
    size = len(pairs)
    cols = [
        pa.array(pairs, pa.int64()), pa.array(np.zeros(size, np.int64) if n is None else n),
        pa.nulls(size, kind) if row is None else row, pa.nulls(size, pa.int64()) if at is None else pa.array(at, pa.int64()),
    ]
    return pa.RecordBatch.from_arrays(cols, names=["pair", "n", "row", "at"])


def _replay(steps: Sequence[Merge], kind: type = np.uint16):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups = commuting(steps)
        for batch in batches:
            for part in slices(batch):
                ids = flat_ids(part["ids"], kind)
                for group in groups:
                    ids = merge_group(ids, group)
                starts = np.flatnonzero(ids == BORDER)
                inner = ids[ids != BORDER]
                offsets = (starts - np.arange(len(starts))) * ids.itemsize
                rows = pa.Array.from_buffers(pa.binary(), part.num_rows, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(inner)])
                names = part.schema.names
                yield pa.RecordBatch.from_arrays([rows if name == "ids" else part[name] for name in names], names=names)

    return run


class Pairs:
    """Numbers of the pairs that occur, kept sorted by pair."""

    def __init__(self) -> None:
        self.keys, self.n = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, keys: np.ndarray, n: np.ndarray) -> None:
        keys, at = np.unique(np.concatenate([self.keys, keys]), return_inverse=True)
        total = np.zeros(len(keys), np.int64)
        np.add.at(total, at, np.concatenate([self.n, n]))
        self.keys, self.n = keys[total > 0], total[total > 0]

    def leading(self, k: int, least: int) -> np.ndarray:
        """The k most frequent pairs and all as frequent as the last of them, sorted by pair."""
        if len(self.n) > k:
            least = max(least, int(np.partition(self.n, len(self.n) - k)[len(self.n) - k]))
        return self.keys[self.n >= least]

    def ranked(self, places: dict[int, tuple]) -> list[tuple[tuple[int, int], int]]:
        """Pairs in the order of merging, as far as the places tell it: before any pair without a place that is as frequent."""
        known = np.isin(self.keys, np.fromiter(places, np.int64, len(places)))
        unknown = int(self.n[~known].max(initial=0))
        sure = known & (self.n > unknown)
        rows = sorted(zip((-self.n[sure]).tolist(), self.keys[sure].tolist(), strict=True), key=lambda x: (x[0], places[x[1]]))
        return [((k >> 16, k & 0xFFFF), -n) for n, k in rows]


def learn(rows: DataFrame, order: str, choose, first_id: int, last_id: int, lengths: list[int], least: int) -> Iterator[tuple[int, int, int, int]]:
    """(left, right, occurrences, places merged) of the merges in turn; ids ``first_id`` up to ``last_id`` are given.

    ``rows`` is a written table of (order, bytes); ``choose`` takes the ranked pairs and the merges that are left, and gives those that are sure to
    be next. ``lengths`` are the bytes of each of the first ids.
    """
    size, next_id, state, kind = list(lengths), first_id, rows, np.uint8
    while next_id < last_id:
        counted = cut_lineage(state.mapInArrow(_count_all(kind), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")))
        top = counted.agg(F.max("n").alias("n")).first()["n"]
        if top is None or top < least:
            return
        low = max(least, top // HOT_SHARE)
        hot = np.array(sorted(r["pair"] for r in counted.filter(F.col("n") >= low).select("pair").collect()), np.int64)
        runs = cut_lineage(hot_runs(state, order, hot, size, kind))
        steps: list[Merge] = []
        for left, right, n, merged in _learn_runs(runs, order, choose, next_id, last_id, size, low):
            steps.append((left, right, next_id))
            size.append(size[left] + size[right])
            next_id += 1
            yield left, right, n, merged
        if next_id >= last_id or low == least:
            return
        state, kind = cut_lineage(state.mapInArrow(_replay(tuple(steps), kind), state.schema)), np.uint16


def _learn_runs(state: DataFrame, order: str, choose, first_id: int, last_id: int, lengths: list[int], least: int) -> Iterator[tuple[int, int, int, int]]:
    """The merges of a phase, found in its runs: those of at least ``least`` occurrences."""
    kind = state.schema[order].dataType.simpleString()
    pairs, done, steps, wanted, size = Pairs(), [], [], None, list(lengths)
    next_id = first_id
    chosen: list[tuple[tuple[int, int], int]] = []
    while True:
        run = _pass(order, tuple(done), tuple(steps), wanted, np.array(size, np.int64))
        found = state.mapInArrow(run, f"pair long, n long, row {kind}, at long").groupBy("pair")
        rows = found.agg(F.sum("n").alias("n"), F.min(F.when(F.col("at").isNotNull(), F.struct("row", "at"))).alias("met")).collect()
        merged = {-1 - r["pair"]: r["n"] for r in rows if r["pair"] < 0}
        rows = [r for r in rows if r["pair"] >= 0]
        pairs.add(np.array([r["pair"] for r in rows], np.int64), np.array([r["n"] for r in rows], np.int64))
        places = {r["pair"]: tuple(r["met"]) for r in rows if r["met"] is not None}
        for k, ((left, right), n) in enumerate(chosen):
            yield left, right, n, merged.get(k, 0)
        done += steps
        if len(done) >= MERGES_PER_WRITE:
            state, done = cut_lineage(state.mapInArrow(_replay(tuple(done)), state.schema)), []
        if next_id >= last_id or not len(pairs.n) or int(pairs.n.max()) < least:
            return
        chosen = [(pair, n) for pair, n in choose(pairs.ranked(places), last_id - next_id) if n >= least]
        steps = [(left, right, next_id + i) for i, ((left, right), _) in enumerate(chosen)]
        size += [size[left] + size[right] for left, right, _ in steps]
        next_id += len(steps)
        wanted = pairs.leading(LEADING, least)
