"""MinHash fingerprints of whole texts, and near duplicates by signature bands.

A text is the set of its runs of SHINGLE words, hashed to 64 bits; each of PERMUTATIONS universal hash functions
(multiply, add, shift) keeps its minimum over the set. The share of equal minima estimates the Jaccard likeness.

Defined results: a null text is empty; texts without a word share one fingerprint of their own; fewer words than a shingle make
one shingle; equal texts have equal fingerprints; rows that repeat a key are ordered by their text, a null key comes first.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm.arrow import CHUNK, chunks, flat, mix64, shingles
from textmill.llm.links import classes, link

SHINGLE, PERMUTATIONS, ROWS = 5, 64, 4
_LOWEST = -(1 << 63)


def permutations(n: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Odd multipliers and offsets of ``n`` universal hash functions of 64 bits to 32."""
    drawn = mix64(np.arange(2 * n, dtype=np.uint64) + np.uint64(seed << 32))
    return drawn[:n] | np.uint64(1), drawn[n:]


def signatures(hashed: np.ndarray, offsets: np.ndarray, n: int = PERMUTATIONS, seed: int = 1) -> np.ndarray:
    """(texts, n) minima, all ones for texts without a shingle."""
    out = np.full((len(offsets) - 1, n), 0xFFFFFFFF, np.uint32)
    full = np.flatnonzero(np.diff(offsets))
    if not len(full):
        return out
    at = offsets[full]
    part = np.empty(len(hashed), np.uint64)
    for k, (a, b) in enumerate(zip(*permutations(n, seed), strict=True)):
        np.multiply(hashed, a, out=part)
        part += b
        # The minimum of the high halves is the high half of the minimum.
        out[full, k] = (np.minimum.reduceat(part, at) >> np.uint64(32)).astype(np.uint32)
    return out


def _signed(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return signatures(*shingles(data, offsets, SHINGLE))


def _hex(signature: np.ndarray) -> list[str]:
    text = signature.astype(">u4").tobytes().hex()
    size = 8 * signature.shape[1]
    return [text[i : i + size] for i in range(0, len(text), size)]


def fingerprints(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, fingerprint) per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in chunks(batches, "text"):
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(_hex(_signed(data, offsets)), pa.string())], names=["key", "fingerprint"])

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"key {dict(docs.dtypes)[key]}, fingerprint string")


def in_order(docs: DataFrame, text: str, key: str) -> DataFrame:
    """Rows dealt into ranges of the key, each range followed by a copy (``edge``) of the first row of the next.

    The texts are shuffled once; what reaches the driver is one value per range. The last range is followed by the first row.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(key).cast("long"), F.lit(_LOWEST)).alias("place"), F.coalesce(text, F.lit("")).alias("text"))
    # Many ranges to a task, so that their hashes deal them out evenly.
    n = 16 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    quantiles = rows.select(F.percentile_approx("place", [i / n for i in range(1, n)], 10 * n).alias("q")).first()["q"]
    bounds = np.unique(np.array(quantiles or [], np.int64))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            part = np.searchsorted(bounds, b.column(0).to_numpy(), "right")
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(part)], names=["place", "part"])

    first = rows.select("place").mapInArrow(deal, "place long, part long").groupBy("part").agg(F.min("place").alias("place")).orderBy("part").collect()
    parts, firsts = np.array([r["part"] for r in first], np.int64), np.array([r["place"] for r in first], np.int64)

    def deal_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            place = b.column(1).to_numpy()
            edge = np.flatnonzero(np.isin(place, firsts))
            before = parts[np.searchsorted(firsts, place[edge]) - 1]
            for some, part, flag in ((b, np.searchsorted(bounds, place, "right"), False), (b.take(pa.array(edge)), before, True)):
                cols = [*some.columns, pa.array(part, pa.int64()), pa.array(np.full(len(part), flag))]
                yield pa.RecordBatch.from_arrays(cols, names=["key", "place", "text", "part", "edge"])

    kind = dict(docs.dtypes)[key]
    dealt = rows.mapInArrow(deal_texts, f"key {kind}, place long, text string, part long, edge boolean")
    return dealt.repartition("part").sortWithinPartitions("part", "edge", "place", "text").drop("place")


def edited(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """Code points per text, and each text but the last with its later half replaced by the start of the next one."""
    start = np.flatnonzero((data & 0xC0) != 0x80)
    upto = np.searchsorted(start, offsets)
    n = np.diff(upto)
    at = np.append(start, len(data))
    half = n[:-1] // 2
    own = at[upto[:-2] + n[:-1] - half]
    own = np.where(half == 0, offsets[1:-1], own)
    taken = np.minimum(half, n[1:])
    other = np.where(taken == n[1:], offsets[2:], at[np.minimum(upto[1:-1] + taken, len(start))])
    raw = data.tobytes()
    return n, [raw[a:b] + raw[b2:c] for a, b, b2, c in zip(offsets[:-2], own, offsets[1:-1], other, strict=True)]


_EDIT_SCHEMA = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row that is no edge, compared with its edited text and with the row after it."""
    last = None
    for b in batches:
        b = b.select(["key", "text", "edge"])
        b = b if last is None else pa.concat_batches([last, b])
        _, all_offsets = flat(b.column(1))
        at = 0
        while at < b.num_rows - 1:
            stop = min(b.num_rows - 1, max(at + 1, int(np.searchsorted(all_offsets, all_offsets[at] + CHUNK, "right")) - 1))
            rows = b.slice(at, stop - at + 1)
            data, offsets = flat(rows.column(1))
            n, texts = edited(data, offsets)
            own = _signed(data, offsets)
            sizes = np.fromiter(map(len, texts), np.int64, len(texts))
            new = _signed(np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum(sizes)]))
            hexed = _hex(own)
            out = pa.RecordBatch.from_arrays(
                [rows.column(0).slice(0, stop - at), pa.array(n[:-1].astype(np.int64)), pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
                 pa.array(hexed[:-1], pa.string()), pa.array(_hex(new), pa.string()), pa.array((own[:-1] == new).mean(1)), pa.array((own[:-1] == own[1:]).mean(1))],
                names=["key", *(x.split()[0] for x in _EDIT_SCHEMA.split(", "))],
            )
            yield out.filter(pa.compute.invert(rows.column(2).slice(0, stop - at)))
            at = stop
        last = b.slice(max(0, b.num_rows - 1))


def compare_neighbours(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Fingerprints of each text and of its edited text, with their likeness and the likeness to the next text."""
    return in_order(docs, text, key).mapInArrow(_compare, f"key {dict(docs.dtypes)[key]}, {_EDIT_SCHEMA}")


def band_keys(signature: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """(texts, bands) 64-bit hashes of runs of ``rows`` minima."""
    n, k = signature.shape
    out = np.zeros((n, k // rows), np.uint64)
    for i in range(rows):
        out = mix64(out + signature[:, i::rows][:, : k // rows].astype(np.uint64) + np.uint64(i + 1))
    return out.view(np.int64)


def _bands(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    hashed, at = shingles(data, offsets, SHINGLE)
    return band_keys(signatures(hashed, at)), np.diff(at)


def near_duplicates(docs: DataFrame, threshold: float = 0.8, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document with its class (see ``links.classes``): texts that share a band, by exact Jaccard likeness."""
    return classes(docs, lambda d: link(d, _bands, threshold, SHINGLE), text, key)
