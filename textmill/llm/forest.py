"""N-gram Jaccard join by MinHash bands of a depth set by the recall wanted.

Each of TREES bands is a sequence of minima. Its length is the longest up to MAX_DEPTH at which a pair at the threshold meets in some
band with the target probability; it is fixed before data are read. No trie is built and no prefix is shortened for the
data, as an LSH forest would. Texts that share a band are the groups that ``links`` verifies exactly, so that
nothing below the threshold is reported; what is missed is bounded by the target, in expectation over the hash functions.

Defined results: see ``links.classes``; texts of fewer words than a shingle are one shingle; texts without a word have no link.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm.arrow import shingles
from textmill.llm.links import classes, link
from textmill.llm.minhash import band_keys, signatures
from textmill.session import cut_lineage

SHINGLE, THRESHOLD, TREES, MAX_DEPTH, RECALL = 5, 0.8, 16, 10, 0.998


def meeting(likeness: float, depth: int, trees: int) -> float:
    """The probability that two texts share a prefix of ``depth`` minima in one of the tries at least."""
    return 1 - (1 - likeness**depth) ** trees


def depth_for(threshold: float, trees: int = TREES, longest: int = MAX_DEPTH, recall: float = RECALL) -> int:
    """The longest prefix at which pairs at the threshold meet with probability ``recall``."""
    depth = longest
    while depth > 1 and meeting(threshold, depth, trees) < recall:
        depth -= 1
    if meeting(threshold, depth, trees) < recall:
        raise ValueError("more tries are needed for this recall")
    return depth


def prefixes(trees: int, depth: int, size: int):
    def keys(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hashed, at = shingles(data, offsets, size)
        return band_keys(signatures(hashed, at, trees * depth, seed=2), depth), np.diff(at)

    return keys


def similar_texts(
    docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, trees: int = TREES, size: int = SHINGLE,
    text: str = "text", key: str = "doc_id",
) -> DataFrame:
    """One row per document with its class and number of links, see ``links.classes``."""
    depth = depth_for(threshold, trees, MAX_DEPTH, recall)
    return classes(docs, lambda d: link(d, prefixes(trees, depth, size), threshold, size), text, key)


def one_per_group(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows, with all their columns, without those whose text equals or is linked to that of a smaller key.

    Of rows that repeat a key one stays; rows with a null key stay.
    """
    found = cut_lineage(similar_texts(docs, threshold, recall, text=text, key=key).where("key IS NOT NULL"))
    stays = found.where("key = class_id")
    again = stays.groupBy(F.col("key").alias(key)).count().where("count > 1").select(key)
    goes = found.where("key <> class_id").select(F.col("key").alias(key)).unionByName(again).distinct()
    out = docs.join(goes, key, "left_anti").select(*docs.columns)
    if again.isEmpty():
        return out
    return out.unionByName(docs.join(again, key, "left_semi").dropDuplicates([key]).select(*docs.columns))
