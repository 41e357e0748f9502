"""Secret scans with corpus-wide ownership frequency.

Candidates are found by patterns in JVM-side expressions, positions from the lengths between the matches. The hash of each
candidate's value is counted over the distinct repositories and owners that hold it: a value that many owners share, or that few owners
have in many repositories, is a copied example; one that stays with few of both looks live. Everything is DataFrame expressions.

Defined results: a null or empty text has no spans; a row that repeats counts as a row of its own and as the same repository;
a null owner or repository is one of its own; ties in a place are ordered by kind; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textmill.session import cut_lineage

# The patterns of the contract, in its order; and of further credential formats.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
VENDOR = (
    r"gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"
    r"|-----BEGIN [A-Z ]*PRIVATE KEY-----"
)
KINDS = {"assign": ASSIGN, "access": ACCESS, "hex": HEX, "vendor": VENDOR}
BASE = ("assign", "access", "hex")
MIN_ASSIGNED = 12
LIVE_OWNERS, LIVE_REPOS = 2, 20  # a value of more owners, or in more repositories, is a copied example


def _hits(text: Column, pattern: str) -> Column:
    """Array of (gap, hit): characters since the last match, and the match."""
    gaps = F.transform(F.split(text, pattern, -1), lambda x: F.char_length(x).cast("long"))
    found = F.arrays_zip(gaps.alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"))
    # Most texts have none: they are read once, not twice.
    return F.when(text.rlike(pattern), found)


def candidates(docs: DataFrame, key: str, text: str, owner: str, repo: str) -> DataFrame:
    """One row per candidate, and one without a hit per row that has none: (row, key, owner, repo, kind, start, stop, value).

    ``row`` numbers the input rows; the table is written, so that the numbers hold and texts are read once.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(key).alias("key"),
        F.col(owner).alias("owner"),
        F.col(repo).alias("repo"),
        *(_hits(body, p).alias(k) for k, p in KINDS.items()),
    )
    rows = cut_lineage(rows)
    by_kind = [
        rows.select("row", "key", "owner", "repo", F.lit(k).alias("kind"), F.posexplode(k).alias("n", "found")) for k in KINDS
    ]
    every = by_kind[0]
    for x in by_kind[1:]:
        every = every.unionByName(x)
    length = F.char_length("found.hit").cast("long")
    # The part after the last match comes without a hit.
    upto = Window.partitionBy("row", "kind").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    placed = every.where("found.hit IS NOT NULL").withColumn("stop", F.sum(F.col("found.gap") + length).over(upto))
    value = F.when(F.col("kind") == "assign", F.regexp_extract("found.hit", ASSIGN, 2)).otherwise(F.col("found.hit"))
    placed = placed.select(
        "row", "owner", "repo", "kind", (F.col("stop") - length).alias("start"), "stop", F.sha2(value, 256).alias("value"),
        F.char_length(value).alias("size"),
    )
    placed = placed.where((F.col("kind") != "assign") | (F.col("size") >= MIN_ASSIGNED)).drop("size")
    return rows.select("row", "key"), placed


def ownership(placed: DataFrame) -> DataFrame:
    """(value, n_repos, n_owners): distinct repositories and owners of each value.

    Counted by two groupings below the value, each combined before its shuffle, so that a value that a third of all
    rows hold is nowhere gathered.
    """
    held = placed.select("value", "owner", "repo").distinct()
    by_owner = held.groupBy("value", "owner").agg(F.count(F.lit(1)).alias("n"))
    return by_owner.groupBy("value").agg(F.sum("n").alias("n_repos"), F.count(F.lit(1)).alias("n_owners"))


def scan(
    docs: DataFrame, key: str = "doc_id", text: str = "text", owner: str = "source", repo: str = "doc_id",
    live_owners: int = LIVE_OWNERS, live_repos: int = LIVE_REPOS,
) -> DataFrame:
    """One row per input row: (key, spans), spans an array of (start, rank, kind, stop, n_repos, n_owners, live).

    Base kinds are always there; further kinds are added where few owners and few repositories hold the value.
    """
    rows, placed = candidates(docs, key, text, owner, repo)
    placed = cut_lineage(placed)
    known = placed.join(ownership(placed), "value")
    known = known.withColumn("live", (F.col("n_owners") <= live_owners) & (F.col("n_repos") <= live_repos))
    known = known.where(F.col("kind").isin(*BASE) | F.col("live"))
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    span = F.struct("start", rank.alias("rank"), "kind", "stop", "n_repos", "n_owners", "live")
    spans = known.groupBy("row").agg(F.sort_array(F.collect_list(span)).alias("spans"))
    none = F.array().cast(spans.schema["spans"].dataType)
    return rows.join(spans, "row", "left").select("key", F.coalesce("spans", none).alias("spans"))


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def digest(scanned: DataFrame) -> DataFrame:
    """The contract's columns of a scan."""
    spans = F.col("spans")
    base = F.filter(spans, lambda s: s["kind"].isin(*BASE))

    def n(test) -> Column:
        return F.size(F.filter(spans, test)).cast("long")

    def of(kind: str):
        return lambda s: s["kind"] == kind

    return scanned.select(
        F.col("key").alias("doc_id"),
        *(n(of(k)).alias(f"n_{k}") for k in BASE),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(spans).alias("spans"),
        n(lambda s: s["live"]).alias("n_live"),
        n(lambda s: ~s["live"]).alias("n_copied"),
        F.coalesce(F.array_max(F.transform(spans, lambda s: s["n_repos"])), F.lit(0).cast("long")).alias("most_repos"),
    )
