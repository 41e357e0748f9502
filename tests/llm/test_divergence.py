"""The audit against plain counting: cells, ties, tiles, blocks and odd rows."""

import random
import re
from collections import Counter, defaultdict

import pytest

from textmill.llm.divergence import Audit, audit

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def slow(rows, min_docs=30, alpha=5, scale=10**9, top=50):
    """(lang, source, part, item, value, rank) by the rule as it is stated."""
    count, total, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in ((a or "", b or "", c or "") for a, b, c in rows):
        terms = [t.translate(LOWER) for t in TERM.findall(text)]
        groups.add((lang, source))
        count[lang, source].update(terms)
        total[lang].update(terms)
        docs[lang].update(set(terms))
    out = []

    def ranked(lang, source, part, values, most=None):
        rows = sorted(values, key=lambda x: (-x[1], x[0].encode()))[:most]
        out.extend((lang, source, part, item, value, i) for i, (item, value) in enumerate(rows, 1))

    for lang, source in groups:
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        sums = {s: sum(count[lang, s][t] for t in kept) for g, s in groups if g == lang}

        def p(n, of):
            return 1 + scale * (n + alpha) // (of + alpha * len(kept))

        mine = {t: p(count[lang, source][t], sums[source]) for t in kept}
        ranked(lang, source, "pair", [(s, sum(abs(mine[t] - p(count[lang, s][t], sums[s])) for t in kept)) for s in sums if s != source])
        whole = sum(total[lang][t] for t in kept)
        more = [(t, mine[t] - p(total[lang][t], whole)) for t in kept if count[lang, source][t]]
        ranked(lang, source, "term", [x for x in more if x[1] > 0], top)
    return sorted(out)


def made(seed, n=400):
    """Texts with many ties, terms beyond ASCII, one language with nothing to keep and one source with a third of all rows."""
    draw = random.Random(seed)
    words = ["Apfel", "apfel", "über", "ÜBER", "naïve", "中文", "a1b", "x_y", "zebra", "😀", *(f"w{chr(97 + i)}{chr(97 + j)}" for i in range(9) for j in range(9))]
    rows = []
    for i in range(n):
        lang = draw.choice(["en", "en", "de", None])
        source = draw.choice(["hot", "hot", "a", "b", "c", "é", None, "A"])
        rows.append((" ".join(draw.choices(words, k=draw.randrange(25))) if i % 9 else None, lang, source))
    return rows + [("only once here", "fr", "a"), (None, "fr", "b"), ("", "fr", None), (None, "xx", "lone")]


@pytest.mark.parametrize("seed,top,min_docs", [(1, 50, 3), (2, 7, 10), (3, 1, 30)])
def test_as_counted_plainly(spark, seed, top, min_docs):
    rows = made(seed)
    docs = spark.createDataFrame(rows, "text string, lang string, source string").repartition(5)
    assert sorted(map(tuple, audit(docs, top=top, min_docs=min_docs).collect())) == slow(rows, min_docs, top=top)


def test_blocks_and_tiles_of_any_size(spark):
    rows = made(4, 300)
    found = Audit(spark.createDataFrame(rows, "text string, lang string, source string"), min_docs=5)
    whole = sorted(map(tuple, found.pairs().collect()))
    assert whole == [(a, b, d, e, f) for a, b, c, d, e, f in slow(rows, 5) if c == "pair"]
    for tile, cells in ((1, 7), (3, 20), (4, 1)):
        assert sorted(map(tuple, found.pairs(tile, cells).collect())) == whole


def test_ties_at_the_last_rank_go_by_utf8(spark):
    terms = ["é", "z", "￮", "😀", "a", "mm"]
    rows = [(" ".join(terms), "en", "s")] + [("other", "en", "t")] * 3
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    got = [r.item for r in Audit(docs, min_docs=1).terms(4).orderBy("rank").collect() if r.source == "s"]
    assert got == ["a", "mm", "z", "é"]


def test_counts_of_nineteen_digits_are_exact(spark):
    from pyspark.sql import functions as F

    from textmill.llm.divergence import frequency

    n, total, kept = 9_123_456_789_012, 10_234_567_890_123_456, 123_456_789
    row = spark.range(1).select(frequency(F.lit(n), F.lit(total), F.lit(kept), 5, 10**9).alias("p")).first()
    assert row.p == 1 + 10**9 * (n + 5) // (total + 5 * kept)


def test_odd_rows(odd, none):
    rows = [(r.text, r.lang, r.source) for r in odd.collect()]
    assert sorted(map(tuple, audit(odd, min_docs=1).collect())) == slow(rows, 1)
    assert audit(none).count() == 0
