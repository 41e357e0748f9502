"""Personal data: exact base patterns, and further spans by a semi-Markov conditional random field.

Base spans (email, ip, card, phone) come from linear scanners with the meaning of the contract's patterns. What is left
around digits and at-signs is cut into tokens; candidate segments of up to LONGEST tokens are scored as whole spans
(digit counts, grouping, separators, checksums, borders, words before), and dynamic programming over bounded segments chooses boundaries and types
jointly. The weights maximise the conditional likelihood of base spans, and of disguised variants of them, in a bounded
sample; long numbers that only fail the card checksum are neither positive nor negative in training.

Defined results: a null or empty text has no span; added spans never overlap base spans; spans are ordered by kind, then
start; without a base span in the sample nothing is added; repeated rows are scanned each.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.llm.arrow import chunks
from textmill.llm.sampling import bounded

KINDS = ("email", "ip", "card", "phone")
SAMPLE_ROWS, SAMPLE_ZONES, ZONE = 6_000, 3_000, 60
LONGEST, EPOCHS, LEARN, DECAY = 14, 6, 0.3, 1e-3

Span = tuple[int, int, int]  # rank of the kind, start, end

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def _only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """From each at-sign outwards: every run of local characters is read once, whatever its length."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            done = found.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[Span]:
    out = [(0, a, b) for a, b in emails(text)]
    # A match never starts within a run of digits, so the look-behind only saves time.
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append((1, *m.span()))
    for m in _CARD.finditer(text):
        digits = _only_digits(m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append((2, *m.span()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_only_digits(m[0])) <= 15:
            out.append((3, *m.span()))
    return sorted(out)


# Where the field looks: digits, at-signs and disguised at-signs.
_SEED = re.compile(r"[0-9@]|[\[(]at[\])]|\x20at\x20(?=[^\s.]+\x20dot\x20)")
_TOKEN = re.compile(r"[^\W\d_]+|[0-9]+|\S")
_JOINS = re.compile(r"[@().+\[\]-]|at|dot")
_WORDS = {
    "phone": {"tel", "phone", "call", "fax", "mobile", "telefon", "tél", "appel"}, "card": {"card", "visa", "credit", "karte", "carte", "tarjeta"},
    "email": {"mail", "email", "contact", "correo", "courriel"}, "ip": {"ip", "host", "address", "server"},
}

_SIZES = (0, 7, 9, 10, 11, 13, 16, 17, 20)
FEATURES = [
    "bias", *(f"digits_{x}" for x in _SIZES), "plus", "paren", "fours", "groups_1", "groups_2_3", "groups_4", "groups_more", "dot", "dash", "space",
    "checksum", "octets", "at", "disguised", "ending", "mixed", "left_word", "right_word", "odd", *(f"after_{x}" for x in _WORDS), "one_side",
]
_AT = {x: i for i, x in enumerate(FEATURES)}


def tokens(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _TOKEN.finditer(text)]


@lru_cache(4096)
def _shape(span: str) -> tuple[int, ...] | None:
    """Features of the span alone; None for what can be no entity."""
    digits = _only_digits(span)
    mail = bool(re.search(r"@|[\[(]at[\])]|\x20at\x20.+(\x20dot\x20|\.)", span))
    if len(digits) < 7 and not mail and span.count(".") != 3:
        return None
    letters = any(c.isalpha() for c in span)
    if letters and not mail:
        return None
    groups = re.findall(r"[0-9]+", span)
    got = ["bias", f"digits_{max(x for x in _SIZES if x <= len(digits))}"]
    got += ["groups_1" if len(groups) == 1 else "groups_2_3" if len(groups) <= 3 else "groups_4" if len(groups) == 4 else "groups_more"]
    tests = {
        "plus": span[0] == "+", "paren": "(" in span and ")" in span, "fours": len(groups) > 1 and {len(g) for g in groups} == {4},
        "dot": "." in span, "dash": "-" in span, "space": " " in span, "checksum": len(digits) >= 13 and luhn(digits),
        "octets": span.count(".") == 3 and len(groups) == 4 and all(len(g) <= 3 and int(g) <= 255 for g in groups),
        "at": "@" in span, "disguised": mail and "@" not in span, "mixed": letters and bool(digits),
        "ending": bool(re.search(r"(\.|\bdot |\(dot\) ?|\[dot\] ?)[^\W\d_]{2,6}$", span)),
        "odd": bool(re.search(r"[^\w\s@().+\[\]%-]", span)) or span.count("(") != span.count(")"),
        "one_side": mail and not re.search(r"\w ?(@|[\[( ]at[\]) ]) ?\w", span),
    }
    return tuple(_AT[x] for x in [*got, *(k for k, v in tests.items() if v)])


def candidates(text: str, toks: list[tuple[int, int]], blocked: list[tuple[int, int]]) -> list[tuple[int, int, tuple[int, ...]]]:
    """(first token, token after the last, features) of the segments that could be an entity."""
    out = []
    shut = [any(a < e and s < b for a, b in blocked) for s, e in toks]
    for i, (s, _) in enumerate(toks):
        first = text[s]
        if shut[i] or not (first.isalnum() or first in "+("):
            continue
        mail = digits = 0
        for j in range(i, min(len(toks), i + LONGEST)):
            a, b = toks[j]
            if shut[j] or j > i and a - toks[j - 1][1] > 1:
                break
            piece = text[a:b]
            if j > i and a > toks[j - 1][1] and piece.isalpha() and text[toks[j - 1][0] : toks[j - 1][1]].isalpha() and not ({piece, text[toks[j - 1][0] : toks[j - 1][1]]} & {"at", "dot"}):
                break  # two plain words apart
            if not piece.isalnum() and not _JOINS.fullmatch(piece) and piece not in "_%":
                break
            digits += len(piece) if piece.isdigit() else 0
            mail |= piece in ("@", "at")
            if (digits >= 4 or mail) and piece[-1].isalnum():
                shape = _shape(text[s:b])
                if shape is not None:
                    out.append((i, j + 1, shape + _around(text, s, b)))
    return out


def _around(text: str, s: int, e: int) -> tuple[int, ...]:
    got = []
    if s and (text[s - 1].isalnum() or text[s - 1] in "@_" or s > 1 and text[s - 1] in ".-+%" and text[s - 2].isalnum()):
        got.append("left_word")
    if e < len(text) and (text[e].isalnum() or text[e] in "@_"):
        got.append("right_word")
    before = set(re.findall(r"[^\W\d_]+", text[max(0, s - 24) : s].lower())[-3:])
    got += [f"after_{k}" for k, words in _WORDS.items() if before & words]
    return tuple(_AT[x] for x in got)


class Field:
    """Weights (features, kinds); a token outside any entity scores 0."""

    def __init__(self, weights: np.ndarray | None = None):
        self.weights = np.zeros((len(FEATURES), len(KINDS))) if weights is None else weights
        self.trained = weights is not None

    def scores(self, found: list) -> np.ndarray:
        return np.array([self.weights[list(f)].sum(0) for _, _, f in found]) if found else np.zeros((0, len(KINDS)))

    def decode(self, text: str, blocked: list[tuple[int, int]]) -> list[Span]:
        """The best segmentation; entities only."""
        toks = tokens(text)
        found = candidates(text, toks, blocked)
        if not found:
            return []
        score = self.scores(found)
        kind, top = score.argmax(1), score.max(1)
        ending: dict[int, list[int]] = {}
        for c, (_, j, _) in enumerate(found):
            if top[c] > 0:
                ending.setdefault(j, []).append(c)
        best, back = [0.0] * (len(toks) + 1), [None] * (len(toks) + 1)
        for j in range(1, len(toks) + 1):
            best[j] = best[j - 1]
            for c in ending.get(j, ()):
                if best[found[c][0]] + top[c] > best[j]:
                    best[j], back[j] = best[found[c][0]] + top[c], c
        out, j = [], len(toks)
        while j:
            if back[j] is None:
                j -= 1
                continue
            i = found[back[j]][0]
            out.append((int(kind[back[j]]), toks[i][0], toks[j - 1][1]))
            j = i
        return out

    def gradient(self, n: int, found: list, gold: set[tuple[int, int, int]]) -> tuple[float, np.ndarray]:
        """Log-likelihood of the gold segmentation of ``n`` tokens and its gradient, by forward and backward sums."""
        score = self.scores(found)
        ending: dict[int, list[int]] = {}
        starting: dict[int, list[int]] = {}
        for c, (i, j, _) in enumerate(found):
            ending.setdefault(j, []).append(c)
            starting.setdefault(i, []).append(c)
        inside = np.logaddexp.reduce(score, 1) if len(found) else np.zeros(0)
        fore, back = [0.0] * (n + 1), [0.0] * (n + 1)
        for j in range(1, n + 1):
            fore[j] = fore[j - 1]
            for c in ending.get(j, ()):
                fore[j] = np.logaddexp(fore[j], fore[found[c][0]] + inside[c])
        for i in range(n - 1, -1, -1):
            back[i] = back[i + 1]
            for c in starting.get(i, ()):
                back[i] = np.logaddexp(back[i], back[found[c][1]] + inside[c])
        step, likely = np.zeros_like(self.weights), -fore[n]
        for c, (i, j, f) in enumerate(found):
            p = np.exp(fore[i] + score[c] + back[j] - fore[n])
            for k in range(len(KINDS)):
                if (i, j, k) in gold:
                    p[k] -= 1
                    likely += score[c, k]
            np.add.at(step, list(f), -p)
        return likely, step


def disguised(text: str, span: Span) -> list[str]:
    """Variants of a base span that the patterns do not match."""
    s = text[span[1] : span[2]]
    if span[0] == 0:
        return [s.replace("@", " at ").replace(".", " dot "), s.replace("@", "(at)"), s.replace("@", " [at] ")]
    if span[0] == 3:
        return [s[1:], s[1:].replace("-", ".").replace("(", "").replace(")", "")]
    return []


def training_zones(text: str) -> Iterator[tuple[str, list[Span]]]:
    """Short stretches around seeds with their base spans; those with a long number of wrong checksum are left out."""
    spans = base_spans(text)
    for lo, hi in zones(text, []):
        own = [(k, s - lo, e - lo) for k, s, e in spans if lo <= s and e <= hi]
        part = text[lo:hi]
        doubtful = [m for m in _CARD.finditer(part) if 13 <= len(_only_digits(m[0])) <= 19 and not any(s <= m.start() < e for _, s, e in own)]
        if len(part) <= 8 * ZONE and not doubtful:
            yield part, own


def zones(text: str, taken: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Stretches of ZONE characters on either side of seeds outside ``taken``, those that meet joined, cut at white space."""
    out: list[list[int]] = []
    inside = iter(sorted(taken))
    now = next(inside, None)
    for m in _SEED.finditer(text):
        while now and now[1] <= m.start():
            now = next(inside, None)
        if now and now[0] <= m.start():
            continue
        if out and m.start() - ZONE <= out[-1][1]:
            out[-1][1] = m.end() + ZONE
        else:
            out.append([m.start() - ZONE, m.end() + ZONE])
    cut = []
    for lo, hi in out:
        lo, hi = max(0, lo), min(len(text), hi)
        gap = re.search(r"\s", text[lo : lo + ZONE // 2]) if lo else None
        cut.append((lo + gap.end() if gap else lo, hi))
    return cut


def train(found: list[tuple[str, list[Span]]]) -> Field:
    """Stochastic gradient ascent of the conditional likelihood, with adaptive steps."""
    if not any(spans for _, spans in found):
        return Field()
    cases = []
    for text, spans in found:
        variants = [(text, spans)]
        for k, s, e in spans:
            if sum(x < e and s < y for _, x, y in spans) == 1:
                for other in disguised(text, (k, s, e)):
                    moved = [(k2, a + (a > s) * (len(other) - e + s), b + (a > s) * (len(other) - e + s)) for k2, a, b in spans if (a, b) != (s, e)]
                    variants.append((text[:s] + other + text[e:], [*moved, (k, s, s + len(other))]))
        for body, own in variants:
            toks = tokens(body)
            first, last = {s: i for i, (s, _) in enumerate(toks)}, {e: i + 1 for i, (_, e) in enumerate(toks)}
            possible = candidates(body, toks, [])
            known = {(i, j) for i, j, _ in possible}
            gold = {(first[s], last[e], k) for k, s, e in own if s in first and e in last and (first[s], last[e]) in known}
            if possible:
                cases.append((len(toks), possible, gold))
    model = Field(np.zeros((len(FEATURES), len(KINDS))))
    model.weights[_AT["bias"]] = -1.0
    seen = np.full_like(model.weights, 1e-3)
    order = np.random.default_rng(3)
    for _ in range(EPOCHS):
        for c in order.permutation(len(cases)).tolist():
            _, step = model.gradient(*cases[c])
            step -= DECAY * model.weights
            seen += step**2
            model.weights += LEARN * step / np.sqrt(seen)
    return model


def find(text: str, field: Field) -> tuple[list[Span], list[Span]]:
    """Base spans, and spans the field adds."""
    base = base_spans(text)
    added = []
    if field.trained:
        taken = [(s, e) for _, s, e in base]
        for lo, hi in zones(text, taken):
            blocked = [(s - lo, e - lo) for s, e in taken if s < hi and e > lo]
            added += [(k, s + lo, e + lo) for k, s, e in field.decode(text[lo:hi], blocked)]
    return base, sorted(added)


def _seeded(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows that hold a digit, an at-sign or a disguised one."""
    hit = np.concatenate([[0], np.cumsum(((data >= 48) & (data <= 57)) | (data == 64))])
    rows = hit[offsets[1:]] > hit[offsets[:-1]]
    raw = data.tobytes()
    for wanted in (b" dot ", b"(at)", b"[at]"):
        at = raw.find(wanted)
        while at >= 0:
            row = np.searchsorted(offsets, at, "right") - 1
            rows[row] = True
            at = raw.find(wanted, int(offsets[row + 1]))
    return np.flatnonzero(rows)


def fit(docs: DataFrame, text: str = "text", key: str = "doc_id", sample_rows: int = SAMPLE_ROWS) -> Field:
    """The field, trained on zones of texts, SAMPLE_ZONES at most.

    Half of them may be zones with base spans, taken from all texts, so that rare personal data is learned from as well; the others come from at
    most about ``sample_rows`` texts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, data, offsets in chunks(batches, "text"):
            bodies, spans = [], []
            for r in _seeded(data, offsets).tolist():
                for body, own in training_zones(data[offsets[r] : offsets[r + 1]].tobytes().decode()):
                    bodies.append(body)
                    spans.append(";".join(f"{k},{s},{e}" for k, s, e in own))
            yield pa.RecordBatch.from_arrays([pa.array(bodies, pa.string()), pa.array(spans, pa.string())], names=["zone", "spans"])

    rows = docs.select(F.lit(1).alias("group"), F.col(key).alias("key"), F.col(text).alias("text"))
    def zones(texts: DataFrame, kind: Column, most: int) -> DataFrame:
        found = texts.select("text").mapInArrow(run, "zone string, spans string").where(kind)
        return found.distinct().orderBy(F.md5("zone"), "spans").limit(most)

    base = F.col("spans") != ""
    with_base = zones(rows, base, SAMPLE_ZONES // 2)
    without = zones(bounded(rows, "group", "key", sample_rows), ~base, SAMPLE_ZONES - SAMPLE_ZONES // 2)
    found = with_base.unionByName(without).orderBy(F.md5("zone"), "spans").collect()
    return train([(r["zone"], [tuple(map(int, x.split(","))) for x in r["spans"].split(";") if x]) for r in found])


_SPANS = "array<struct<kind:string,start:int,stop:int,base:boolean>>"


def scan(docs: DataFrame, field: Field, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, spans) per row: spans (kind, start, stop, base), code points with an exclusive end, by kind and start."""
    shared = docs.sparkSession.sparkContext.broadcast(field)
    item = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32()), ("base", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in chunks(batches, "text"):
            out: list[list[dict]] = [[] for _ in range(rows.num_rows)]
            for r in _seeded(data, offsets).tolist():
                base, added = find(data[offsets[r] : offsets[r + 1]].tobytes().decode(), shared.value)
                every = sorted([(*x, True) for x in base] + [(*x, False) for x in added])
                out[r] = [{"kind": KINDS[k], "start": s, "stop": e, "base": b} for k, s, e, b in every]
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(out, pa.list_(item))], names=["key", "spans"])

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"key {dict(docs.dtypes)[key]}, spans {_SPANS}")


def mask(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind; of spans that overlap the one that starts first, then the longest, counts."""
    out, at = [], 0
    for k, s, e in sorted(spans, key=lambda x: (x[1], -x[2])):
        if s >= at:
            out += [text[at:s], f"<{KINDS[k].upper()}>"]
            at = e
        elif e > at:  # the rest of an overlapping span
            at = e
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, field: Field, text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """The rows with personal data in ``text`` masked, and ``length`` (if there is such a column) set anew; nulls stay."""
    shared = docs.sparkSession.sparkContext.broadcast(field)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in chunks(batches, text):
            place = rows.schema.get_field_index(text)
            bodies = rows.column(place).to_pylist()
            for r in _seeded(data, offsets).tolist():
                bodies[r] = mask(bodies[r], [s for x in find(bodies[r], shared.value) for s in x])
            cols = list(rows.columns)
            cols[place] = pa.array(bodies, pa.string())
            yield pa.RecordBatch.from_arrays(cols, names=names)

    out = docs.mapInArrow(run, docs.schema)
    if length in names:
        out = out.withColumn(length, F.char_length(text).cast(docs.schema[length].dataType)).select(*names)
    return out
