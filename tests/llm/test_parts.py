"""Parts of the operators against plain versions."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from textmill.llm import decontaminate, forest, langid, links, minhash, mixing, pii, quality, secrets, toxicity, warc
from textmill.llm.arrow import flat, shingles, word_bounds, word_hashes


def flat_of(texts):
    return flat(pa.array(texts, pa.string()))


def test_words_and_shingles():
    rnd = random.Random(1)
    texts = ["".join(rnd.choice("ab \né") for _ in range(rnd.randrange(0, 40))) for _ in range(200)] + [None]
    data, offsets = flat_of(texts)
    starts, ends = word_bounds(data, offsets)
    words = [w for t in texts for w in re.findall(r"[^ \n]+", t or "")]
    assert [data[a:b].tobytes().decode() for a, b in zip(starts, ends, strict=True)] == words
    hashed = word_hashes(data, starts, ends).tolist()
    assert len(set(zip(words, hashed, strict=True))) == len(set(words)) == len(set(hashed))
    found, at = shingles(data, offsets)
    plain = []
    for t in texts:
        w = (t or "").split()
        plain += [tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))] if w else []
    assert len(plain) == len(found) == at[-1]
    assert len(set(zip(plain, found.tolist(), strict=True))) == len(set(plain)) == len(set(found.tolist()))


def plain_bits(trees, order, data):
    """Code length of a text, with dictionaries and sets."""
    padded = bytes([10] * order) + data
    bits = 0.0
    for i in range(order, len(padded)):
        excluded, done = set(), False
        for k in range(order, -1, -1):
            counts = trees.get(padded[i - k : i])
            if counts is None:
                excluded = set()
                continue
            seen = {s: n for s, n in counts.items() if s not in excluded}
            total, distinct = sum(seen.values()), len(seen)
            if padded[i] in seen:
                bits -= math.log2(seen[padded[i]] / (total + distinct))
                done = True
                break
            if distinct:
                bits -= math.log2(distinct / (total + distinct))
            excluded = set(counts)
        if not done:
            bits += math.log2(256 - len(trees[b""]))
    return bits


@pytest.mark.parametrize("order", [1, 3])
def test_code_lengths_are_exact(order):
    rnd = random.Random(2)
    corpora = {"x": ["".join(rnd.choice("abcé ") for _ in range(60)) for _ in range(9)], "y": ["".join(rnd.choice("bcdz") for _ in range(50)) for _ in range(9)]}
    counted, trees = {}, {}
    for lang, texts in corpora.items():
        packed, _ = langid.grams(*flat_of(texts), order)
        keys, n = np.unique(packed, return_counts=True)
        counted[lang] = (keys, n.astype(float))
        trees[lang] = defaultdict(Counter)
        for t in texts:
            padded = bytes([10] * order) + t.encode()
            for i in range(order, len(padded)):
                for k in range(order + 1):
                    trees[lang][padded[i - k : i]][padded[i]] += 1
        trees[lang] = dict(trees[lang])
    model = langid.Model(counted, order)
    tests = ["", "abc", "zzzq!", "é ab dd", "bcdzbcdz", "\n\n"]
    got = model.bits(*flat_of(tests))
    for i, t in enumerate(tests):
        for j, lang in enumerate(model.langs):
            assert math.isclose(got[i, j], plain_bits(trees[lang], order, t.encode()), rel_tol=1e-5, abs_tol=1e-4)


def test_base_spans_are_the_patterns():
    patterns = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]
    rnd = random.Random(3)
    for _ in range(20_000):
        text = "".join(rnd.choice("a1@. +-(2)_é%") for _ in range(rnd.randrange(0, 24)))
        want = []
        for k, p in enumerate(patterns):
            for m in re.finditer(p, text):
                digits = re.sub("[^0-9]", "", m[0])
                if (k == 0) or (k == 1 and all(int(x) <= 255 for x in m[0].split("."))) or (k == 2 and 13 <= len(digits) <= 19 and pii.luhn(digits)) or (k == 3 and 9 <= len(digits) <= 15):
                    want.append((k, *m.span()))
        assert pii.base_spans(text) == sorted(want)


def test_scanners_are_linear():
    for text in ("a" * 400_000, "a@" * 200_000, "1" * 400_000, "1." * 200_000, "+1 " * 130_000, "." * 400_000 + "@"):
        pii.base_spans(text)


@pytest.fixture(scope="module")
def field():
    rnd = random.Random(4)
    found = []
    for i in range(60):
        mail, phone = f"u{i}.x@mail{i % 7}.example.com", f"+1 ({rnd.randrange(200, 999)}) 555-{rnd.randrange(1000, 9999)}"
        ip = ".".join(str(rnd.randrange(256)) for _ in range(4))
        text = f"some words {mail} and then {phone} from {ip} on 12.03.{1990 + i % 30} item {rnd.randrange(10**6)} end"
        found.append((text, pii.base_spans(text)))
    return pii.train(found)


def test_field_adds_disguised_spans(field):
    for text, kind in (("mail jane at mail7 dot example dot com now", "email"), ("call 1 (212) 555-0100 now", "phone"), ("x joe(at)mail.example.com y", "email")):
        base, added = pii.find(text, field)
        assert not base and [pii.KINDS[k] for k, _, _ in added] == [kind]
    for text in ("on 12.03.2004 and 1999-2003", "the code 123456 is at hand", "look at that here"):
        assert pii.find(text, field) == ([], [])
    base, added = pii.find("a.b@c.example.org " * 3, field)
    assert len(base) == 3 and not added


def test_field_decodes_the_best_segmentation(field):
    """The dynamic program against all segmentations."""
    for text in ("call 1 (212) 555-0100 or a at b dot com", "1 (212) 555-0100 1 (212) 555-0101"):
        toks = pii.tokens(text)
        found = pii.candidates(text, toks, [])
        score = field.scores(found).max(1)

        def best(j):
            if j == 0:
                return 0.0
            return max([best(j - 1)] + [best(i) + score[c] for c, (i, e, _) in enumerate(found) if e == j])

        chosen = {(s, e) for _, s, e in field.decode(text, [])}
        total = sum(score[c] for c, (i, e, _) in enumerate(found) if (toks[i][0], toks[e - 1][1]) in chosen)
        assert math.isclose(total, best(len(toks)))


def test_gradient_of_the_field(field):
    text = "call 1 (212) 555-0100 or a at b dot com"
    toks = pii.tokens(text)
    found = pii.candidates(text, toks, [])
    gold = {(found[0][0], found[0][1], 3)}
    _, step = field.gradient(len(toks), found, gold)
    feature = found[0][2][0]
    for k in range(4):
        values = []
        for eps in (1e-5, -1e-5):
            moved = pii.Field(field.weights.copy())
            moved.weights[feature, k] += eps
            values.append(moved.gradient(len(toks), found, gold)[0])
        assert math.isclose((values[0] - values[1]) / 2e-5, step[feature, k], abs_tol=1e-4)


def test_masks():
    assert pii.mask("a x@y.zz b", [(0, 2, 8)]) == "a <EMAIL> b"
    assert pii.mask("0123456789", [(2, 1, 5), (3, 3, 7), (1, 4, 5)]) == "0<CARD>789"


def test_edit_distance():
    rnd = random.Random(5)

    def plain(text, pattern):
        row = [0] * (len(text) + 1)
        for i, a in enumerate(pattern, 1):
            new = [i]
            for j, b in enumerate(text, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
            row = new
        return min(row), row.index(min(row))

    for _ in range(2_000):
        text, pattern = ("".join(rnd.choice("abc") for _ in range(rnd.randrange(*r))) for r in ((0, 14), (1, 8)))
        best, start, end = decontaminate.distance(text, pattern, 99)
        assert (best, end) == plain(text, pattern)
        assert plain(text[start:end], pattern)[0] <= best and abs((end - start) - len(pattern)) <= best


@pytest.mark.parametrize("words", [15, 30, 120])
@pytest.mark.parametrize("share", [0.05, 0.1, 0.2])
def test_edited_passages_are_found_by_sampling(words, share):
    """Recall of the sampled path alone, by classes of items, measured on copies that the trial has not seen."""
    rnd = random.Random(6)
    items = [" ".join("".join(rnd.choice("aeiouthsnr") for _ in range(rnd.randrange(2, 9))) for _ in range(words)) for _ in range(150)]
    index = decontaminate.Items(list(range(150)), items)
    assert (index.repeats > 0).all() and not index.segments
    found = 0
    for i, t in enumerate(items):
        text = f"some words before {edited_text(rnd, t, int(len(t) * share))} and after"
        data, offsets = flat_of([text])
        _, window, item, place = index.candidates(data, offsets)
        found += i in {x[0] for x in index.passages(text, window, item, place)}
    assert found / 150 >= 0.95


def test_one_template_and_equal_items():
    rnd = random.Random(12)
    items = [f"Question: which of these words is the odd one out in the list that follows here? {random_words(rnd, 90)}" for _ in range(80)]
    index = decontaminate.Items([*range(80), 80], items + items[:1])
    assert index.ids[0] == [0, 80]
    for i, t in enumerate(items):
        assert (i, 4, 4 + len(t), 0) in found_in(f"and {t} so", index)


def test_short_items_may_have_edits_too():
    rnd = random.Random(13)
    items = sorted({random_words(rnd, n, "aeiouthsnrlmdc") for n in range(5, 25) for _ in range(2)})
    index = decontaminate.Items(list(range(len(items))), items)
    for _ in range(150):
        text = random_words(rnd, 80, "aeiouthsnrlmdc")
        i = rnd.randrange(len(items))
        text += edited_text(rnd, items[i], int(len(items[i]) * 0.2)) + random_words(rnd, 30)
        want = {j for j, u in enumerate(items) if decontaminate.distance(text, u, int(len(u) * 0.2))}
        assert {x[0] for x in found_in(text, index)} == want


def test_walks_of_windows_in_step_agree():
    letters = np.frombuffer(b"the quick brown fox jumps over the lazy dog and on" + bytes(64), np.uint8)
    bits = decontaminate.walk_bits(0, 24)
    plain, at = [], 4
    for row in bits:
        plain.append(letters[at])
        at += row[letters[at]]
    assert decontaminate.embed(letters, np.array([4, 10]), bits)[:, 0].tolist() == plain
    keys = {r: k.tolist() for r, _, k, _ in decontaminate.window_keys(letters, np.array([4, 10, 4]), 2, 8)}
    assert keys[0][0] == keys[0][2] != keys[0][1] and keys[0] != keys[1]


def found_in(text, index):
    """(item, start, end, distance) of the passages of a text."""
    data, offsets = flat_of([text])
    return [x[1:] for x in decontaminate._found(index, data, offsets)]


def random_words(rnd, size, letters="aeiouthsnr"):
    """A text of random words, ``size`` characters long."""
    out = ""
    while len(out) < size:
        out += "".join(rnd.choice(letters) for _ in range(rnd.randrange(2, 9))) + " "
    return out[: size - 1] + "z"


def test_copies_of_short_items_are_found_inside_a_text():
    rnd = random.Random(8)
    items = [random_words(rnd, n) for n in range(9, 90)]
    index = decontaminate.Items(list(range(len(items))), items, decontaminate.MAX_REPEATS)
    for i, t in enumerate(items):
        for before, after in (("some words before ", " and after them, some more"), ("quoted (", ") and more of it")):
            assert (i, len(before), len(before) + len(t), 0) in found_in(before + t + after, index)


def edited_text(rnd, text, edits):
    for _ in range(edits):
        i = rnd.randrange(len(text))
        text = text[:i] + rnd.choice(["", "x", text[i] + "y"]) + text[i + 1 :]
    return text


def test_passages_up_to_the_share_of_edits_are_all_found():
    rnd = random.Random(9)
    items = [random_words(rnd, rnd.randrange(30, 101)) for _ in range(50)] + [random_words(rnd, 700)]
    index = decontaminate.Items(list(range(len(items))), items, decontaminate.MAX_REPEATS)
    filler = [random_words(rnd, 150) for _ in range(20)]
    n = 0
    for i, t in enumerate(items):
        for share in (0.1, 0.15, 0.2):
            text = rnd.choice(filler) + edited_text(rnd, t, int(len(t) * share)) + rnd.choice(filler)
            want = {j for j, u in enumerate(items) if decontaminate.distance(text, u, int(len(u) * decontaminate.MAX_SHARE))}
            assert {x[0] for x in found_in(text, index)} == want and i in want
            n += len(want)
    assert n >= 153


def test_items_without_spaces_are_found_inside_a_sentence():
    rnd = random.Random(10)
    runs = [random_words(rnd, n, "".join(map(chr, range(0x4E00, 0x5200)))).replace(" ", "") for n in (30, 36, 50, 90, 400)]
    index = decontaminate.Items(list(range(5)), runs, decontaminate.MAX_REPEATS)
    for i, t in enumerate(runs):
        before, after = runs[i - 1][:20], runs[i - 2][:20]
        assert (i, 20, 20 + len(t), 0) in found_in(before + t + after, index)
        assert i in {x[0] for x in found_in(before + edited_text(rnd, t, int(len(t) * 0.2)) + after, index)}


def test_forest_depth_and_recall():
    depth = forest.depth_for(0.8)
    assert forest.meeting(0.8, depth, forest.TREES) >= forest.RECALL > forest.meeting(0.8, depth + 1, forest.TREES)
    with pytest.raises(ValueError):
        forest.depth_for(0.8, trees=1, recall=0.999)


def plain_classes(rows, threshold=0.8):
    """(class, links) of each key by comparing all pairs of texts."""
    sets = {}
    for k, t in sorted(rows):
        w = (t or "").split()
        sets.setdefault(t or "", (k, {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()))
    top = {k: k for k, _ in sets.values()}
    links_of = Counter()
    entries = list(sets.values())
    for i, (a, x) in enumerate(entries):
        for b, y in entries[i + 1 :]:
            if x and y and len(x & y) >= threshold * len(x | y):
                links_of[a] += 1
                links_of[b] += 1
                old, new = max(top[a], top[b]), min(top[a], top[b])
                top = {k: new if v == old else v for k, v in top.items()}
    return {k: (top[sets[t or ""][0]], links_of[sets[t or ""][0]]) for k, t in rows}


@pytest.mark.parametrize("operator", [forest.similar_texts, minhash.near_duplicates])
def test_links_and_classes(spark, operator, monkeypatch):
    rnd = random.Random(7)
    base = [[f"w{rnd.randrange(500)}" for _ in range(60)] for _ in range(6)]
    rows = []
    for i in range(220):  # one group holds a third of all rows
        words = list(base[0 if i % 3 == 0 else rnd.randrange(1, 6)])
        for _ in range(rnd.choice([0, 1, 1, 2])):
            words[rnd.randrange(60)] = f"n{rnd.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    rows += [(300 + i, f"a text of its own number {i} which nothing is like") for i in range(20)]
    monkeypatch.setattr(links, "BLOCK", 8)  # many blocks
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.key: (r.class_id, r.n_links) for r in operator(df).collect()}
    want = plain_classes(rows)
    same = sum(got[k] == want[k] for k in want) / len(want)
    assert same == 1.0 if operator is forest.similar_texts else same > 0.9


def test_components(spark):
    rnd = random.Random(8)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(40)]
    top = {x: x for e in edges for x in e}
    for _ in range(400):
        for a, b in edges:
            top[a] = top[b] = min(top[a], top[b])
    got = {r.id: r.top for r in links.components(spark.createDataFrame(edges, "id long, root long")).collect()}
    assert all(got.get(x, x) == t for x, t in top.items())


def test_boosted_trees():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 2] > 0.5)).astype(float)
    model = quality.grow(x[:2000], y[:2000])
    assert ((model.score(x[2000:]) > 0.5) == (y[2000:] > 0.5)).mean() > 0.97

    def walk(row):  # one row at a time
        total = model.base
        for root in model.roots:
            at = root
            while model.left[at] != at:
                at = model.left[at] if row[model.feature[at]] <= model.threshold[at] else model.right[at]
            total += model.value[at]
        return total

    assert np.allclose([walk(r) for r in x[:50]], model.margin(x[:50]))
    assert quality.grow(x, np.ones(3000)).score(x[:1])[0] > 0.99


def test_misspellings_share_vectors():
    rnd = random.Random(9)
    fill = ["lorem", "ipsum", "dolor", "amet", "sit", "elit", "magna", "erat", "velit", "nibh"]
    texts, label = [], []
    for i in range(600):
        words = [rnd.choice(fill) + rnd.choice(["", "us", "um"]) for _ in range(rnd.randrange(5, 120))]
        if i % 3 == 0:
            words.insert(rnd.randrange(len(words)), rnd.choice(["blockhead", "numbskull", "nincompoop"]))
        texts.append(" ".join(words))
        label.append(float(i % 3 == 0))
    model = toxicity.train(*flat_of(texts), np.array(label))
    bad = ["you blockheead lorem ipsum dolor", "such a numbskul amet sit elit", " ".join(["lorem ipsum dolor"] * 200 + ["nincompoops"] + ["amet sit"] * 200)]
    good = ["lorem ipsum dolor", "velit " * 500, "", "erat magna " * 300]
    assert model.score(*flat_of(bad)).min() > 0.7 > model.score(*flat_of(good)).max()


def test_poisson_table():
    for rate in (0.0, 0.01, 1.0, 7.5, 900.0, 40_000.0):
        low, cdf = mixing.poisson_table(rate)
        assert math.isclose(cdf[-1], 1.0, abs_tol=1e-6) and low >= 0
        if 0 < rate < 50:
            assert all(math.isclose(c, sum(math.exp(-rate) * rate**k / math.factorial(k) for k in range(low + i + 1)), abs_tol=1e-12) for i, c in enumerate(cdf[:20]))


def test_mixing_meets_its_rates(spark):
    df = spark.range(30_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 10 < 9, "big").otherwise("small").alias("source"))
    rates = spark.createDataFrame([("big", 0.3), ("small", 4.0)], "source string, rate double")
    got = {r.source: r["count"] for r in mixing.replicate(df, rates).groupBy("source").count().collect()}
    assert abs(got["big"] / (27_000 * 0.3) - 1) < 0.05 and abs(got["small"] / (3_000 * 4) - 1) < 0.05


def test_archives_come_back(spark, tmp_path):
    pages = [(3, "u3", "same"), (1, "u\r\n1", "same"), (2, None, None), (7, "u7", ""), (9, "u9", "WARC/1.1\r\n\r\nContent-Length: 5\r\n\r\nü"), (4, "u4", "x" * 70_000), (5, "u5", "same")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(2)
    path = str(tmp_path / "a")
    warc.write_archives(warc.resolve(warc.headers_of(df)), path, per_file=2)
    rows = {r.key: r for r in warc.read_archives(spark, path).collect()}
    assert {k: r.record_type for k, r in rows.items()} == {1: "response", 2: "response", 3: "revisit", 4: "response", 5: "revisit", 7: "revisit", 9: "response"}
    assert rows[1].url == "u%0D%0A1" and rows[2].url is None and rows[3].refers_to == 1 and rows[9].html == pages[4][2] and rows[4].html == pages[5][2]
    followed = {r.key: (r.payload_bytes, r.refers_to) for r in warc.follow_revisits(warc.read_archives(spark, path)).collect()}
    assert followed[5] == (4, 1) and followed[7] == (0, 2)
    # Archives of full responses, deduplicated later, give the same.
    full, again = str(tmp_path / "full"), str(tmp_path / "again")
    warc.write_archives(warc.headers_of(df).selectExpr("*", "'response' AS record_type", "CAST(NULL AS LONG) AS refers_to"), full)
    warc.deduplicate_archives(spark, full, again)
    assert {r.key: r.record_type for r in warc.read_archives(spark, again).collect()} == {k: r.record_type for k, r in rows.items()}
    small = warc.resolve(warc.headers_of(df), min_bytes=5)
    assert {r.record_type for r in small.collect()} == {"response"}


def test_secret_owners(spark):
    live, shared = "A1b2C3d4E5f6G7h8", "EXAMPLEKEY123456"
    rows = [(i, f"token = {shared}", f"o{i}") for i in range(5)] + [(9, f"api_key: '{live}' gh" + "p_" + "a1" * 20, "o9"), (10, "token=secret=abcdefghijkl token=password: abcdefghijklmnop", "o1")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.key: r.spans for r in secrets.scan(df).collect()}
    assert [s.live for s in got[0]] == [False] and got[0][0].n_owners == 5
    assert {(s.kind, s.live) for s in got[9]} == {("assign", True), ("vendor", True), ("hex", True)} - ({("hex", True)} if not any(s.kind == "hex" for s in got[9]) else set())
    # A match that fails is not tried again from within.
    assert [(s.kind, s.start) for s in got[10]] == [("assign", 0)]
