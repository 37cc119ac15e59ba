"""Operators 11 to 13 against plain Python, with nulls, ties, repeats, empty tables and clashing columns."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from rostrum.llm import adaptive_rules as rules
from rostrum.llm import hard_negatives as hard
from rostrum.llm import lexical_search as lexical

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def ranked(docs, items, top=lexical.TOP):
    """docs: (doc_id, text); items: (item_id, text)."""
    split = [(i, Counter(terms(t))) for i, t in docs]
    split = [(i, c, sum(c.values())) for i, c in split if c]
    n_docs, total = len(split), sum(n for _, _, n in split)
    df = Counter(t for _, c, _ in split for t in c)
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for t, d in df.items()}
    wanted = defaultdict(set)
    for i, t in items:
        wanted[i] |= set(terms(t))
    out = []
    for item, words in wanted.items():
        scores = []
        for i, c, n in split:
            m = 50 + (50 * n * n_docs) // total
            s = sum(weight[w] * ((1_000_000_000 * c[w]) // (1000 * c[w] + 20 * m)) for w in words if w in c)
            if s > 0:
                scores.append((-s, i is None, i or 0, i))
        for k, (s, _, _, i) in enumerate(sorted(scores, key=lambda x: x[:3])[:top]):
            out.append((item, k + 1, i, -s))
    return out


def key(rows):
    return sorted((tuple(r) for r in rows), key=str)


ITEMS = [(1, "The boat went over the SEA"), (2, "katze, schlief"), (2, "hund"), (3, "word"), (4, "!!"), (5, None), (None, "all day"), (6, "é x")]


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(*r, "x", "x") for r in ITEMS], "item_id long, text string, term string, score string")


@pytest.mark.parametrize("block_terms", [lexical.BLOCK_TERMS, 3])
def test_search_brute_force(spark, odd, items, block_terms):
    docs = [(r["doc_id"], r["text"]) for r in odd.collect()]
    got = lexical.search(odd, items, top=4, block_terms=block_terms)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert key(got.collect()) == key(ranked(docs, ITEMS, 4))


def test_search_empty(spark, odd, empty, items):
    assert lexical.search(empty, items).count() == 0
    assert lexical.search(odd, items.limit(0)).count() == 0
    assert lexical.search(odd.where("doc_id = 4"), items).count() == 0


def test_scanner_chunks(monkeypatch):
    text = "ab Ab cd,ab é-É abc ab-cd " * 50
    want = Counter(terms(text))
    monkeypatch.setattr(lexical, "_CHUNK", 7)
    n, found, tf = lexical.Scanner(["ab", "cd", "é", "zz"]).counts(text.encode())
    assert n == sum(want.values())
    assert dict(zip(found.tolist(), tf.tolist())) == {0: want["ab"], 1: want["cd"], 2: want["é"]}
    assert lexical.Scanner(["ab"]).counts(("x" * 100 + " ab").encode())[0] == 2


def test_ranking_keeps_the_best():
    rng = np.random.default_rng(3)
    ranking, rows = lexical.Ranking(3, 5), []
    for _ in range(40):
        item, score, doc = rng.integers(0, 3, 50), rng.integers(1, 30, 50), rng.integers(0, 1000, 50)
        ranking.add(item, score, doc, np.zeros(50, bool))
        rows += list(zip(item.tolist(), (-score).tolist(), doc.tolist()))
        ranking.cut()
    want = [r for k in range(3) for r in sorted(x for x in rows if x[0] == k)[:5]]
    assert [(a, -s, d) for a, s, d, _ in zip(*(c.tolist() for c in ranking.kept))] == want


# ------------------------------------------------------------ hard negatives


def mined(rows, anchor, positives=5, negatives=3):
    """rows: (vec_id, vector, label)."""
    ok = [(k, i, [math.floor(256 * x) for x in v], lab) for k, (i, v, lab) in enumerate(rows)
          if lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for k, i, v, lab in ok:
        if i is None or not anchor(i):
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), j is None, j or 0, j, other == lab) for p, j, w, other in ok if p != k and len(w) == len(v)]
        scored.sort(key=lambda s: s[:3])
        for ps, _, _, pos, _ in [s for s in scored if s[4]][:positives]:
            ps = -ps
            fits = [s for s in scored if not s[4] and 50 * ps <= 100 * -s[0] <= 95 * ps][:negatives]
            out += [(i, pos, n + 1, s[3], ps, -s[0]) for n, s in enumerate(fits)]
    return out


SCHEMA = "vec_id long, embedding array<double>, label int, pos string, anchor string, group string"


def vectors(n, size, seed, labels=3, copies=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, size)) + rng.normal(size=(1, size)) * 0.7
    x[: n // 3] *= rng.uniform(0.1, 4, (n // 3, 1))
    rows = [(i, x[i].tolist(), int(rng.integers(0, labels))) for i in range(n)]
    return rows + [(n + i, x[0].tolist(), i % labels) for i in range(copies)]


ODD_VECTORS = [(5000, None, 1), (5001, [1.0, None], 1), (5002, [float("nan")] * 8, 1), (5003, [float("inf")] * 8, 2), (5004, [1.0] * 8, None),
               (None, [0.5] * 8, 1), (5005, [0.0] * 8, 2), (10, [0.25] * 8, 1), (10, [0.25] * 8, 1), (5010, [], 1), (5015, [], 2), (5020, [2.0, 1.0], 1),
               (5025, [1.0, 1.0], 2), (5026, [2.0, 2.0], 1), (5030, [-0.001] * 8, 0)]


@pytest.mark.parametrize("bucket", [2048, 16])
def test_hard_negatives_brute_force(spark, monkeypatch, bucket):
    monkeypatch.setattr(hard, "BUCKET", bucket)
    rows = vectors(300, 8, 1, copies=60) + ODD_VECTORS
    df = spark.createDataFrame([(*r, "x", "x", "x") for r in rows], SCHEMA)
    got = hard.mine(df, F.col("vec_id") % 5 == 0)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = mined(rows, lambda i: i % 5 == 0)
    assert len(want) > 300
    assert key(got.collect()) == key(want)


def test_hard_negatives_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert hard.mine(df, F.col("vec_id") % 5 == 0).count() == 0
    df = spark.createDataFrame([(1, [1.0], 1, "x", "x", "x")], SCHEMA)
    assert hard.mine(df, F.col("vec_id") % 5 == 0).count() == 0


def test_ranges_skip_rows_but_lose_none():
    """High scores to reach: the coordinate ranges leave few candidates, and every row that reaches is among them."""
    rng = np.random.default_rng(7)
    x = rng.normal(size=(800, 16))
    x = np.floor(2000 * x / np.linalg.norm(x, axis=1, keepdims=True))
    none = np.zeros(800, np.int64)
    bucket = hard.Bucket(np.arange(800), np.arange(800), none.astype(bool), none, x)
    scores = hard.products(x[:50], x)
    least = np.sort(scores, axis=1)[:, -3].astype(float)
    length = hard._lengths(x[:50])
    found = bucket.candidates(hard._units(x[:50], length), length, least)
    tight = bucket.candidates(hard._units(x[:50], length), length, np.diag(scores).astype(float))
    assert np.mean([800 if c is None else len(c) for c in tight]) < 80
    for k, c in enumerate(found):
        reach = np.flatnonzero(scores[k] >= least[k])
        assert c is None or set(reach) <= set(c)
    over = bucket.candidates(hard._units(x[:50], length), length, length * bucket.longest * 1.1)
    assert all(len(c) == 0 for c in over)


def test_products_beyond_doubles():
    a = np.array([[2.0 ** 40, 1.0], [3.0, -2.0 ** 62]])
    got = hard.products(a, a)
    assert got[0, 0] == 2 ** 63 - 1 and got[0, 1] == 3 * 2 ** 40 - 2 ** 62


# ------------------------------------------------------------- quality rules


def measured(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", text)
    seen, dup, lines = set(), 0, 0
    for line in text.split("\n"):
        if re.search("[^\x20\x09-\x0d]", line):
            lines += 1
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[k:k + 3]) for k in range(len(words) - 2)]
    counts = Counter(windows)
    inside = {k + j for k, w in enumerate(windows) if counts[w] > 1 for j in range(3)}
    return (len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text)), dup, len(inside), lines)


TEXTS = [None, "", " \t", "a b c", "a b c a b c", "x x x x x", "one line\none line\none line \n\n\nother", "é ü #* a|b <> z", "a b c d a b c",
         "q\x0br\x0cs\x1ct " * 9, "A\r\nA\r\nA", "w " * 30_000]


def test_measures_plain():
    for t in TEXTS:
        assert rules.measure(None if t is None else t.encode()) == measured(t), t


def junk_and_prose(n):
    rng = np.random.default_rng(11)
    rows = []
    for i in range(n):
        words = ["".join(rng.choice(list("abcdefgh"), rng.integers(2, 9))) for _ in range(int(rng.integers(60, 150)))]
        if i % 4 == 3:  # junk of a quarter of every group
            words = [w + "###" for w in words]
        rows.append((i, " ".join(words), ("en", "de", None)[i % 3 if i % 10 else 2], "rare" if i % 50 == 0 else "hot"))
    return rows


def test_bounds_find_the_junk(spark):
    rows = junk_and_prose(1200)
    df = spark.createDataFrame([(*r, 1, "x", "x") for r in rows], "doc_id long, text string, lang string, source string, n_chars long, rate string, kept string")
    got = {r["doc_id"]: r for r in rules.judge(df).collect()}
    assert len(got) == len(rows)
    for i, text, _, _ in rows:
        assert tuple(got[i][m] for m in rules.MEASURES) == measured(text)
        assert got[i]["kept"] == (i % 4 != 3) and not got[i]["base_failed"]
    # a group of few documents has its language's bounds
    assert got[50]["symbols_high"] == next(got[i]["symbols_high"] for i, _, lang, s in rows if lang == rows[50][2] and s == "rare" and i != 50)


def test_sketch_quantiles_and_merging(spark):
    rng = np.random.default_rng(5)
    values = np.sort(rng.lognormal(5, 2, 2000).astype(int))
    df = spark.createDataFrame([("en", f"s{i % 7}", 9, *[int(v)] * 4) for i, v in enumerate(values)],
                               "lang string, source string, n_words long, word_length long, symbols long, dup_lines long, repeats long")
    sketch = rules.sketches(df)
    merged = rules.merge(sketch, "lang")
    whole = rules.sketches(df.withColumn("source", F.lit("one"))).drop("source")
    assert key(merged.select("rate", "bucket", "n").collect()) == key(whole.select("rate", "bucket", "n").collect())
    r = rules.bounds(merged, "lang").where("rate = 'symbols'").first()
    median, first = values[999], values[499]
    assert r["docs"] == 2000 and r["low"] is None
    cut = [v >> max(int(v).bit_length() - rules.BITS, 0) << max(int(v).bit_length() - rules.BITS, 0) for v in (int(median), int(first))]
    assert r["high"] == cut[0] + rules.REACH * max(cut[0] - cut[1], 300)
    assert median - cut[0] <= median / 2 ** (rules.BITS - 1)


def test_rules_odd_and_empty(spark, odd, empty):
    got = rules.judge(odd).collect()
    want = Counter((r["doc_id"], *measured(r["text"])) for r in odd.collect())
    assert Counter((r["doc_id"], *(r[m] for m in rules.MEASURES)) for r in got) == want
    assert all(r["base_failed"] == (r["n_words"] < 50 or 2 * r["n_repeat_words"] > r["n_words"]) for r in got)
    assert not any(r["kept"] for r in got if r["base_failed"])
    assert rules.judge(empty).count() == 0
