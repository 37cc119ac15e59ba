"""D2 and the numbering of D5 against plain Python."""

import random

from rostrum.operators import corpus as co
from rostrum.operators import tfidf


def _cut(text, piece, threshold):
    return [text[i:i + piece] for i in range(0, len(text), piece)] if len(text) > threshold else [text]


def test_member_documents(spark):
    rng = random.Random(5)
    rows = []
    for i in range(400):
        member = rng.choice(["hot", "hot", "hot", "b", "c", None])
        text = rng.choice([None, "", "x" * rng.randrange(90), "ab c" * rng.randrange(6), "ü€𝄞" * rng.randrange(9)])
        rows.append((i, member, f"d{i * 7 % 50:02d}", text))
    rows += [(1000, "empty", "d", ""), (1001, "long", "d", "0123456789" * 70), (1002, "empties", "a", ""), (1003, "empties", "b", "")]
    df = spark.createDataFrame(rows, "id long, member_name string, sitting_date string, merged_speech string")
    texts = {}
    for i, m, d, t in sorted(rows, key=lambda r: (r[2], r[0])):
        if m is not None and t is not None:
            texts.setdefault(m, []).append(t)
    for piece, threshold, sep in ((64, 128, " "), (7, 7, "--"), (100_000, 200_000, " "), (50, 50, "")):
        got = {(r["member"], r["piece_no"]): r["text"]
               for r in co.member_documents(df, piece=piece, threshold=threshold, sep=sep).collect()}
        want = {(m, n): p for m, ts in texts.items() for n, p in enumerate(_cut(sep.join(ts), piece, threshold))}
        assert got == want
    assert co.member_documents(df.limit(0)).count() == 0


def test_unbounded_vocabulary_is_numbered_without_one_window(spark):
    terms = [(f"t{i * 37 % 1000:03d}", i % 9 + 1, i % 17 + 1) for i in range(1000)]
    df = spark.createDataFrame(terms, "term string, df long, ctf long")
    vocab = tfidf.vocabulary(df, 10, None)
    assert [(r["term"], r["term_id"]) for r in vocab.orderBy("term").collect()] == [(f"t{i:03d}", i) for i in range(1000)]
    assert "Window [row_number" not in vocab._jdf.queryExecution().executedPlan().toString()
