import math

from pyspark.sql import functions as F

from rostrum.operators import keywords as kw
from rostrum.operators import tfidf

DOCS = [(1, "apple banana apple cherry"), (2, "banana banana dates"), (3, "cherry apple"), (4, None), (5, "zz")]


def _df(spark):
    return spark.createDataFrame(DOCS, "id long, merged_speech string")


def test_idf_and_weights_match_formula(spark):
    m = tfidf.fit(_df(spark), max_features=3)
    vocab = {r["term"]: r for r in m.vocab.collect()}
    # ctf: apple 3, banana 3, cherry 2, dates 1, zz 1 -> top 3 by count then term
    assert sorted(vocab) == ["apple", "banana", "cherry"]
    assert [vocab[t]["term_id"] for t in ("apple", "banana", "cherry")] == [0, 1, 2]
    n = 4  # null text dropped, the doc with only 'zz' still counts
    assert math.isclose(vocab["apple"]["idf"], math.log((1 + n) / (1 + 2)) + 1)
    w = {(r["id"], r["term"]): r["weight"] for r in m.weights.collect()}
    raw = {"apple": 2 * vocab["apple"]["idf"], "banana": vocab["banana"]["idf"], "cherry": vocab["cherry"]["idf"]}
    norm = math.sqrt(sum(v * v for v in raw.values()))
    for t, v in raw.items():
        assert math.isclose(w[(1, t)], v / norm)
    assert (5, "zz") not in w


def test_keyword_ties_break_by_term(spark):
    rows = [(1, "b", 0.5), (1, "a", 0.5), (1, "c", 0.7), (1, "blocked", 0.9), (2, "x", 0.0)]
    w = spark.createDataFrame(rows, "id long, term string, weight double")
    got = kw.keywords_per_doc(w, blocklist=["blocked"], top_n=2).orderBy("rank").collect()
    assert [(r["keyword"], r["rank"]) for r in got] == [("c", 1), ("a", 2)]


def test_group_top_and_trend(spark):
    rows = [(1, "k1", 0.4, "m", "2001-01-01"), (2, "k1", 0.4, "m", "2002-01-01"), (3, "k2", 0.5, "m", "2002-06-01"),
            (4, "k3", 0.1, None, "2002-01-01")]
    df = spark.createDataFrame(rows, "id long, keyword string, score double, member_name string, sitting_date string")
    top = kw.top_keywords_by_group(df, "member_name", top_n=1).collect()
    assert [(r["member_name"], r["keyword"]) for r in top] == [("m", "k1")]
    tr = {(r["sitting_year"], r["keyword"]): r["score"] for r in
          kw.group_keyword_trends(df, kw.top_keywords_by_group(df, "member_name", 1), "member_name").collect()}
    assert tr == {(2001, "k1"): 0.4, (2002, "k1"): 0.4}


def test_only_words_of_the_vocabulary_meet_documents(spark):
    """With a stem table the model is that of all postings, and its weights hold no term beyond the vocabulary's; ids may repeat or be null."""
    rows = [(i if i % 9 else None, f"Alpha beta{'' if i % 2 else ' betas'} w{'abcdefg'[i % 7]} gamma{'xyz'[i % 3]} gammax delta") for i in range(40)]
    docs = spark.createDataFrame([*rows, rows[3], (50, None), (51, "")], "id long, merged_speech string")
    stems = spark.createDataFrame([("betas", "beta"), ("betas", "zz"), ("gammax", "gam"), ("gammay", "gam"), ("wa", "x")], "token string, stem string")
    whole, model = (tfidf.fit(docs, stems=stems, stopwords=["delta"], max_features=4, persist=p) for p in (False, True))
    assert sorted(map(repr, whole.vocab.collect())) == sorted(map(repr, model.vocab.collect()))
    a, b = ({(r["id"], r["term"]): (r["tf"], round(r["weight"], 9)) for r in m.weights.collect()} for m in (whole, model))
    assert a == b and (None, "alpha") in a and len(a) == model.weights.count()
    assert sorted(map(repr, whole.postings.collect())) == sorted(map(repr, model.postings.collect()))
    assert {r["term"] for r in model.used.collect()} == {r["term"] for r in model.vocab.collect()} < {r["term"] for r in model.postings.collect()}
    model.unpersist()
