"""Impact blocks: the skipping way finds what the plain join finds, from fewer postings."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rostrum.operators import impact
from rostrum.operators import search as se


@pytest.fixture(scope="module")
def corpus(spark):
    """Unit rows over rare and frequent terms, a few documents close to the queries, copies of one row."""
    rng = np.random.default_rng(4)
    rows, share = [], 1 / np.arange(1, 201)
    for i in range(600):
        terms = np.flatnonzero(rng.random(200) < share * 4)
        if i % 60 == 0:
            terms = np.union1d(terms, np.arange(150, 158))
        w = rng.exponential(1, len(terms)) * np.log(2 + terms)
        if i >= 590:
            terms, w = np.arange(150, 156), np.ones(6)
        if len(terms):
            rows += [(f"t{t:03d}", i, float(x)) for t, x in zip(terms, w / np.sqrt(w @ w))]
    queries = []
    for q, terms in enumerate([range(150, 156), [0, 1, 2, 151], [0, 3], [199], [7, 30, 90, 150, 152]]):
        w = np.log(2 + np.array(list(terms), float))
        queries += [(q, f"t{t:03d}", float(x)) for t, x in zip(terms, w / np.sqrt(w @ w))]
    queries.append((9, "unknown", 1.0))
    p = impact.with_tiers(spark.createDataFrame(rows, "term string, id long, weight double")).persist()
    return p, impact.block_table(p).persist(), spark.createDataFrame(queries, "query_id long, term string, qweight double")


def plain(corpus):
    p, _, q = corpus
    j = p.join(q, "term").groupBy("query_id", "id").agg(F.sum(F.col("weight") * F.col("qweight")).alias("score"))
    return {(r["query_id"], r["id"]): r["score"] for r in j.collect()}


def test_tiers_and_block_tops(corpus):
    p, blocks, _ = corpus
    for r in p.groupBy("tier").agg(F.min("weight").alias("a"), F.max("weight").alias("b")).collect():
        assert 2 ** (-(r["tier"] + 1) / 2) < r["a"] + 1e-9 and r["b"] <= 2 ** (-r["tier"] / 2) + 1e-9
    assert blocks.agg(F.sum("n")).first()[0] == p.count()
    assert p.join(blocks, ["term", "tier"]).where("weight > top").count() == 0


@pytest.mark.parametrize("threshold", [0.05, 0.3, 0.7])
@pytest.mark.parametrize("gain", [0, 1e9])
def test_matches_equal_the_plain_join(corpus, threshold, gain):
    p, blocks, q = corpus
    got = {(r["query_id"], r["id"]): r["score"] for r in se.ranked(impact.matches(q, blocks, p, threshold, gain=gain, small=0), threshold).collect()}
    want = {k: s for k, s in plain(corpus).items() if round(s, 9) >= threshold}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in got)


@pytest.mark.parametrize("k", [1, 3, 12])
def test_best_matches_from_the_head(corpus, k, monkeypatch):
    monkeypatch.setattr(impact, "HEAD_WORTH", 0)
    p, blocks, q = corpus
    got = se.batch_top(se.ranked(impact.matches(q, blocks, p, 0.05, top_k=k, gain=0, small=0), 0.05), k).collect()
    want = []
    for query in (0, 1, 2, 3, 4, 9):
        best = sorted((-round(s, 9), i) for (n, i), s in plain(corpus).items() if n == query and round(s, 9) >= 0.05)[:k]
        want += [(query, i, r + 1) for r, (_, i) in enumerate(best)]
    assert sorted((r["query_id"], r["id"], r["rank"]) for r in got) == sorted(want)


def test_skips_blocks(corpus, monkeypatch):
    """A high threshold, or a k-th score from the data, leaves a part of the postings to read."""
    monkeypatch.setattr(impact, "HEAD_WORTH", 0)
    p, blocks, q = corpus
    for threshold, k, most in ((0.7, None, 0.6), (0.05, 3, 0.9)):
        rows = impact.chosen_blocks(impact.query_blocks(q, blocks).persist(), p, threshold, k).collect()
        total, read = sum(r["n"] for r in rows), sum(r["n"] for r in rows if not r["skipped"])
        assert 0 < read < most * total
    # what a term skips are its lowest tiers
    by_term = {}
    for r in rows:
        by_term.setdefault((r["query_id"], r["term"]), []).append((r["tier"], r["skipped"]))
    assert all([s for _, s in sorted(v)] == sorted(s for _, s in v) for v in by_term.values())


def test_threshold_must_be_positive(corpus):
    with pytest.raises(ValueError):
        impact.matches(corpus[2], corpus[1], corpus[0], 0)


@pytest.mark.parametrize("threshold, k, gain", [(0.05, None, 1e9), (0.3, None, 0), (0.05, 3, 0), (0.05, 1, 0)])
def test_scores_inside_documents_equal_the_plain_join(spark, corpus, threshold, k, gain, monkeypatch):
    """Documents in one row each, scored without moving a posting."""
    monkeypatch.setattr(impact, "HEAD_WORTH", 0)
    p, blocks, q = corpus
    documents = impact.document_table(p).unionByName(spark.createDataFrame([(-1, [], [])], "id long, terms array<string>, weights array<double>"))
    got = se.ranked(impact.matches(q, blocks, p, threshold, top_k=k, gain=gain, small=0, documents=documents), threshold)
    want = {x: s for x, s in plain(corpus).items() if round(s, 9) >= threshold}
    if k is not None:
        got = se.batch_top(got, k)
        best = [sorted((-round(s, 9), i) for (n, i), s in want.items() if n == query)[:k] for query in range(10)]
        want = {(query, i): -s for query, rows in enumerate(best) for s, i in rows}
    rows = {(r["query_id"], r["id"]): r["score"] for r in got.collect()}
    assert rows.keys() == want.keys() and all(abs(rows[x] - want[x]) < 1e-8 for x in rows)
    plan = se.ranked(impact.matches(q, blocks, p, threshold, documents=documents), threshold)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "Join" not in plan


def test_documents_of_no_query_term(spark, corpus):
    p, blocks, q = corpus
    documents = impact.document_table(p)
    assert impact.matches(q.where("term = 'unknown'"), blocks, p, 0.1, documents=documents).count() == 0
    assert impact.matches(q.limit(0), blocks, p, 0.1, documents=documents).count() == 0
