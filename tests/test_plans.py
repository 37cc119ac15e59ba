"""Plan-shape checks for the scale claims in the README."""

from rostrum.operators import tfidf


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _docs(spark, n=64):
    rows = [(i, f"alpha beta w{i % 7} gamma{i % 3} delta") for i in range(n)]
    return spark.createDataFrame(rows, "id long, merged_speech string").repartition(8)


def test_term_counting_does_not_shuffle(spark):
    tok = tfidf.tokenize(_docs(spark))
    before = _plan(tok).count("Exchange")
    post = tfidf.postings(tok)
    assert _plan(post).count("Exchange") == before  # counting adds no exchange


def test_vocabulary_is_a_bounded_topk_broadcast(spark):
    m = tfidf.fit(_docs(spark), max_features=5, persist=False)
    plan = _plan(m.weights)
    assert "TakeOrderedAndProject" in plan and "limit=5" in plan
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_only_counted_words_move(spark):
    """A stem dictionary of any size: words are counted in their rows, and the counts move once, to their document."""
    stems = spark.createDataFrame([("alpha", "beta"), ("delta", "beta"), ("delta", "zz")], "token string, stem string")
    m = tfidf.fit(_docs(spark), stems=stems, persist=False)
    got = {(r["id"], r["term"]): r["tf"] for r in m.postings.collect()}
    assert got[(5, "beta")] == 3 and (5, "alpha") not in got and got[(5, "gamma")] == 1
    plan = _plan(m.postings)
    assert "posexplode" not in plan and "collect_list" not in plan
    empty = tfidf.stem_counts(spark.createDataFrame([(1, None), (2, "the"), (3, "Beta beta")], "id long, merged_speech string"),
                              stopwords=["the"], stems=stems, drop_null=False, keep_empty=True).collect()
    assert sorted((r["id"], r["term"] or "", r["tf"] or 0) for r in empty) == [(1, "", 0), (2, "", 0), (3, "beta", 2)]


def test_keyword_rows_are_ranked_once(spark, monkeypatch):
    """Trends read the stored keywords; they do not rank all postings again for each use."""
    from rostrum.plans import catalog, corpora
    monkeypatch.setattr(corpora, "_MEMO", {})
    plan = _plan(catalog.queries()["member_keyword_trends"](spark, "/root/testdata/sf0.001"))
    assert "InMemoryTableScan" not in plan and "WindowGroupLimit [id" not in plan
