from rostrum.operators import search as se
from rostrum.operators import tfidf
from rostrum.sources import io

DOCS = [(1, "red apple pie"), (2, "green apple"), (3, "blue sky"), (4, "apple apple red")]


def _model(spark):
    df = spark.createDataFrame(DOCS, "id long, merged_speech string")
    return tfidf.fit(df), df


def test_empty_and_unknown_queries(spark):
    m, df = _model(spark)
    details = df.selectExpr("id", "merged_speech", "'x' AS member_name", "'p' AS political_party",
                            "'1' AS parliamentary_period", "'1' AS parliamentary_session",
                            "'1' AS parliamentary_sitting", "DATE'2000-01-01' AS sitting_date")
    assert se.search(spark, "", m, details).count() == 0
    assert se.search(spark, "zzz qqq", m, details).count() == 0
    res = se.search(spark, "red apple", m, details, per_page=2).collect()
    assert [r["rank"] for r in res] == [1, 2]
    assert res[0]["score"] >= res[1]["score"]


def test_paging_and_info(spark):
    m, _ = _model(spark)
    qw = se.query_weights(spark, "apple", m.vocab)
    matches = se.ranked(se.scores(m.weights, qw), 0.1)
    total = matches.count()
    p2 = se.page(matches, 2, 2).collect()
    assert [r["rank"] for r in p2] == list(range(3, 3 + len(p2)))
    info = se.page_info(matches, 2, 2).first()
    assert info["total_results"] == total and info["has_prev"] and info["total_pages"] == -(-total // 2)
    assert se.page(matches, 99, 2).count() == 0


def test_batch_equals_single(spark):
    m, _ = _model(spark)
    qs = spark.createDataFrame([(7, "red apple"), (8, "sky")], "query_id long, query string")
    batch = {(r["query_id"], r["id"]): r["score"] for r in se.batch_scores(m.weights, qs, m.vocab).collect()}
    single = se.ranked(se.scores(m.weights, se.query_weights(spark, "red apple", m.vocab)))
    for r in single.collect():
        assert abs(batch[(7, r["id"])] - r["score"]) < 1e-12


def test_batch_pages_and_info_match_the_single_ones(spark):
    m, _ = _model(spark)
    qs = spark.createDataFrame([(7, "apple"), (8, "sky"), (9, "zzz")], "query_id long, query string")
    matches = se.batch_scores(m.weights, qs, m.vocab)
    assert matches.columns == ["query_id", "id", "score"]
    single = se.ranked(se.scores(m.weights, se.query_weights(spark, "apple", m.vocab)))
    want = [(r["rank"], r["id"]) for r in se.page(single, 2, 2).collect()]
    page = se.batch_page(matches, 2, 2).filter("query_id = 7").collect()
    assert sorted((r["rank"], r["id"]) for r in page) == want
    info = {r["query_id"]: r for r in se.batch_page_info(matches, qs, 1, 2).collect()}
    assert info[9]["total_results"] == 0 and info[9]["total_pages"] == 0 and not info[9]["has_next"]
    assert info[7]["total_results"] == single.count()


def test_stored_index_answers_like_the_model_and_pushes_its_filters(spark, tmp_path):
    m, df = _model(spark)
    io.save_index(m, str(tmp_path / "ix"), partitions=2)
    ix = io.load_index(spark, str(tmp_path / "ix"))
    assert ix.n_docs == len(DOCS) and ix.max_features == 10_000
    for q in ("red apple", "sky", "zzz"):
        a = {r["id"]: round(r["score"], 9) for r in se.query_scores(spark, q, m).collect()}
        b = {r["id"]: round(r["score"], 9) for r in se.query_scores(spark, q, ix).collect()}
        assert a == b
    plan = se.query_scores(spark, "red apple", ix)._jdf.queryExecution().executedPlan().toString()
    assert "In(term, [apple,red])" in plan or "In(term, [red,apple])" in plan
    speeches = df.selectExpr("id", "merged_speech", "'x' AS member_name", "'p' AS political_party",
                             "'1' AS parliamentary_period", "'1' AS parliamentary_session",
                             "'1' AS parliamentary_sitting", "DATE'2000-01-01' AS sitting_date")
    speeches.write.parquet(str(tmp_path / "speeches"))
    out = se.search(spark, "red apple", ix, spark.read.parquet(str(tmp_path / "speeches")), per_page=2)
    assert "PushedFilters: [In(id" in out._jdf.queryExecution().executedPlan().toString()
    assert [r["rank"] for r in out.collect()] == [1, 2]


def test_postings_of_one_term_spread_over_files(spark, tmp_path):
    post = spark.range(20_000).selectExpr("'hot' AS term", "id", "1.0D AS weight")
    io.save_postings(post, str(tmp_path / "hot"), partitions=8)
    assert len(list((tmp_path / "hot").glob("part-*"))) >= 4
