import math
import re

import duckdb

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = ["documents", "conversations", "benchmark", "embeddings", "labels"]
SAMPLE = ["fetch_by_ids", "speech_polarity", "stem_tokens", "tfidf_documents", "top_keywords_per_year", "search", "batch_search", "search_page", "search_page_info", "union_chunks", "restore_order", "member_similarity",
          "lexicon_stemmed", "polarity_trend", "top_positive_words", "merge_speeches", "assign_clusters", "silhouette",
          "scan_by_date", "party_trend_pivot", "svd_product", "svd_traces", "nmf_iterations", "kmeans_steps"]


def _norm(v):
    if isinstance(v, float):
        return f"{round(v, 6):.6f}"
    return repr(v.isoformat() if hasattr(v, "isoformat") else v)


def _rows(cols, recs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in recs)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert set(df.columns) == {"sitting_year", "keyword", "score", "rank"}


def test_every_query_has_oracle_or_is_iterative():
    rows_only = {q for q in set(E.queries()) - set(E.oracle_sql()) if not re.fullmatch(r"op\d+_\w+|pipeline", q)}
    assert rows_only == {
        "lsi_vectors", "lsi_concepts", "lsi_variance", "nmf_vectors", "nmf_concepts", "kmeans_lsi", "kmeans_nmf",
        "kmeans_sweep_lsi", "kmeans_sweep_nmf", "lsi_cluster_report", "nmf_cluster_report"}


def test_sample_against_duckdb(spark):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    qs, oracles = E.queries(), E.oracle_sql()
    for name in SAMPLE:
        df = qs[name](spark, SF)
        got = _rows(df.columns, [tuple(r) for r in df.collect()])
        res = con.execute(oracles[name])
        exp = _rows([d[0] for d in res.description], res.fetchall())
        assert got == exp, name
