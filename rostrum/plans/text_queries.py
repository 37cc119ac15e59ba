"""Registered queries: normalisation, TF-IDF and keywords (C, D, E1-E5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from rostrum.functions import text as tx
from rostrum.operators import keywords as kw
from rostrum.operators import tfidf
from rostrum.plans import corpora
from rostrum.plans import sql_parts as sp
from rostrum.plans.registry import query
from rostrum.sources import fixtures as fx

R = 6  # output rounding

_CORE = sp.speech_corpus_ctes()


def _sql(*ctes: str, body: str) -> str:
    return sp.with_(*ctes) + body


def _docs(spark, sf):
    return fx.merged_speeches(spark, sf).dropna(subset=["merged_speech"])


# ------------------------------------------------------------------ C1-C4


def _count_tokens(df, col):
    return df.select("id", F.explode(col).alias("token")).groupBy("id", "token").agg(F.count("*").alias("cnt"))


@query("tokenize", _sql(fx.sql_merged(), body=r"""
SELECT id, token, count(*) AS cnt FROM (
  SELECT id, regexp_replace(raw, '[0-9_]', '', 'g') AS token FROM (
    SELECT id, unnest(regexp_extract_all(merged_speech, '[\p{L}\p{N}_]+')) AS raw
    FROM merged WHERE merged_speech IS NOT NULL))
GROUP BY id, token"""))
def q_tokenize(spark, sf):
    d = _docs(spark, sf)
    return _count_tokens(d.select("id", tx.clean_tokens(tx.raw_tokens("merged_speech")).alias("t")), "t")


@query("remove_stopwords", _sql(fx.sql_merged(), body=r"""
SELECT id, token, count(*) AS cnt FROM (
  SELECT id, regexp_replace(raw, '[0-9_]', '', 'g') AS token FROM (
    SELECT id, unnest(regexp_extract_all(merged_speech, '[\p{L}\p{N}_]+')) AS raw
    FROM merged WHERE merged_speech IS NOT NULL))
WHERE length(token) >= 2 AND lower(token) NOT IN (""" + fx.sql_stopwords() + """)
GROUP BY id, token"""))
def q_remove_stopwords(spark, sf):
    d = _docs(spark, sf)
    t = tx.keep_tokens(tx.clean_tokens(tx.raw_tokens("merged_speech")), fx.FIX_STOPWORDS)
    return _count_tokens(d.select("id", t.alias("t")), "t")


@query("stem_tokens", _sql(fx.sql_merged(), fx.sql_stems(), sp.tokens_cte("dtok", "merged", "id", "merged_speech"),
                           body="SELECT id, term AS token, count(*) AS cnt FROM dtok GROUP BY id, term"))
def q_stem_tokens(spark, sf):
    d = _docs(spark, sf)
    tok = tfidf.tokenize(d, stopwords=fx.FIX_STOPWORDS, stems=corpora.stems(spark, sf))
    return _count_tokens(tok, "tokens")


def _duck_normalize_list(text: str) -> str:
    stems = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in sorted(fx.FIX_STEMS.items()))
    toks = f"list_transform(regexp_extract_all({text}, '{sp.TOKEN_RE}'), lambda x: regexp_replace(x, '[0-9_]', '', 'g'))"
    kept = f"list_filter({toks}, lambda x: length(x) >= 2 AND lower(x) NOT IN ({fx.sql_stopwords()}))"
    stemmed = f"list_transform({kept}, lambda x: CASE lower(x) {stems} ELSE lower(x) END)"
    return f"list_filter({stemmed}, lambda x: length(x) > 0)"


@query("normalize_documents", _sql(fx.sql_merged(), body=f"""
SELECT id, array_to_string({_duck_normalize_list('merged_speech')}, ' ') AS normalized
FROM merged WHERE merged_speech IS NOT NULL"""))
def q_normalize_documents(spark, sf):
    d = _docs(spark, sf)
    return d.select("id", tx.joined(tx.normalize("merged_speech", fx.FIX_STOPWORDS, fx.FIX_STEMS)).alias("normalized"))


# ------------------------------------------------------------------ D2-D8


@query("term_counts", _sql(*_CORE, body="SELECT id, term, tf FROM d_post"))
def q_term_counts(spark, sf):
    return corpora.speech_model(spark, sf).postings


@query("doc_freq", _sql(*_CORE, body="SELECT term, df, ctf FROM d_df"))
def q_doc_freq(spark, sf):
    return tfidf.doc_freq(corpora.speech_model(spark, sf).postings)


@query("vocabulary", _sql(*_CORE, body="SELECT term, term_id, df, ctf FROM d_vocab"))
def q_vocabulary(spark, sf):
    return corpora.speech_model(spark, sf).vocab.select("term", "term_id", "df", "ctf")


@query("idf", _sql(*_CORE, body=f"SELECT term, round(idf, {R}) AS idf FROM d_vocab"))
def q_idf(spark, sf):
    return corpora.speech_model(spark, sf).vocab.select("term", F.round("idf", R).alias("idf"))


@query("tfidf_documents", _sql(*_CORE, body=f"SELECT id, term, tf, round(weight, {R}) AS weight FROM d_w"))
def q_tfidf_documents(spark, sf):
    w = corpora.speech_model(spark, sf).weights
    return w.select("id", "term", "tf", F.round("weight", R).alias("weight"))


_MEMBER = [
    fx.sql_merged("source_lang"),
    fx.sql_stems(),
    sp.tokens_cte("mtok", "merged", "id", "merged_speech", extra="member_name"),
]


@query("member_documents", _sql(*_MEMBER, body="""
SELECT member_name, term, count(*) AS tf FROM mtok WHERE member_name IS NOT NULL AND length(term) >= 2
GROUP BY member_name, term"""))
def q_member_documents(spark, sf):
    return corpora.member_model(spark, sf).postings.select("member_name", "term", F.col("tf").cast("long"))


_MEMBER_TFIDF = _MEMBER + [
    sp.tfidf_ctes("m", "(SELECT * FROM mtok WHERE member_name IS NOT NULL)", "member_name",
                  "SELECT count(DISTINCT member_name) FROM merged WHERE merged_speech IS NOT NULL "
                  "AND member_name IS NOT NULL"),
]


@query("tfidf_members", _sql(*_MEMBER_TFIDF, body=f"""
SELECT member_name, term, tf, round(weight, {R}) AS weight FROM m_w"""))
def q_tfidf_members(spark, sf):
    w = corpora.member_model(spark, sf).weights
    return w.select("member_name", "term", F.col("tf").cast("long"), F.round("weight", R).alias("weight"))


# ------------------------------------------------------------------ D9-D19, E1-E5

_KW = _CORE + sp.keyword_ctes()


@query("keywords_per_doc", _sql(*_KW, body=f"""
SELECT id, CAST(rank AS INTEGER) AS rank, keyword, round(score, {R}) AS score FROM kw WHERE rank <= 10"""))
def q_keywords_per_doc(spark, sf):
    k = kw.keywords_per_doc(corpora.speech_model(spark, sf).weights, fx.FIX_BLOCKLIST)
    return k.select("id", "rank", "keyword", F.round("score", R).alias("score"))


@query("attach_metadata", _sql(*_KW, body=f"""
SELECT id, CAST(rank AS INTEGER) AS rank, keyword, round(score, {R}) AS score, member_name, political_party,
       sitting_date FROM kwmeta"""))
def q_attach_metadata(spark, sf):
    k = corpora.keyword_rows(spark, sf)
    return k.select("id", "rank", "keyword", F.round("score", R).alias("score"), "member_name", "political_party",
                    "sitting_date")


_DETAILS_SQL = "details AS (SELECT * FROM merged WHERE political_party IS NOT NULL)"


def _details(spark, sf):
    return fx.merged_speeches(spark, sf).filter(F.col("political_party").isNotNull())


@query("missing_ids", _sql(*_CORE, _DETAILS_SQL, body="""
SELECT DISTINCT id FROM d_w WHERE id NOT IN (SELECT id FROM details)"""))
def q_missing_ids(spark, sf):
    ids = corpora.speech_model(spark, sf).weights.select("id").distinct()
    return kw.missing_ids(ids, _details(spark, sf))


@query("postings_subset", _sql(*_CORE, _DETAILS_SQL, body=f"""
SELECT id, term, round(weight, {R}) AS weight FROM d_w WHERE id IN (SELECT id FROM details)"""))
def q_postings_subset(spark, sf):
    w = corpora.speech_model(spark, sf).weights
    kept = w.join(_details(spark, sf).select("id"), "id", "left_semi")
    return kept.select("id", "term", F.round("weight", R).alias("weight"))


def _group_top_sql(group: str) -> str:
    return f"""g_{group} AS (
  SELECT {group}, keyword, score,
         row_number() OVER (PARTITION BY {group} ORDER BY round(score, 9) DESC, keyword ASC) AS rank
  FROM (SELECT {group}, keyword, sum(score) AS score FROM kwmeta WHERE {group} IS NOT NULL GROUP BY ALL))"""


@query("keywords_per_member", _sql(*_KW, _group_top_sql("member_name"), body=f"""
SELECT member_name, CAST(rank AS INTEGER) AS rank, keyword, round(score, {R}) AS score
FROM g_member_name WHERE rank <= 10"""))
def q_keywords_per_member(spark, sf):
    t = kw.top_keywords_by_group(corpora.keyword_rows(spark, sf), "member_name")
    return t.select("member_name", "rank", "keyword", F.round("score", R).alias("score"))


@query("keywords_per_party", _sql(*_KW, _group_top_sql("political_party"), body=f"""
SELECT political_party, CAST(rank AS INTEGER) AS rank, keyword, round(score, {R}) AS score
FROM g_political_party WHERE rank <= 10"""))
def q_keywords_per_party(spark, sf):
    t = kw.top_keywords_by_group(corpora.keyword_rows(spark, sf), "political_party")
    return t.select("political_party", "rank", "keyword", F.round("score", R).alias("score"))


@query("keyword_counts", _sql(*_KW, _group_top_sql("member_name"), _group_top_sql("political_party"), body="""
SELECT 'member' AS group_type, member_name AS group_name, count(*) AS n_keywords
FROM g_member_name WHERE rank <= 10 GROUP BY member_name
UNION ALL
SELECT 'party', political_party, count(*) FROM g_political_party WHERE rank <= 10 GROUP BY political_party"""))
def q_keyword_counts(spark, sf):
    rows = corpora.keyword_rows(spark, sf)
    out = []
    for kind, g in (("member", "member_name"), ("party", "political_party")):
        c = kw.keyword_counts(kw.top_keywords_by_group(rows, g), g)
        out.append(c.select(F.lit(kind).alias("group_type"), F.col(g).alias("group_name"), "n_keywords"))
    return out[0].unionByName(out[1])


def _trend_sql(group: str) -> str:
    return f"""t_{group} AS (
  SELECT k.{group}, k.sitting_year, k.keyword, sum(k.score) AS score
  FROM kwmeta k JOIN (SELECT {group}, keyword FROM g_{group} WHERE rank <= 10) g USING ({group}, keyword)
  GROUP BY ALL)"""


@query("member_keyword_trends", _sql(*_KW, _group_top_sql("member_name"), _trend_sql("member_name"), body=f"""
SELECT member_name, sitting_year, keyword, round(score, {R}) AS score FROM t_member_name"""))
def q_member_keyword_trends(spark, sf):
    rows = corpora.keyword_rows(spark, sf)
    t = kw.group_keyword_trends(rows, kw.top_keywords_by_group(rows, "member_name"), "member_name")
    return t.select("member_name", "sitting_year", "keyword", F.round("score", R).alias("score"))


@query("party_keyword_trends", _sql(*_KW, _group_top_sql("political_party"), _trend_sql("political_party"), body=f"""
SELECT political_party, sitting_year, keyword, round(score, {R}) AS score FROM t_political_party"""))
def q_party_keyword_trends(spark, sf):
    rows = corpora.keyword_rows(spark, sf)
    t = kw.group_keyword_trends(rows, kw.top_keywords_by_group(rows, "political_party"), "political_party")
    return t.select("political_party", "sitting_year", "keyword", F.round("score", R).alias("score"))


TOP_PER_YEAR_SQL = _sql(*_KW, body=f"""
SELECT sitting_year, keyword, round(score, {R}) AS score, CAST(rank AS INTEGER) AS rank FROM (
  SELECT sitting_year, keyword, score,
         row_number() OVER (PARTITION BY sitting_year ORDER BY round(score, 9) DESC, keyword ASC) AS rank
  FROM (SELECT sitting_year, keyword, sum(score) AS score FROM kwmeta GROUP BY ALL))
WHERE rank <= 10""")


def top_keywords_per_year(spark, sf):
    t = kw.top_keywords_per_year(corpora.keyword_rows(spark, sf))
    return t.select("sitting_year", "keyword", F.round("score", R).alias("score"), "rank")


query("top_keywords_per_year", TOP_PER_YEAR_SQL)(top_keywords_per_year)

_OVERALL_SQL = """ov AS (
  SELECT keyword, score, row_number() OVER (ORDER BY round(score, 9) DESC, keyword ASC) AS rank
  FROM (SELECT keyword, sum(score) AS score FROM kwmeta GROUP BY keyword))"""


@query("top_keywords_overall", _sql(*_KW, _OVERALL_SQL, body=f"""
SELECT CAST(rank AS INTEGER) AS rank, keyword, round(score, {R}) AS score FROM ov WHERE rank <= 10"""))
def q_top_keywords_overall(spark, sf):
    t = kw.top_keywords_overall(corpora.keyword_rows(spark, sf))
    return t.select("rank", "keyword", F.round("score", R).alias("score"))


_OVERALL_TREND_SQL = """ovt AS (
  SELECT sitting_year, keyword, sum(score) AS score FROM kwmeta
  WHERE keyword IN (SELECT keyword FROM ov WHERE rank <= 10) GROUP BY ALL)"""


@query("overall_keyword_trend", _sql(*_KW, _OVERALL_SQL, _OVERALL_TREND_SQL, body=f"""
SELECT sitting_year, keyword, round(score, {R}) AS score FROM ovt"""))
def q_overall_keyword_trend(spark, sf):
    rows = corpora.keyword_rows(spark, sf)
    t = kw.overall_keyword_trend(rows, kw.top_keywords_overall(rows))
    return t.select("sitting_year", "keyword", F.round("score", R).alias("score"))


def _pivot_long_sql(src: str) -> str:
    return f"""SELECT y.sitting_year, k.keyword, CAST(k.rank AS INTEGER) AS rank, round(coalesce(s.score, 0), {R}) AS score
FROM (SELECT DISTINCT sitting_year FROM {src} WHERE keyword IN (SELECT keyword FROM pk)) y
CROSS JOIN pk k
LEFT JOIN (SELECT sitting_year, keyword, sum(score) AS score FROM {src} GROUP BY ALL) s
  ON s.sitting_year = y.sitting_year AND s.keyword = k.keyword"""


def _pivot_top_sql(src: str) -> str:
    return f"""pk AS (
  SELECT keyword, row_number() OVER (ORDER BY round(t, 9) DESC, keyword ASC) AS rank
  FROM (SELECT keyword, sum(score) AS t FROM {src} GROUP BY keyword) QUALIFY rank <= 10)"""


def _group_pivot(spark, sf, group):
    rows = corpora.keyword_rows(spark, sf)
    trends = kw.group_keyword_trends(rows, kw.top_keywords_by_group(rows, group), group)
    out = kw.trend_matrix(trends, kw.top_of_trends(trends))
    return out.withColumn("score", F.round("score", R))


@query("member_trend_pivot", _sql(*_KW, _group_top_sql("member_name"), _trend_sql("member_name"),
                                  _pivot_top_sql("t_member_name"), body=_pivot_long_sql("t_member_name")))
def q_member_trend_pivot(spark, sf):
    return _group_pivot(spark, sf, "member_name")


@query("party_trend_pivot", _sql(*_KW, _group_top_sql("political_party"), _trend_sql("political_party"),
                                 _pivot_top_sql("t_political_party"), body=_pivot_long_sql("t_political_party")))
def q_party_trend_pivot(spark, sf):
    return _group_pivot(spark, sf, "political_party")


@query("overall_trend_pivot", _sql(*_KW, _OVERALL_SQL, _OVERALL_TREND_SQL,
                                   "pk AS (SELECT keyword, rank FROM ov WHERE rank <= 10)",
                                   body=_pivot_long_sql("ovt")))
def q_overall_trend_pivot(spark, sf):
    rows = corpora.keyword_rows(spark, sf)
    top = kw.top_keywords_overall(rows)
    out = kw.trend_matrix(kw.overall_keyword_trend(rows, top), top.select("rank", "keyword"))
    return out.withColumn("score", F.round("score", R))
