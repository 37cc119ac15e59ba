"""Registered queries: search (G1-G7) and speech lookup."""

from __future__ import annotations

from pyspark.sql import functions as F

from rostrum.functions import text as tx
from rostrum.operators import impact
from rostrum.operators import search as se
from rostrum.plans import corpora
from rostrum.plans import sql_parts as sp
from rostrum.plans.registry import query
from rostrum.sources import fixtures as fx

R = 6
_CORE = sp.speech_corpus_ctes()
_Q = fx.FIX_SEARCH_QUERY.replace("'", "''")


def _sql(*ctes: str, body: str) -> str:
    return sp.with_(*ctes) + body


def _query_ctes(name: str, src: str) -> list[str]:
    """Query text(s) ``src``(id, text) -> ``{name}_w``(id, term, qweight)."""
    return [
        f"{name}_src AS {src}",
        sp.tokens_cte(f"{name}_tok", f"{name}_src", "id", "text"),
        f"""{name}_post AS (SELECT id, term, count(*) AS tf FROM {name}_tok WHERE length(term) >= 2 GROUP BY id, term),
{name}_w0 AS (SELECT p.id, p.term, p.tf * v.idf AS w FROM {name}_post p JOIN d_vocab v USING (term)),
{name}_w AS (SELECT id, term, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS qweight FROM {name}_w0)""",
    ]


def _scores_cte(name: str, q: str) -> str:
    return f"""{name} AS (SELECT d.id, sum(d.weight * q.qweight) AS score FROM d_w d JOIN {q}_w q USING (term)
  GROUP BY d.id)"""


_SHORT = _CORE + _query_ctes("q", f"(SELECT 0 AS id, '{_Q}' AS text)") + [_scores_cte("sc", "q")]
_BATCH = _CORE + _query_ctes("bq", "(SELECT item_id AS id, text FROM benchmark)") + ["""bm AS (
  SELECT * FROM (SELECT q.id AS query_id, d.id, sum(d.weight * q.qweight) AS score
                 FROM d_w d JOIN bq_w q USING (term) GROUP BY q.id, d.id)
  WHERE round(score, 9) >= 0.1)""", """br AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, id ASC) AS rank FROM bm)"""]
TOP_K = 100


@query("search_scores", _sql(*_SHORT, body=f"SELECT id, round(score, {R}) AS score FROM sc"))
def q_search_scores(spark, sf):
    sc = se.query_scores(spark, fx.FIX_SEARCH_QUERY, corpora.search_index(spark, sf), fx.FIX_STOPWORDS,
                         corpora.stems(spark, sf))
    return sc.select("id", F.round("score", R).alias("score"))


def _matches(spark, sf, top_k=None):
    ix = corpora.search_index(spark, sf)
    return se.batch_scores(ix.weights, fx.search_queries(spark, sf), ix.vocab, fx.FIX_STOPWORDS,
                           corpora.stems(spark, sf), ix.max_features, top_k=top_k, blocks=ix.blocks, documents=ix.documents)


@query("search_ranked", _sql(*_BATCH, body=f"SELECT query_id, id, round(score, {R}) AS score FROM bm"))
def q_search_ranked(spark, sf):
    return _matches(spark, sf).select("query_id", "id", F.round("score", R).alias("score"))


@query("search_page", _sql(*_BATCH, body=f"""
SELECT query_id, CAST(rank AS INTEGER) AS rank, id, round(score, {R}) AS score FROM br
WHERE rank > 10 AND rank <= 20"""))
def q_search_page(spark, sf):
    return se.batch_page(_matches(spark, sf), page_no=2, per_page=10).select(
        "query_id", "rank", "id", F.round("score", R).alias("score"))


@query("search_page_info", _sql(*_BATCH, body="""
SELECT b.item_id AS query_id, count(m.id) AS total_results,
       CAST(ceil(count(m.id) / 10.0) AS BIGINT) AS total_pages,
       2 < CAST(ceil(count(m.id) / 10.0) AS BIGINT) AS has_next, true AS has_prev
FROM benchmark b LEFT JOIN bm m ON m.query_id = b.item_id GROUP BY b.item_id"""))
def q_search_page_info(spark, sf):
    return se.batch_page_info(_matches(spark, sf), fx.search_queries(spark, sf), page_no=2, per_page=10)


_EXCERPT = (f"CASE WHEN length(merged_speech) <= 20 THEN merged_speech ELSE "
            f"regexp_replace(substring(merged_speech, 1, 20), '{tx.STRIP_PATTERN}', '', 'g') || '...' END")


@query("search", _sql(*_SHORT, body=f"""
SELECT CAST(p.rank AS INTEGER) AS rank, p.id, {_EXCERPT} AS merged_speech,
       CASE WHEN m.member_name IS NULL OR m.member_name = '' THEN 'Unknown' ELSE m.member_name END AS member_name,
       m.political_party, round(p.score, {R}) AS score, m.parliamentary_period, m.parliamentary_session,
       m.parliamentary_sitting, m.sitting_date
FROM (SELECT id, score, row_number() OVER (ORDER BY round(score, 9) DESC, id ASC) AS rank
      FROM sc WHERE round(score, 9) >= 0.1) p JOIN merged m USING (id)
WHERE p.rank <= 10"""))
def q_search(spark, sf):
    m = corpora.search_index(spark, sf)
    out = se.search(spark, fx.FIX_SEARCH_QUERY, m, fx.merged_speeches(spark, sf), 1, 10, 0.1,
                    fx.FIX_STOPWORDS, corpora.stems(spark, sf))
    return out.withColumn("score", F.round("score", R))


@query("batch_search", _sql(*_BATCH, body=f"""
SELECT query_id, id, round(score, {R}) AS score, CAST(rank AS INTEGER) AS rank FROM br WHERE rank <= {TOP_K}"""))
def q_batch_search(spark, sf):
    return _matches(spark, sf, TOP_K).select("query_id", "id", F.round("score", R).alias("score"), "rank")


@query("batch_search_blocks", _sql(*_BATCH, body=f"""
SELECT query_id, id, round(score, {R}) AS score, CAST(rank AS INTEGER) AS rank FROM br WHERE rank <= 10"""))
def q_batch_search_blocks(spark, sf):
    """The best ten of every item by skipping blocks, whatever the tables' size."""
    ix = corpora.search_index(spark, sf)
    qw = se.batch_weights(fx.search_queries(spark, sf), ix.vocab, fx.FIX_STOPWORDS, corpora.stems(spark, sf), ix.max_features)
    found = impact.matches(qw, ix.blocks, ix.weights, 0.1, top_k=10, gain=0, small=0, documents=ix.documents)
    return se.batch_top(se.ranked(found), 10).select("query_id", "id", F.round("score", R).alias("score"), "rank")


_L = fx.FIX_LOOKUP


@query("lookup_speech", _sql(fx.sql_merged(), body=f"""
SELECT id, member_name, parliamentary_period, parliamentary_session, parliamentary_sitting, sitting_date,
       merged_speech
FROM merged
WHERE parliamentary_period = '{_L["period"]}' AND parliamentary_session = '{_L["session"]}'
  AND parliamentary_sitting = '{_L["sitting"]}' AND sitting_date = DATE '{_L["date"]}'
  AND member_name LIKE '{_L["member_like"]}'
ORDER BY id LIMIT 1"""))
def q_lookup_speech(spark, sf):
    return se.lookup_speech(fx.merged_speeches(spark, sf), _L["period"], _L["session"], _L["sitting"], _L["date"],
                            _L["member_like"])
