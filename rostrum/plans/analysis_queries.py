"""Registered queries: member pairs (E9-E14), lexicon (F4-F8), sentiment
(F1-F3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from rostrum.operators import lexicon as lx
from rostrum.operators import sentiment as st
from rostrum.operators import similarity as sim
from rostrum.operators import tfidf
from rostrum.plans import corpora
from rostrum.plans import sql_parts as sp
from rostrum.plans.registry import query
from rostrum.plans.text_queries import _MEMBER_TFIDF
from rostrum.session import stored
from rostrum.sources import fixtures as fx

R = 6


def _sql(*ctes: str, body: str) -> str:
    return sp.with_(*ctes) + body


# ------------------------------------------------------------------ E9-E14

_PAIRS = """pairs AS (
  SELECT a.member_name AS member1, b.member_name AS member2, sum(a.weight * b.weight) AS similarity
  FROM m_w a JOIN m_w b ON a.term = b.term AND a.member_name < b.member_name GROUP BY 1, 2)"""


@query("member_similarity", _sql(*_MEMBER_TFIDF, _PAIRS, body=f"""
SELECT member1, member2, round(similarity, {R}) AS similarity FROM pairs"""))
def q_member_similarity(spark, sf):
    w = corpora.member_model(spark, sf).weights
    return sim.member_pairs(w, members_per_block=32).withColumn("similarity", F.round("similarity", R))


def _parties_sql(name: str) -> str:
    return f"""{name} AS (
  SELECT member_name AS member,
         CASE WHEN len(list_distinct(list(political_party))) > 0
              THEN array_to_string(list_sort(list_distinct(list(political_party))), ', ') ELSE 'Unknown' END AS parties
  FROM merged WHERE member_name IS NOT NULL GROUP BY member_name)"""


@query("member_parties", _sql(fx.sql_merged(), _parties_sql("mp"), body="SELECT member, parties FROM mp"))
def q_member_parties(spark, sf):
    return sim.member_parties(fx.merged_speeches(spark, sf))


@query("top_member_pairs", _sql(*_MEMBER_TFIDF, _PAIRS, _parties_sql("mp"), body="""
SELECT CAST(t.rank AS INTEGER) AS rank, t.member1, coalesce(p1.parties, 'Unknown') AS member1_parties,
       t.member2, coalesce(p2.parties, 'Unknown') AS member2_parties, round(t.similarity, 4) AS similarity
FROM (SELECT *, row_number() OVER (ORDER BY round(similarity, 9) DESC, member1, member2) AS rank FROM pairs) t
LEFT JOIN mp p1 ON p1.member = t.member1 LEFT JOIN mp p2 ON p2.member = t.member2
WHERE t.rank <= 10"""))
def q_top_member_pairs(spark, sf):
    w = corpora.member_model(spark, sf).weights
    return sim.top_member_pairs(w, fx.merged_speeches(spark, sf, member="source_lang"), k=10, members_per_block=32)


# ------------------------------------------------------------------ F4-F8


def _duck_terms(expr: str) -> str:
    toks = f"regexp_extract_all({expr}, '{sp.TOKEN_RE}')"
    kept = f"list_filter({toks}, lambda x: length(x) >= 2 AND lower(x) NOT IN ({fx.sql_stopwords()}))"
    return f"list_transform({kept}, lambda x: lower(x))"


_W1 = "string_split(lower(term), ' ')[1]"
_LEX_CTES = [
    fx.sql_stems(),
    fx.sql_lexicon(),
    f"""lclean AS (
  SELECT pos, term, polarity1, polarity2, polarity3, polarity4,
         CASE WHEN contains(lower(term), ' ') THEN array_to_string(list_concat([{_W1}],
              list_transform(string_split(replace(string_split(lower(term), ' ')[2], ' ', ''), '-')[2:],
                             lambda e: substring({_W1}, 1, greatest(length({_W1}) - 2, 0)) || e)), ',')
              ELSE lower(term) END AS cleaned
  FROM lexrows)""",
    """lkeys AS (
  SELECT cleaned, min(pos) AS fpos,
         arg_max({'polarity1': polarity1, 'polarity2': polarity2, 'polarity3': polarity3, 'polarity4': polarity4},
                 pos) AS vals
  FROM lclean GROUP BY cleaned)""",
    """lsingle AS (SELECT cleaned AS form, fpos AS s_fpos, vals AS s_vals FROM lkeys WHERE NOT contains(cleaned, ','))""",
    """llist AS (
  SELECT fpos, vals, unnest(string_split(cleaned, ',')) AS form,
         unnest(range(0, len(string_split(cleaned, ',')))) AS idx
  FROM lkeys WHERE contains(cleaned, ','))""",
    """lfrom AS (
  SELECT form, arg_max(vals, fpos) AS l_vals, min({'fpos': fpos, 'idx': idx}) AS first FROM llist GROUP BY form)""",
    "lforms AS (SELECT coalesce(s.form, l.form) AS form, CASE WHEN s.s_fpos IS NOT NULL THEN 0 ELSE 1 END AS grp,\n"
    "  coalesce(s.s_fpos, l.first.fpos) AS fpos, CAST(CASE WHEN s.s_fpos IS NOT NULL THEN 0 ELSE l.first.idx END AS INTEGER) AS idx,\n"
    + ",\n".join(f"  CASE WHEN l.l_vals IS NOT NULL THEN l.l_vals.{c} ELSE s.s_vals.{c} END AS {c}" for c in lx.POLARITY_COLS)
    + "\n  FROM lsingle s FULL OUTER JOIN lfrom l ON s.form = l.form)",
    "lpol AS (SELECT *, (" + " + ".join(
        f"(CASE {c} WHEN 'POS' THEN 1 WHEN 'NEG' THEN -1 ELSE 0 END)" for c in lx.POLARITY_COLS)
    + ") / 4.0 AS polarity FROM lforms)",
    f"""lftok AS (
  SELECT form, unnest(kept) AS tok, unnest(range(0, len(kept))) AS i
  FROM (SELECT form, {_duck_terms('form')} AS kept FROM lpol))""",
    """lfstem AS (
  SELECT form, string_agg(coalesce(sd.stem, tok), ' ' ORDER BY i) AS stem
  FROM lftok LEFT JOIN stemdict sd ON sd.token = tok WHERE length(coalesce(sd.stem, tok)) > 0 GROUP BY form)""",
    "lstem AS (SELECT lpol.*, coalesce(f.stem, '') AS stem FROM lpol LEFT JOIN lfstem f ON f.form = lpol.form)",
    """lexicon AS (
  SELECT stem, list_reduce(list(polarity ORDER BY grp, fpos, idx), lambda a, b: (a + b) / 2) AS polarity
  FROM lstem WHERE length(stem) > 0 GROUP BY stem)""",
]


def _forms(spark, sf):
    return lx.average_polarity(lx.expand_forms(lx.clean_terms(fx.lexicon_rows(spark, sf))))


@query("lexicon_clean", _sql(*_LEX_CTES, body="SELECT pos, term, cleaned FROM lclean"))
def q_lexicon_clean(spark, sf):
    return lx.clean_terms(fx.lexicon_rows(spark, sf)).select("pos", "term", "cleaned")


@query("lexicon_expand", _sql(*_LEX_CTES, body="""
SELECT form, grp, fpos, idx, polarity1, polarity2, polarity3, polarity4 FROM lforms"""))
def q_lexicon_expand(spark, sf):
    return lx.expand_forms(lx.clean_terms(fx.lexicon_rows(spark, sf)))


@query("lexicon_polarity", _sql(*_LEX_CTES, body="SELECT form, polarity FROM lpol"))
def q_lexicon_polarity(spark, sf):
    return _forms(spark, sf).select("form", "polarity")


@query("lexicon_stemmed", _sql(*_LEX_CTES, body=f"SELECT stem, round(polarity, {R}) AS polarity FROM lexicon"))
def q_lexicon_stemmed(spark, sf):
    lex = lx.merge_stems(lx.stem_forms(_forms(spark, sf), fx.FIX_STOPWORDS, corpora.stems(spark, sf)))
    return lex.select("stem", F.round("polarity", R).alias("polarity"))


@query("lexicon_rejects", _sql(*_LEX_CTES, body="SELECT form FROM lstem WHERE length(stem) = 0"))
def q_lexicon_rejects(spark, sf):
    return lx.rejects(lx.stem_forms(_forms(spark, sf), fx.FIX_STOPWORDS, corpora.stems(spark, sf)))


# ------------------------------------------------------------------ F1-F3

_SEL = ", ".join(f"'{p}'" for p in fx.FIX_SELECTED_PARTIES)
_SENT_CTES = [
    fx.sql_merged(), fx.SQL_DATED_SPEECHES, fx.sql_party_map(), *_LEX_CTES,
    """std AS (SELECT s.*, coalesce(p.canonical, 'Other') AS standard_party
  FROM sent s LEFT JOIN partymap p ON p.raw = lower(s.political_party))""",
    f"""ssel AS (
  SELECT id, standard_party, CAST(year(TRY_CAST(sitting_date AS TIMESTAMP)) AS INTEGER) AS year, merged_speech
  FROM std WHERE standard_party IN ({_SEL}) AND TRY_CAST(sitting_date AS TIMESTAMP) IS NOT NULL)""",
    sp.tokens_cte("stoks", "ssel", "id", "merged_speech", drop_null=False, extra="standard_party, year"),
    """spol AS (
  SELECT s.id, s.standard_party, s.year, coalesce(avg(l.polarity), 0) AS polarity
  FROM ssel s LEFT JOIN stoks t ON t.id = s.id LEFT JOIN lexicon l ON l.stem = t.term
  GROUP BY s.id, s.standard_party, s.year)""",
    "strend AS (SELECT standard_party, year, avg(polarity) AS polarity FROM spol GROUP BY ALL)",
]


def _sent_tokens(spark, sf):
    lex = tfidf.to_all_tasks(lx.prepare(fx.lexicon_rows(spark, sf), fx.FIX_STOPWORDS, corpora.stems(spark, sf)), "lexicon")
    toks = st.party_speech_terms(fx.dated_speeches(spark, sf), fx.FIX_PARTY_MAP, fx.FIX_SELECTED_PARTIES,
                                  fx.FIX_STOPWORDS, corpora.stems(spark, sf), lex)
    return toks, lex


@query("speech_polarity", _sql(*_SENT_CTES, body=f"""
SELECT id, standard_party, year, round(polarity, {R}) AS polarity FROM spol"""))
def q_speech_polarity(spark, sf):
    toks, lex = _sent_tokens(spark, sf)
    return st.speech_polarity(toks, lex).withColumn("polarity", F.round("polarity", R))


@query("polarity_trend", _sql(*_SENT_CTES, body=f"""
SELECT standard_party, year, round(polarity, {R}) AS polarity FROM strend"""))
def q_polarity_trend(spark, sf):
    toks, lex = _sent_tokens(spark, sf)
    return st.polarity_trend(st.speech_polarity(toks, lex)).withColumn("polarity", F.round("polarity", R))


@query("polarity_pivot", _sql(*_SENT_CTES, body=f"""
SELECT y.year, p.standard_party, round(t.polarity, {R}) AS polarity
FROM (SELECT DISTINCT year FROM strend) y CROSS JOIN (SELECT DISTINCT standard_party FROM strend) p
LEFT JOIN strend t ON t.year = y.year AND t.standard_party = p.standard_party"""))
def q_polarity_pivot(spark, sf):
    toks, lex = _sent_tokens(spark, sf)
    trend = stored(st.polarity_trend(st.speech_polarity(toks, lex)), "trend")
    parties = [r[0] for r in trend.select("standard_party").distinct().orderBy("standard_party").collect()]
    piv = st.polarity_pivot(trend, parties)
    long = piv.unpivot("year", parties, "standard_party", "polarity")
    return long.withColumn("polarity", F.round("polarity", R))


def _polar_sql(sign: str) -> str:
    cond = "l.polarity > 0" if sign == "positive" else "l.polarity < 0"
    return f"""
SELECT party, word, frequency, polarity, CAST(rank AS INTEGER) AS rank FROM (
  SELECT party, word, frequency, polarity,
         row_number() OVER (PARTITION BY party ORDER BY frequency DESC, word ASC) AS rank
  FROM (SELECT t.standard_party AS party, t.term AS word, count(*) AS frequency, '{sign}' AS polarity
        FROM stoks t JOIN lexicon l ON l.stem = t.term
        WHERE {cond} AND t.term NOT IN ({fx.sql_stopwords()}) GROUP BY ALL))
WHERE rank <= 10"""


@query("top_positive_words", _sql(*_SENT_CTES, body=_polar_sql("positive")))
def q_top_positive_words(spark, sf):
    toks, lex = _sent_tokens(spark, sf)
    return st.top_polar_words(toks, lex, fx.FIX_STOPWORDS).filter(F.col("polarity") == "positive")


@query("top_negative_words", _sql(*_SENT_CTES, body=_polar_sql("negative")))
def q_top_negative_words(spark, sf):
    toks, lex = _sent_tokens(spark, sf)
    return st.top_polar_words(toks, lex, fx.FIX_STOPWORDS).filter(F.col("polarity") == "negative")
