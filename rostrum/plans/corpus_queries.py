"""Registered queries: scans (A1-A4), scalars (B1-B10), consolidation (D1),
party distribution (D20)."""

from __future__ import annotations

from pyspark.sql import functions as F

from rostrum.functions import text as tx
from rostrum.operators import corpus as co
from rostrum.operators import keywords as kw
from rostrum.plans import corpora
from rostrum.plans import sql_parts as sp
from rostrum.plans.registry import query
from rostrum.sources import fixtures as fx
from rostrum.sources import io

M = fx.sql_merged()


def _sql(*ctes: str, body: str) -> str:
    return sp.with_(*ctes) + body


def _m(spark, sf):
    return fx.merged_speeches(spark, sf)


@query("scan_speeches", _sql(M, body="SELECT id, sitting_date, political_party, merged_speech FROM merged"))
def q_scan_speeches(spark, sf):
    return co.scan_speeches(_m(spark, sf))


@query("scan_by_date", _sql(M, body="""
SELECT id, sitting_date, merged_speech, row_number() OVER (ORDER BY sitting_date NULLS FIRST, id) AS pos FROM merged"""))
def q_scan_by_date(spark, sf):
    return co.scan_by_date(_m(spark, sf))


@query("count_speeches", _sql(M, body="SELECT count(*) AS n FROM merged"))
def q_count_speeches(spark, sf):
    return co.count_rows(_m(spark, sf))


@query("fetch_by_ids", _sql(M, body="""
SELECT id, member_name, sitting_date, political_party, roles, merged_speech FROM merged
WHERE id IN (SELECT doc_id FROM labels)"""))
def q_fetch_by_ids(spark, sf):
    ids = fx.table(spark, sf, "labels").select(F.col("doc_id").alias("id"))
    return co.fetch_by_ids(_m(spark, sf), ids).select(
        "id", "member_name", "sitting_date", "political_party", "roles", "merged_speech")


@query("drop_null_text", _sql(M, fx.SQL_SENTIMENT_SPEECHES, body="""
SELECT id, merged_speech FROM sent WHERE merged_speech IS NOT NULL"""))
def q_drop_null_text(spark, sf):
    return co.drop_null_text(fx.sentiment_speeches(spark, sf)).select("id", "merged_speech")


@query("null_text_to_empty", _sql(M, fx.SQL_SENTIMENT_SPEECHES, body="""
SELECT id, coalesce(merged_speech, '') AS merged_speech FROM sent"""))
def q_null_text_to_empty(spark, sf):
    return co.null_text_to_empty(fx.sentiment_speeches(spark, sf)).select("id", "merged_speech")


@query("sitting_year", _sql(M, body="SELECT id, CAST(year(sitting_date) AS INTEGER) AS sitting_year FROM merged"))
def q_sitting_year(spark, sf):
    return _m(spark, sf).select("id", tx.sitting_year("sitting_date").alias("sitting_year"))


@query("lenient_year", _sql(M, fx.SQL_SENTIMENT_SPEECHES, body="""
SELECT id, CAST(year(TRY_CAST(sitting_date AS TIMESTAMP)) AS INTEGER) AS year FROM sent
WHERE TRY_CAST(sitting_date AS TIMESTAMP) IS NOT NULL"""))
def q_lenient_year(spark, sf):
    y = fx.sentiment_speeches(spark, sf).select("id", tx.lenient_year("sitting_date").alias("year"))
    return y.filter(F.col("year").isNotNull())


@query("excerpt", _sql(M, body=f"""
SELECT id, CASE WHEN length(merged_speech) <= 20 THEN merged_speech
  ELSE regexp_replace(substring(merged_speech, 1, 20), '{tx.STRIP_PATTERN}', '', 'g') || '...' END AS excerpt
FROM merged"""))
def q_excerpt(spark, sf):
    return _m(spark, sf).select("id", tx.excerpt("merged_speech", 20).alias("excerpt"))


@query("report_prefix", _sql(M, body="SELECT id, substring(merged_speech, 1, 200) || '...' AS prefix FROM merged"))
def q_report_prefix(spark, sf):
    return _m(spark, sf).select("id", tx.report_prefix("merged_speech", 200).alias("prefix"))


# Fixture-scaled piece sizes (the reference uses 2,000,000 / 4,000,000 chars);
# every text is processed whole.
PIECE, THRESHOLD = 2000, 4000


@query("split_long_text", _sql(M, body=f"""
SELECT id, CAST(i AS INTEGER) AS piece_no,
       CASE WHEN length(merged_speech) > {THRESHOLD} THEN substring(merged_speech, i * {PIECE} + 1, {PIECE})
            ELSE merged_speech END AS piece
FROM merged, LATERAL (SELECT unnest(CASE WHEN length(merged_speech) > {THRESHOLD}
     THEN range(0, CAST((length(merged_speech) - 1) // {PIECE} AS BIGINT) + 1) ELSE [0] END) AS i)
WHERE merged_speech IS NOT NULL"""))
def q_split_long_text(spark, sf):
    d = co.drop_null_text(_m(spark, sf))
    return d.select("id", F.posexplode(tx.text_pieces("merged_speech", PIECE, THRESHOLD)).alias("piece_no", "piece"))


# Piece sizes of members' texts at the fixtures' scale.
MEMBER_PIECE, MEMBER_THRESHOLD = 20_000, 40_000


@query("member_texts", _sql(M, body=f"""
SELECT member, CAST(i AS INTEGER) AS piece_no,
       CASE WHEN length(text) > {MEMBER_THRESHOLD} THEN substring(text, i * {MEMBER_PIECE} + 1, {MEMBER_PIECE}) ELSE text END AS text
FROM (SELECT member_name AS member, string_agg(merged_speech, ' ' ORDER BY sitting_date, id) AS text
      FROM merged WHERE merged_speech IS NOT NULL AND member_name IS NOT NULL GROUP BY member_name) m,
     LATERAL (SELECT unnest(CASE WHEN length(text) > {MEMBER_THRESHOLD}
       THEN range(0, CAST((length(text) - 1) // {MEMBER_PIECE} AS BIGINT) + 1) ELSE [0] END) AS i)"""))
def q_member_texts(spark, sf):
    """All speeches of a member as one text, in pieces."""
    return co.member_documents(_m(spark, sf), piece=MEMBER_PIECE, threshold=MEMBER_THRESHOLD)


@query("merge_speeches", _sql(fx.SQL_RAW_SPEECHES, body="""
SELECT min(id) AS id, member_name, parliamentary_period, parliamentary_session, parliamentary_sitting,
       sitting_date, political_party, count(*) AS n_turns, string_agg(speech, ' ' ORDER BY id) AS merged_speech
FROM raw GROUP BY member_name, parliamentary_period, parliamentary_session, parliamentary_sitting, sitting_date,
  political_party"""))
def q_merge_speeches(spark, sf):
    return co.merge_speeches(fx.raw_speeches(spark, sf))


_STD = f"""std AS (
  SELECT s.*, coalesce(p.canonical, 'Other') AS standard_party
  FROM sent s LEFT JOIN partymap p ON p.raw = lower(s.political_party))"""


def _std(spark, sf):
    return co.standardize_party(fx.sentiment_speeches(spark, sf), fx.FIX_PARTY_MAP)


@query("standardize_party", _sql(M, fx.SQL_SENTIMENT_SPEECHES, fx.sql_party_map(), _STD,
                                 body="SELECT id, political_party, standard_party FROM std"))
def q_standardize_party(spark, sf):
    return _std(spark, sf).select("id", "political_party", "standard_party")


@query("selected_parties", _sql(M, fx.SQL_SENTIMENT_SPEECHES, fx.sql_party_map(), _STD, body=f"""
SELECT id, standard_party FROM std WHERE standard_party IN ({", ".join(repr(p) for p in fx.FIX_SELECTED_PARTIES)})"""))
def q_selected_parties(spark, sf):
    return co.selected_parties(_std(spark, sf), fx.FIX_SELECTED_PARTIES).select("id", "standard_party")


@query("party_distribution", _sql(M, fx.SQL_SENTIMENT_SPEECHES, fx.sql_party_map(), _STD, body="""
SELECT standard_party, count(*) AS n FROM std GROUP BY standard_party"""))
def q_party_distribution(spark, sf):
    return co.party_distribution(_std(spark, sf))


@query("distinct_parties", _sql(M, fx.SQL_SENTIMENT_SPEECHES, fx.sql_party_map(), _STD, body="""
SELECT DISTINCT standard_party FROM std WHERE standard_party IS NOT NULL"""))
def q_distinct_parties(spark, sf):
    return co.distinct_parties(_std(spark, sf))


@query("union_chunks", _sql(M, fx.SQL_RAW_SPEECHES, body="""
SELECT id, sitting_date, political_party, merged_speech FROM merged
UNION ALL
SELECT min(id), sitting_date, political_party, string_agg(speech, ' ' ORDER BY id) FROM raw
GROUP BY member_name, parliamentary_period, parliamentary_session, parliamentary_sitting, sitting_date,
  political_party"""))
def q_union_chunks(spark, sf):
    """Two producers' speech tables, written as chunk files and read
    as one table by column name."""
    a = co.scan_speeches(_m(spark, sf))
    b = co.merge_speeches(fx.raw_speeches(spark, sf)).select("id", "sitting_date", "political_party", "merged_speech")
    base = corpora.scratch(spark, "chunks")
    io.save(a, f"{base}/a")
    io.save(b.select(*reversed(b.columns)), f"{base}/b")
    return io.union_chunks(spark, [f"{base}/a", f"{base}/b"])


@query("restore_order", _sql(M, body="""
SELECT 1000000007 - l.doc_id AS pos, l.doc_id AS id, m.member_name, m.political_party, m.sitting_date
FROM labels l JOIN merged m ON m.id = l.doc_id"""))
def q_restore_order(spark, sf):
    ids = fx.table(spark, sf, "labels").select(F.col("doc_id").alias("id"), (F.lit(1000000007) - F.col("doc_id")).alias("pos"))
    return kw.in_position_order(ids, _m(spark, sf).select("id", "member_name", "political_party", "sitting_date"))
