"""Ranked cosine search over TF-IDF postings (inventory G1-G7, B11).

Document rows are unit length, so cosine similarity is a dot product: the
query's weights are joined with the document postings on term and summed per
document.  Joins carry no hint.

Searches read a fitted model or an index stored with ``sources.io.save_index``,
whose postings are sorted by (term, id): one query's terms and one page's ids
are literals (``IN``) that reach the Parquet scan, so a search reads the row
groups of its terms and the rows of its page.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rostrum.functions import text as tx
from rostrum.operators import impact, tfidf

RANK_DIGITS = 9
RESULT_SCHEMA = (
    "rank int, id long, merged_speech string, member_name string, political_party string, score double, "
    "parliamentary_period string, parliamentary_session string, parliamentary_sitting string, sitting_date date"
)


def query_weights(spark: SparkSession, query: str, vocab: DataFrame, stopwords: Iterable[str] = (),
                  stems: tfidf.Stems = None, max_features: int | None = 10_000) -> DataFrame:
    """C7 + D8: the normalised query as (term, qweight) over the vocabulary."""
    q = spark.createDataFrame([(0, query)], "id long, text string")
    tok = tfidf.tokenize(q, "id", "text", stopwords, stems)
    return tfidf.transform(tok, vocab, "id", max_features).select("term", F.col("weight").alias("qweight"))


def query_scores(spark: SparkSession, query: str, index, stopwords: Iterable[str] = (),
                 stems: tfidf.Stems = None) -> DataFrame:
    """G1 for one query text.  Its distinct vocabulary terms (no more than the
    text has words) come to the driver first, so that the postings are read
    with ``term IN (...)``; a query without such a term matches nothing."""
    found = query_weights(spark, query, index.vocab, stopwords, stems, index.max_features).collect()
    qw = spark.createDataFrame(found, "term string, qweight double")
    return scores(index.weights.filter(F.col("term").isin([r["term"] for r in found])), qw)


def page_scores(spark: SparkSession, query: str, index, threshold: float, top_k: int, stopwords: Iterable[str] = (),
                stems: tfidf.Stems = None) -> DataFrame:
    """G1 + G2 for the pages up to ``top_k`` matches: (id, score) of at least
    these, from the impact blocks that can reach them."""
    found = query_weights(spark, query, index.vocab, stopwords, stems, index.max_features).collect()
    qw = spark.createDataFrame([(0, *r) for r in found], "query_id int, term string, qweight double")
    terms = F.col("term").isin([r["term"] for r in found])
    return impact.matches(qw, index.blocks.filter(terms), index.weights.filter(terms), threshold, top_k).select("id", "score")


def scores(doc_weights: DataFrame, qweights: DataFrame) -> DataFrame:
    """G1: (id, score) for every document sharing a term with the query.
    Partial aggregation per task precedes the shuffle on id."""
    j = doc_weights.join(qweights, "term")
    return j.groupBy("id").agg(F.sum(F.col("weight") * F.col("qweight")).alias("score"))


def ranked(sc: DataFrame, threshold: float = 0.1) -> DataFrame:
    """Matches with score >= threshold (compared after rounding to nine
    places, so engines agree on ties)."""
    return sc.filter(F.round("score", RANK_DIGITS) >= threshold)


def _order():
    return [F.desc(F.round("score", RANK_DIGITS)), F.asc("id")]


def page(matches: DataFrame, page_no: int = 1, per_page: int = 10) -> DataFrame:
    """One page, ranked from 1 over the whole result.  ``offset`` +
    ``limit`` after a sort plan as a bounded global top-k."""
    start = max(page_no - 1, 0) * per_page
    top = matches.orderBy(*_order()).offset(start).limit(per_page)
    w = Window.orderBy(*_order())  # over at most per_page rows
    return top.withColumn("rank", (F.row_number().over(w) + start).cast("int"))


def page_info(matches: DataFrame, page_no: int = 1, per_page: int = 10) -> DataFrame:
    """total_results, total_pages (ceil), has_next, has_prev."""
    total = F.count("*")
    pages = F.ceil(total / F.lit(per_page)).cast("long")
    return matches.agg(
        total.alias("total_results"),
        pages.alias("total_pages"),
        (F.lit(page_no) < pages).alias("has_next"),
        F.lit(page_no > 1).alias("has_prev"),
    )


def with_details(pg: DataFrame, details: DataFrame, excerpt_len: int = 20) -> DataFrame:
    """G5 (+E7, B5, B7): page rows joined with their speech details; ids the
    details table lacks are dropped."""
    d = details.select(
        "id",
        tx.excerpt("merged_speech", excerpt_len).alias("merged_speech"),
        tx.or_unknown("member_name").alias("member_name"),
        "political_party",
        "parliamentary_period",
        "parliamentary_session",
        "parliamentary_sitting",
        tx.empty_to_null("sitting_date").alias("sitting_date"),
    )
    return pg.join(d, "id").select(
        "rank", "id", "merged_speech", "member_name", "political_party", "score",
        "parliamentary_period", "parliamentary_session", "parliamentary_sitting", "sitting_date",
    ).orderBy("rank")  # a page: at most per_page rows


def search(spark: SparkSession, query: str, model: tfidf.TfidfModel, details: DataFrame, page_no: int = 1,
           per_page: int = 10, threshold: float = 0.1, stopwords: Iterable[str] = (),
           stems: tfidf.Stems = None) -> DataFrame:
    """G5 + G6: the full search endpoint over a fitted model or a stored index.
    An empty query returns no rows; a query with no vocabulary term matches
    nothing.  The page (at most ``per_page`` rows) is fetched first, so that
    the speeches are read with ``id IN (...)``."""
    if not query:
        return spark.createDataFrame([], RESULT_SCHEMA)
    if getattr(model, "blocks", None) is None or threshold <= 0:
        m = ranked(query_scores(spark, query, model, stopwords, stems), threshold)
    else:
        m = ranked(page_scores(spark, query, model, threshold, max(page_no, 1) * per_page, stopwords, stems), threshold)
    rows = page(m, page_no, per_page).select("id", "score", "rank").collect()
    pg = spark.createDataFrame(rows, "id long, score double, rank int")
    return with_details(pg, details.filter(F.col("id").isin([r["id"] for r in rows])))


def batch_weights(queries: DataFrame, vocab: DataFrame, stopwords: Iterable[str] = (), stems: tfidf.Stems = None,
                  max_features: int | None = 10_000) -> DataFrame:
    """C7 + D8 for many queries: (query_id, term, qweight)."""
    q = queries.select(F.col("query_id").alias("id"), F.col("query").alias("text"))
    qtok = tfidf.tokenize(q, "id", "text", stopwords, stems)
    return tfidf.transform(qtok, vocab, "id", max_features).select(
        F.col("id").alias("query_id"), "term", F.col("weight").alias("qweight")
    )


def batch_scores(doc_weights: DataFrame, queries: DataFrame, vocab: DataFrame, stopwords: Iterable[str] = (),
                 stems: tfidf.Stems = None, max_features: int | None = 10_000,
                 threshold: float = 0.1, top_k: int | None = None, blocks: DataFrame | None = None,
                 documents: DataFrame | None = None) -> DataFrame:
    """Many queries at once — (query_id, id, score) for every match
    >= threshold; with ``top_k`` the best of each query with their rank (the
    planner keeps ``top_k`` rows per query in each task before the shuffle).
    Each query is reduced to its vocabulary
    terms; the join on term carries no hint: the planner broadcasts a small
    query side by its real bytes, else both sides shuffle on term (AQE splits
    skewed terms).  With the ``blocks`` of a stored index only blocks that can
    reach the threshold, or the ``top_k``-th score, are read (``impact``); with its
    ``documents`` as well, queries are scored inside the documents' rows."""
    qw = batch_weights(queries, vocab, stopwords, stems, max_features)
    if blocks is not None and threshold > 0:
        sc = impact.matches(qw, blocks, doc_weights, threshold, top_k, documents=documents)
    else:
        j = doc_weights.join(qw, "term")
        sc = j.groupBy("query_id", "id").agg(F.sum(F.col("weight") * F.col("qweight")).alias("score"))
    sc = ranked(sc, threshold)
    return sc if top_k is None else batch_top(sc, top_k)


def batch_top(matches: DataFrame, k: int) -> DataFrame:
    """The ``k`` best matches of every query, with their rank."""
    w = Window.partitionBy("query_id").orderBy(*_order())
    return matches.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def batch_page(matches: DataFrame, page_no: int = 1, per_page: int = 10) -> DataFrame:
    """G3 for many queries: the same page of each, ranked over its whole result."""
    page_no = max(page_no, 1)
    return batch_top(matches, page_no * per_page).filter(F.col("rank") > (page_no - 1) * per_page)


def batch_page_info(matches: DataFrame, queries: DataFrame, page_no: int = 1, per_page: int = 10) -> DataFrame:
    """G4 for many queries: one row per query, those without a match included."""
    n = matches.groupBy("query_id").agg(F.count("*").alias("n"))
    out = queries.select("query_id").join(n, "query_id", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    pages = F.ceil(F.col("n") / F.lit(per_page)).cast("long")
    return out.select("query_id", F.col("n").alias("total_results"), pages.alias("total_pages"),
                      (F.lit(page_no) < pages).alias("has_next"), F.lit(page_no > 1).alias("has_prev"))


def lookup_speech(speeches: DataFrame, period: str, session: str, sitting: str, date: str,
                  member_like: str) -> DataFrame:
    """The consolidated speech with the given period, session, sitting
    and date whose member name matches a LIKE pattern; first by id, or none."""
    f = (
        (F.col("parliamentary_period") == period)
        & (F.col("parliamentary_session") == session)
        & (F.col("parliamentary_sitting") == sitting)
        & (F.col("sitting_date") == F.lit(date).cast("date"))
        & F.col("member_name").like(member_like)
    )
    cols = ["member_name", "parliamentary_period", "parliamentary_session", "parliamentary_sitting",
            "sitting_date", "merged_speech"]
    return speeches.filter(f).orderBy("id").limit(1).select("id", *cols)
