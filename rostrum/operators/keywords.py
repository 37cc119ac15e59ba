"""Keywords per document, member, party and year, and their trends
(inventory D9-D19, E1-E5).

All rankings are ``row_number`` windows ordered by the score rounded to nine
places (so values equal up to summation order tie), then by keyword — the
reference's unstable sorts made tie order arbitrary (decision Q5).  Scores
are reported rounded to six places.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rostrum.functions import text as tx

# The reference's keyword blocklist of frequent Greek stems
# (13 distinct; the list as written repeats two of them).
GREEK_COMMON_KEYWORDS = ["αυτ", "εινα", "της", "αυτ", "απο", "εν", "τους", "κυρι", "οτ", "δε", "απο", "αλλ", "εχ", "λογ", "μι"]

RANK_DIGITS = 9
OUT_DIGITS = 6


def _ranked(df: DataFrame, part: list[str], score: str, key: str, n: int | None) -> DataFrame:
    w = Window.partitionBy(*part).orderBy(F.desc(F.round(score, RANK_DIGITS)), F.asc(key))
    out = df.withColumn("rank", F.row_number().over(w))
    return out.filter(F.col("rank") <= n) if n is not None else out


def keywords_per_doc(weights: DataFrame, blocklist: Iterable[str] = GREEK_COMMON_KEYWORDS, top_n: int = 10,
                     key: str = "id") -> DataFrame:
    """D9 (+C8): the ``top_n`` terms of highest weight of every document, after
    the blocklist; only terms present in the document (weight > 0).  The
    window re-uses the ``id`` partitioning of the weight normalisation."""
    block = sorted(set(blocklist))
    kw = weights.filter(F.col("weight") > 0)
    if block:
        kw = kw.filter(~F.col("term").isin(block))
    kw = kw.select(key, F.col("term").alias("keyword"), F.col("weight").alias("score"))
    return _ranked(kw, [key], "score", "keyword", top_n)


def attach_metadata(keywords: DataFrame, details: DataFrame, key: str = "id",
                    cols: Iterable[str] = ("member_name", "political_party", "sitting_date")) -> DataFrame:
    """E1 + E2 + E4: left join of the keyword rows with speech details; rows
    whose details are missing (member_name null) are dropped.  The keyword
    side is already hash-partitioned by id, so only the details shuffle."""
    d = details.select(key, *cols)
    out = keywords.join(d, key, "left")
    return out.dropna(subset=["member_name"]) if "member_name" in cols else out


def in_position_order(ids: DataFrame, details: DataFrame, key: str = "id") -> DataFrame:
    """The details of a list of ids (id, pos) in the list's order, with
    ``pos`` kept; ids without details are left out, repeated ids repeat.  The
    order is a range-partitioned sort."""
    out = ids.select("pos", key).join(details, key).orderBy("pos", key)
    return out.select("pos", key, *[c for c in details.columns if c != key])


def missing_ids(ids: DataFrame, details: DataFrame, key: str = "id") -> DataFrame:
    """Ids that have no details row (the reference's warning list)."""
    return ids.select(key).join(details.select(key), key, "left_anti")


def with_year(df: DataFrame, date_col: str = "sitting_date") -> DataFrame:
    return df.withColumn("sitting_year", tx.sitting_year(date_col))


def top_keywords_by_group(kw_meta: DataFrame, group_col: str, top_n: int = 10) -> DataFrame:
    """Per group the ``top_n`` keywords by the sum of their
    per-document top-k scores.  Null groups are dropped (Q7).  Partial
    aggregation before the shuffle keeps a hot group cheap."""
    g = kw_meta.dropna(subset=[group_col]).groupBy(group_col, "keyword").agg(F.sum("score").alias("score"))
    return _ranked(g, [group_col], "score", "keyword", top_n)


def keyword_counts(top_by_group: DataFrame, group_col: str) -> DataFrame:
    """Number of keywords each group ended up with."""
    return top_by_group.groupBy(group_col).agg(F.count("*").alias("n_keywords"))


def group_keyword_trends(kw_meta: DataFrame, top_by_group: DataFrame, group_col: str) -> DataFrame:
    """D13 / D14 (+E5): yearly summed score of each group's own top keywords."""
    y = with_year(kw_meta.dropna(subset=[group_col]))
    own = top_by_group.select(group_col, "keyword")
    kept = y.join(own, [group_col, "keyword"], "left_semi")
    return kept.groupBy(group_col, "sitting_year", "keyword").agg(F.sum("score").alias("score"))


def top_keywords_per_year(kw_meta: DataFrame, top_n: int = 10) -> DataFrame:
    """The ``top_n`` keywords of every year by summed score."""
    y = with_year(kw_meta).groupBy("sitting_year", "keyword").agg(F.sum("score").alias("score"))
    return _ranked(y, ["sitting_year"], "score", "keyword", top_n)


def top_keywords_overall(kw_meta: DataFrame, top_n: int = 10) -> DataFrame:
    """The ``top_n`` keywords of the whole corpus with their rank.  The
    global top-k is a ``TakeOrderedAndProject`` (each task keeps k rows)."""
    g = kw_meta.groupBy("keyword").agg(F.sum("score").alias("score"))
    top = g.orderBy(F.desc(F.round("score", RANK_DIGITS)), F.asc("keyword")).limit(top_n)
    w = Window.orderBy(F.desc(F.round("score", RANK_DIGITS)), F.asc("keyword"))  # over top_n rows only
    return top.withColumn("rank", F.row_number().over(w))


def overall_keyword_trend(kw_meta: DataFrame, top_overall: DataFrame) -> DataFrame:
    """Yearly summed score of the overall top keywords."""
    y = with_year(kw_meta).join(F.broadcast(top_overall.select("keyword")), "keyword", "left_semi")
    return y.groupBy("sitting_year", "keyword").agg(F.sum("score").alias("score"))


def top_of_trends(trends: DataFrame, top_n: int = 10) -> DataFrame:
    """(rank, keyword) of the keywords of highest total over all groups and years."""
    tot = trends.groupBy("keyword").agg(F.sum("score").alias("t"))
    order = [F.desc(F.round("t", RANK_DIGITS)), F.asc("keyword")]
    w = Window.orderBy(*order)  # over top_n rows only
    return tot.orderBy(*order).limit(top_n).select(F.row_number().over(w).alias("rank"), "keyword")


def trend_matrix(trends: DataFrame, ranked: DataFrame) -> DataFrame:
    """(sitting_year, keyword, rank, score) for every year that has
    any of the ranked keywords and each of them, 0 where missing; ``ranked`` is
    a bounded (rank, keyword) table.  The ranking is a scalar subquery of the
    same plan, so nothing runs before the result does; a year's scores are one
    map of at most as many entries as there are ranked keywords."""
    top = F.sort_array(F.collect_list(F.struct("rank", "keyword")))
    ranks = ranked.agg(top.alias("top")).scalar()
    sums = trends.join(ranked.select("keyword"), "keyword", "left_semi").groupBy("sitting_year", "keyword").agg(F.sum("score").alias("score"))
    years = sums.groupBy("sitting_year").agg(F.map_from_entries(F.collect_list(F.struct("keyword", "score"))).alias("scores"))
    cells = years.select("sitting_year", "scores", F.explode(ranks).alias("k"))
    return cells.select("sitting_year", F.col("k.keyword").alias("keyword"), F.col("k.rank").alias("rank"),
                        F.coalesce(F.try_element_at("scores", F.col("k.keyword")), F.lit(0.0)).alias("score"))


def trend_pivot(trends: DataFrame, ranked_keywords: list[str]) -> DataFrame:
    """The matrix with a column for each of the named keywords."""
    sub = trends.filter(F.col("keyword").isin(ranked_keywords))
    return sub.groupBy("sitting_year").pivot("keyword", ranked_keywords).agg(F.sum("score")).na.fill(0.0)
