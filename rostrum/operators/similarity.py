"""Most similar member pairs (inventory E9-E14).

Cosine similarity of L2-normalised member vectors is a Gram matrix
``M Mᵀ``.  A self-join on term would emit every pair of members sharing a
term (quadratic per frequent term), so products are computed blockwise:
members are hashed into blocks of about ``members_per_block``, and one task per block
pair multiplies two dense blocks with numpy.

All pairs (``member_pairs``) need every block pair of whole vectors.  The best k
(``top_pairs``) do not:

* a member's *sketch* is its weights of the ``leading`` terms that carry most of
  all vectors' squared weight, and the length of the rest of its vector (its suffix norm);
* as weights are not negative, a pair's similarity is at least the product of
  the leading weights and at most that plus the product of the suffix norms;
* block pairs of sketches give these bounds; inside a block pair the k-th
  largest lower bound so far drops pairs whose upper bound is below it, and the
  k-th largest of all drops them once more;
* whole vectors go only to the block pairs in which their member is still part
  of a pair, where the exact similarities are computed.

The number of blocks is a scalar subquery of the same plan.  Task memory is bounded by
``2 * members_per_block * max_features`` doubles and one block pair's products, whatever the corpus size.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rostrum.session import stored

RANK_DIGITS = 9
#: Leading terms of a sketch: 8 bytes each and member.
LEADING = 1024
#: Bounds give way by this much: similarities are compared after rounding to nine places.
SLACK = 2e-9
PAIR_SCHEMA = "member1 string, member2 string, similarity double"


def _pairs_kernel(top_k: int | None, include_zero: bool):
    def kernel(key, pdf):
        lo, hi = int(key[0]), int(key[1])
        terms, tcode = np.unique(pdf["term"].to_numpy(), return_inverse=True)
        names = pdf["member_name"].to_numpy(dtype=object)
        blk = pdf["blk"].to_numpy()
        out = []
        sides = {}
        for b in {lo, hi}:
            sel = blk == b
            mem, mcode = np.unique(names[sel], return_inverse=True)
            mat = np.zeros((len(mem), len(terms)))
            np.add.at(mat, (mcode, tcode[sel]), pdf["weight"].to_numpy()[sel])
            sides[b] = (mem, mat)
        a_names, a = sides[lo]
        b_names, b = sides[hi]
        sim = a @ b.T
        ia, ib = np.nonzero(np.ones_like(sim, dtype=bool)) if include_zero else np.nonzero(sim > 0)
        if lo == hi:
            keep = a_names[ia] < b_names[ib]
            ia, ib = ia[keep], ib[keep]
        s = sim[ia, ib]
        n1, n2 = a_names[ia], b_names[ib]
        swap = n1 > n2
        m1 = np.where(swap, n2, n1)
        m2 = np.where(swap, n1, n2)
        if top_k is not None and len(s) > top_k:
            r = np.round(s, RANK_DIGITS)
            kth = np.partition(r, len(r) - top_k)[len(r) - top_k]
            sel = r >= kth
            m1, m2, s, r = m1[sel], m2[sel], s[sel], r[sel]
            order = np.lexsort((m2.astype(str), m1.astype(str), -r))[:top_k]
            m1, m2, s = m1[order], m2[order], s[order]
        out = pd.DataFrame({"member1": m1.astype(str), "member2": m2.astype(str), "similarity": s})
        return out

    return kernel


def member_vectors(weights: DataFrame, member_col: str = "member_name") -> DataFrame:
    """(member_name, term, weight) of the members with a name; terms as 64-bit hashes."""
    vec = weights.select(F.col(member_col).alias("member_name"), F.xxhash64("term").alias("term"), "weight")
    return vec.dropna(subset=["member_name"])


def _blocks(vec: DataFrame, members_per_block: int) -> Column:
    n = vec.select(F.count_distinct("member_name")).scalar()
    return F.greatest(F.ceil(n / F.lit(members_per_block)), F.lit(1)).cast("int")


def _block_of(blocks: Column) -> Column:
    return F.pmod(F.xxhash64("member_name"), blocks).cast("int")


def _to_block_pairs(rows: DataFrame, blocks: Column) -> DataFrame:
    """Every row once for each block pair that its member's block is part of."""
    rep = rows.withColumn("blk", _block_of(blocks)).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    return rep.withColumn("lo", F.least("blk", "other")).withColumn("hi", F.greatest("blk", "other")).drop("other")


def member_pairs(weights: DataFrame, member_col: str = "member_name", top_k: int | None = None,
                 include_zero: bool = False, members_per_block: int = 1000) -> DataFrame:
    """E9 + E10: (member1 < member2, similarity) for every unordered pair of
    distinct members (pairs with similarity 0 only with ``include_zero``), or
    only each block pair's local top ``top_k``."""
    vec = member_vectors(weights, member_col)
    rep = _to_block_pairs(vec, _blocks(vec, members_per_block))
    return rep.groupBy("lo", "hi").applyInPandas(_pairs_kernel(top_k, include_zero), PAIR_SCHEMA)


def sketches(vec: DataFrame, leading: int = LEADING) -> DataFrame:
    """(member_name, lead array<double>, suffix): the weights of the leading
    terms, in one order for all members, and the length of what is left."""
    energy = vec.groupBy("term").agg(F.sum(F.col("weight") * F.col("weight")).alias("energy"))
    order = Window.orderBy(F.desc("energy"), "term")  # over at most ``leading`` rows
    top = energy.orderBy(F.desc("energy"), "term").limit(leading).select("term", (F.row_number().over(order) - 1).alias("at"))
    rows = vec.join(F.broadcast(top), "term", "left")
    pairs = F.collect_list(F.when(F.col("at").isNotNull(), F.struct("at", "weight")))
    rest = F.sum(F.when(F.col("at").isNull(), F.col("weight") * F.col("weight")).otherwise(0.0))
    return rows.groupBy("member_name").agg(pairs.alias("lead"), F.sqrt(rest).alias("suffix"))


_BOUNDS = "member1 string, member2 string, lo int, hi int, low double, high double"


def _bounds_kernel(k: int, leading: int):
    def kernel(key, pdf):
        lo, hi = int(key[0]), int(key[1])
        blk, names = pdf["blk"].to_numpy(), pdf["member_name"].to_numpy(dtype=object)
        lead = np.zeros((len(pdf), leading))
        for row, entries in zip(lead, pdf["lead"]):
            for e in entries:
                row[e["at"]] = e["weight"]
        suffix = pdf["suffix"].to_numpy()
        a, b = np.flatnonzero(blk == lo), np.flatnonzero(blk == hi)
        low = lead[a] @ lead[b].T
        high = low + np.outer(suffix[a], suffix[b])
        pair = names[a][:, None] < names[b][None, :] if lo == hi else np.ones(low.shape, bool)
        least = -1.0
        if pair.sum() > k:
            least = np.partition(low[pair], -k)[-k]
        i, j = np.nonzero(pair & (high >= least - SLACK))
        n1, n2 = names[a][i], names[b][j]
        swap = n1 > n2
        return pd.DataFrame({"member1": np.where(swap, n2, n1).astype(str), "member2": np.where(swap, n1, n2).astype(str),
                             "lo": np.int32(lo), "hi": np.int32(hi), "low": low[i, j], "high": high[i, j]})

    return kernel


def pair_bounds(vec: DataFrame, k: int, blocks: Column, leading: int = LEADING) -> DataFrame:
    """Pairs that may be among the best ``k``: bounds of their similarity and
    the block pair (lo, hi) that they lie in."""
    rep = _to_block_pairs(sketches(vec, leading), blocks)
    found = stored(rep.groupBy("lo", "hi").applyInPandas(_bounds_kernel(k, leading), _BOUNDS), "pair-bounds")
    best = found.orderBy(F.desc("low")).limit(k)
    least = best.select(F.when(F.count("*") == k, F.min("low")).otherwise(F.lit(-1.0))).scalar()
    return found.where(F.col("high") >= least - F.lit(SLACK))


def top_pairs(weights: DataFrame, k: int = 10, member_col: str = "member_name",
              members_per_block: int = 1000, leading: int = LEADING) -> DataFrame:
    """The k most similar pairs, ranked from 1 (ties by names)."""
    vec = member_vectors(weights, member_col)
    blocks = _blocks(vec, members_per_block)
    alive = pair_bounds(vec, k, blocks, leading)
    sent = alive.select("lo", "hi", F.explode(F.array("member1", "member2")).alias("member_name")).distinct()
    rep = vec.join(sent, "member_name").withColumn("blk", _block_of(blocks))
    cand = rep.groupBy("lo", "hi").applyInPandas(_pairs_kernel(k, True), PAIR_SCHEMA)
    order = [F.desc(F.round("similarity", RANK_DIGITS)), F.asc("member1"), F.asc("member2")]
    top = cand.orderBy(*order).limit(k)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*order)))  # over k rows


def member_parties(speeches: DataFrame, member_col: str = "member_name", party_col: str = "political_party") -> DataFrame:
    """Each member's distinct parties, sorted and comma-joined; 'Unknown'
    when there is none.  The set per member is bounded by the number of
    parties and is built by partial aggregation."""
    s = speeches.select(F.col(member_col).alias("member"), F.col(party_col).alias("party")).dropna(subset=["member"])
    g = s.groupBy("member").agg(F.sort_array(F.collect_set("party")).alias("ps"))
    return g.select("member", F.when(F.size("ps") > 0, F.array_join("ps", ", ")).otherwise(F.lit("Unknown")).alias("parties"))


def top_member_pairs(weights: DataFrame, speeches: DataFrame, k: int = 10, member_col: str = "member_name",
                     members_per_block: int = 1000) -> DataFrame:
    """E14 (+B12): rank, both members with their parties, similarity rounded
    to four places."""
    top = top_pairs(weights, k, member_col, members_per_block)
    parties = member_parties(speeches, member_col)
    p1 = parties.select(F.col("member").alias("member1"), F.col("parties").alias("member1_parties"))
    p2 = parties.select(F.col("member").alias("member2"), F.col("parties").alias("member2_parties"))
    j = top.join(p1, "member1", "left").join(p2, "member2", "left")
    unknown = F.lit("Unknown")
    return j.select(
        F.col("rank").cast("int").alias("rank"),
        "member1",
        F.coalesce("member1_parties", unknown).alias("member1_parties"),
        "member2",
        F.coalesce("member2_parties", unknown).alias("member2_parties"),
        F.round("similarity", 4).alias("similarity"),
    )
