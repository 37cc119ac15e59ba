"""Search over postings in impact blocks (inventory G1-G3, G7 at scale).

A block is the postings of one term whose weights lie in the same half octave
(``tier``: 0 holds weights above 0.707, each further tier those down to
another factor 0.707).  The index stores postings sorted by (term, tier, id) and a small
table with the largest weight and the number of postings of every block.

A search that must reach a score ``least`` need not read all blocks of its terms: a
document in none of the blocks read scores at most the sum, over the query's terms, of
query weight times largest skipped weight (``rest``).  Blocks are skipped in the order of postings
saved per score given up, a term's from the lowest, while ``rest`` stays below
``SHARE * least``.  Documents found get partial scores; those that stay below
``least`` even with ``rest`` are dropped, and only the others are completed with
their weights in the skipped blocks, so the result is exact.

For the best k matches ``least`` comes from the data: the k-th largest partial
score over each query's strongest blocks, which its k-th score cannot be below.

An index also holds its documents with their postings in one row.  Where the queries are
few (``ROWS``), ``matches`` scores them inside these rows: the same blocks are skipped and
completed, but no posting moves, and only documents that reach ``least`` leave their task.
All rows are read either way, so blocks are then skipped only when asked for (``gain=0``).

Choosing is window functions over (query, term, tier) rows, which do not grow with
the postings.  Where the queries' blocks hold few postings, or the choice saves less
than half of them (long queries of common words, a low threshold), the further passes
would cost more than they save and all blocks are read in one join; both ways
give the same matches.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rostrum.session import stored

#: Scores are compared after rounding to nine places; bounds give way by as much.
SLACK = 2e-9
#: Part of the score to reach that skipped blocks may hold.
SHARE = 0.5
#: Postings of all queries up to which one join reads them all.
SMALL = 10_000_000
#: The skipping way must read at most one in so many postings.
GAIN = 2
#: The first pass reads about so many postings for each result asked for, and
#: is made where a query has ``HEAD_WORTH`` times as many.
HEAD, HEAD_WORTH = 8, 125
#: (query, term) rows up to which documents are scored in their rows.
ROWS = 2_000_000
#: Scores and products that a task holds at once, about.
CELLS = 1 << 21


def with_tiers(weights: DataFrame) -> DataFrame:
    """Postings (term, id, weight) with their tier."""
    return weights.withColumn("tier", F.floor(-2 * F.log2("weight") + F.lit(1e-12)).cast("int"))


def block_table(postings: DataFrame) -> DataFrame:
    """(term, tier, top, n): largest weight and number of postings of every block."""
    return postings.groupBy("term", "tier").agg(F.max("weight").alias("top"), F.count("*").alias("n"))


def query_blocks(queries: DataFrame, blocks: DataFrame) -> DataFrame:
    """(query_id, term, qweight, tier, top, n): the blocks of every query's terms."""
    return queries.join(blocks, "term").select("query_id", "term", "qweight", "tier", "top", "n")


def partial_scores(postings: DataFrame, chosen: DataFrame) -> DataFrame:
    """(query_id, id, part) over the postings of the chosen (query_id, term, tier, qweight)."""
    j = postings.join(chosen.select("query_id", "term", "tier", "qweight"), ["term", "tier"])
    return j.groupBy("query_id", "id").agg(F.sum(F.col("weight") * F.col("qweight")).alias("part"))


def document_table(weights: DataFrame) -> DataFrame:
    """(id, terms, weights): the postings (id, term, weight) of every document in one row."""
    rows = weights.groupBy("id").agg(F.collect_list(F.struct("term", "weight")).alias("p"))
    return rows.select("id", F.col("p.term").alias("terms"), F.col("p.weight").alias("weights"))


def _row_scores(shared, first: int, last: int, terms, weights, offsets):
    """(document, query, score) arrays of the documents ``first`` to ``last`` of a batch."""
    q = shared.value
    a, z = offsets[first], offsets[last]
    t, w = terms[a:z], weights[a:z]
    d = np.repeat(np.arange(last - first), np.diff(offsets[first : last + 1]))
    known = np.flatnonzero(t >= 0)
    t, w, d = t[known], w[known], d[known]
    n = np.diff(q["starts"])[t]
    at = np.arange(n.sum()) + np.repeat(q["starts"][t] - (np.cumsum(n) - n), n)
    cells, product = np.repeat(d, n) * len(q["least"]) + q["of"][at], np.repeat(w, n) * q["qweight"][at]
    size = (last - first) * len(q["least"])
    tier = np.floor(-2 * np.log2(w) + 1e-12)
    read = np.repeat(tier, n) < q["cut"][at]
    part = np.bincount(cells[read], product[read], size)
    alive = (part > 0) & (part + np.tile(q["rest"], last - first) >= np.tile(q["least"], last - first) - SLACK)
    if q["complete"]:
        late = ~read & alive[cells]
        part += np.bincount(cells[late], product[late], size)
    found = np.flatnonzero(alive)
    return first + found // len(q["least"]), found % len(q["least"]), part[found]


def row_scores(documents: DataFrame, wanted: DataFrame, complete: bool = True) -> DataFrame:
    """(query_id, id, part) over a table of documents with their postings, inside their rows.
    ``wanted`` are (query_id, term, qweight, cut, least, rest) rows, at most ``ROWS``: of a
    term's postings those of tiers below ``cut`` are read; a document is found if they give
    more than nothing and with ``rest`` reach ``least``, and with ``complete`` gets its
    whole score."""
    t = wanted.select("query_id", "term", F.col("qweight").cast("double"), F.col("cut").cast("double"),
                      F.col("least").cast("double"), F.col("rest").cast("double")).toArrow().combine_chunks()
    column = lambda c: t.column(c).to_numpy()
    ids = pa.concat_arrays(t.column("query_id").chunks).dictionary_encode("encode")
    of, (words, code) = ids.indices.to_numpy(zero_copy_only=False), np.unique(t.column("term").to_numpy(zero_copy_only=False).astype(str), return_inverse=True)
    order = np.argsort(code, kind="stable")
    least, rest = np.zeros(len(ids.dictionary)), np.zeros(len(ids.dictionary))
    least[of], rest[of] = column("least"), column("rest")
    kinds = [wanted.schema["query_id"].dataType.simpleString(), documents.schema["id"].dataType.simpleString()]
    shared = documents.sparkSession.sparkContext.broadcast(
        {"words": pa.array(words.tolist(), pa.string()), "starts": np.searchsorted(code[order], np.arange(len(words) + 1)), "of": of[order],
         "qweight": column("qweight")[order], "cut": column("cut")[order], "least": least, "rest": rest, "ids": ids.dictionary, "complete": complete})

    def run(batches):
        for b in batches:
            lists, values, own = b.column(1), b.column(2), b.column(0)
            terms = pc.fill_null(pc.index_in(lists.flatten(), shared.value["words"]), -1).to_numpy(zero_copy_only=False)
            weights = values.flatten().to_numpy(zero_copy_only=False)
            offsets = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))])
            n = np.append(np.diff(shared.value["starts"]), 0)[terms]
            cost = np.cumsum(np.add.reduceat(np.append(n, 0), offsets[:-1]) * (np.diff(offsets) > 0) + len(shared.value["least"]))
            bounds = np.unique(np.concatenate([[0], np.searchsorted(cost, np.arange(CELLS, cost[-1], CELLS)), [len(own)]]))
            for a, z in zip(bounds[:-1], bounds[1:]):
                doc, query, score = _row_scores(shared, a, z, terms, weights, offsets)
                yield pa.RecordBatch.from_arrays([shared.value["ids"].take(pa.array(query)), own.take(pa.array(doc)), pa.array(score)],
                                                 ["query_id", "id", "part"])

    if not len(t):
        return documents.sparkSession.createDataFrame([], f"query_id {kinds[0]}, id {kinds[1]}, part double")
    return documents.select("id", "terms", "weights").mapInArrow(run, f"query_id {kinds[0]}, id {kinds[1]}, part double")


def head_least(mine: DataFrame, postings: DataFrame, k: int, threshold: float, documents: DataFrame | None = None) -> DataFrame:
    """(query_id, least): a score that the k-th match of each query reaches for
    certain, or the threshold: the k-th largest partial score over the query's
    strongest blocks, as many as hold about ``HEAD * k`` postings."""
    strongest = Window.partitionBy("query_id").orderBy(F.desc(F.col("qweight") * F.col("top")), "term", "tier")
    head = mine.withColumn("before", F.sum("n").over(strongest.rowsBetween(Window.unboundedPreceding, -1)))
    head = head.where(F.coalesce("before", F.lit(0)) < HEAD * k)
    if documents is None:
        part = partial_scores(postings, head)
    else:
        # a term's strongest blocks are its first tiers
        cuts = head.groupBy("query_id", "term", "qweight").agg((F.max("tier") + 1).alias("cut"))
        part = row_scores(documents, cuts.withColumns({"least": F.lit(0), "rest": F.lit(0)}), complete=False)
    best = Window.partitionBy("query_id").orderBy(F.desc("part"))
    kth = part.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k)
    kth = kth.groupBy("query_id").agg(F.when(F.count("*") == k, F.min("part")).alias("kth"))
    every = mine.select("query_id").distinct().join(kth, "query_id", "left")
    return every.select("query_id", F.greatest(F.lit(float(threshold)), F.coalesce("kth", F.lit(0.0))).alias("least"))


def choose(mine: DataFrame) -> DataFrame:
    """Query blocks with ``least`` to (query_id, term, tier, qweight, n, least,
    given, skipped); ``given`` is what skipping a block and all before it gives up."""
    term = Window.partitionBy("query_id", "term").orderBy("top", F.desc("tier"))
    step = F.col("qweight") * (F.col("top") - F.coalesce(F.lag("top").over(term), F.lit(0.0)))
    rows = mine.withColumn("step", step)
    # a block cannot go before the ones below it: its ratio counts as the lowest so far
    rows = rows.withColumn("ratio", F.min(F.col("n") / F.greatest("step", F.lit(1e-300))).over(term))
    order = Window.partitionBy("query_id").orderBy(F.desc("ratio"), "term", "top", F.desc("tier"))
    rows = rows.withColumn("given", F.sum("step").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    skipped = F.col("given") < SHARE * F.col("least") - SLACK
    return rows.select("query_id", "term", "tier", "qweight", "n", "least", "given", skipped.alias("skipped"))


def chosen_blocks(mine: DataFrame, postings: DataFrame, threshold: float, top_k: int | None,
                  documents: DataFrame | None = None) -> DataFrame:
    """The choice among query blocks, stored: it is read several times."""
    if top_k is not None:
        size = mine.agg(F.sum("n").alias("n"), F.count_distinct("query_id").alias("queries")).first()
        if (size["n"] or 0) >= HEAD_WORTH * HEAD * top_k * size["queries"]:
            return stored(choose(mine.join(head_least(mine, postings, top_k, threshold, documents), "query_id")), "blocks")
    return stored(choose(mine.withColumn("least", F.lit(float(threshold)))), "blocks")


def completed(chosen: DataFrame, postings: DataFrame, documents: DataFrame | None = None) -> DataFrame:
    """(query_id, id, score) of the documents that may reach their query's ``least``."""
    limit = chosen.groupBy("query_id").agg(F.coalesce(F.max(F.when(F.col("skipped"), F.col("given"))), F.lit(0.0)).alias("rest"),
                                           F.first("least").alias("least"))
    if documents is not None:
        cut = F.coalesce(F.min(F.when(F.col("skipped"), F.col("tier"))), F.lit(float("inf")))
        wanted = chosen.groupBy("query_id", "term", "qweight").agg(cut.alias("cut")).join(limit, "query_id")
        return row_scores(documents, wanted).withColumnRenamed("part", "score")
    found = partial_scores(postings, chosen.where("not skipped")).join(limit, "query_id")
    alive = found.where(F.col("part") + F.col("rest") >= F.col("least") - SLACK).select("query_id", "id", "part")
    # a term's skipped blocks are its tiers from the first one skipped
    rest = chosen.where("skipped").groupBy("query_id", "term").agg(F.min("tier").alias("_from"), F.first("qweight").alias("qweight"))
    missing = alive.select("query_id", "id").join(rest, "query_id")
    tail = postings.join(rest.groupBy("term").agg(F.min("_from").alias("_least")), "term").where(F.col("tier") >= F.col("_least"))
    tail = tail.select("term", "id", "tier", "weight").join(alive.select("id").distinct(), "id", "left_semi")
    more = tail.join(missing, ["term", "id"]).where(F.col("tier") >= F.col("_from"))
    more = more.select("query_id", "id", (F.col("weight") * F.col("qweight")).alias("part"))
    return alive.unionAll(more).groupBy("query_id", "id").agg(F.sum("part").alias("score"))


def matches(queries: DataFrame, blocks: DataFrame, postings: DataFrame, threshold: float, top_k: int | None = None,
            gain: float = GAIN, small: int = SMALL, documents: DataFrame | None = None) -> DataFrame:
    """(query_id, id, score) of all documents that reach the threshold, and with
    ``top_k`` at least the best ``top_k`` of each query among them.  ``queries``
    are rows (query_id, term, qweight); ``threshold`` must be positive.
    ``documents`` are the same postings as ``document_table`` has them."""
    if threshold <= 0:
        raise ValueError("blocks are skipped by a positive threshold")
    if documents is not None:
        queries = stored(queries, "queries")
        if queries.count() > ROWS or queries.groupBy("query_id", "term").count().where("count > 1").limit(1).count():
            documents = None  # many queries, or a term given twice: a join
        elif gain > 0:
            every = queries.withColumns({"cut": F.lit(float("inf")), "least": F.lit(float(threshold)), "rest": F.lit(0.0)})
            return row_scores(documents, every).withColumnRenamed("part", "score")
    mine = stored(query_blocks(queries, blocks), "query-blocks")
    if (mine.agg(F.sum("n")).first()[0] or 0) >= small:
        chosen = chosen_blocks(mine, postings, threshold, top_k, documents)
        size = chosen.agg(F.sum("n").alias("all"), F.sum(F.when(F.col("skipped"), 0).otherwise(F.col("n"))).alias("read")).first()
        if (size["read"] or 0) * gain <= (size["all"] or 0):
            return completed(chosen, postings, documents)
    return partial_scores(postings, mine).withColumnRenamed("part", "score")
