"""Quality rules whose thresholds come from the data.

Each document gets counts (``MEASURES``) and from them rates in whole numbers.
A sketch of a rate in a group of documents is a table of counts by bucket; a
bucket is a whole number cut to its ``BITS`` leading bits, so sketches of any
parts merge by adding counts, do not depend on order, and a quantile read from
them is less than one part in ``2 ** (BITS - 1)`` too low.  Sketches are kept for
every (lang, source) and merged to languages and to the whole table; a group of
fewer than ``LEAST`` documents uses its language's, a language of fewer the
whole table's.

A rate is out of bounds when it lies more than ``REACH`` spreads from the
median.  The spread of the upper side is measured below the median and the
other way round (the quarter of the documents next to it, at least the rate's
``least spread``), so a tail of junk, even of a quarter of the group, does not
widen its own bounds.  Documents are joined with the bounds of their group.

Null and empty texts have no words and fail the base rule; documents without
words are in no sketch.  Null languages and sources are groups like any other.
Repeated rows count as often as they stand; other columns of the input are
not read.  A very long text is measured whole, in memory that grows with that
text alone.  An empty table gives no row."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rostrum.llm.common import scratch

#: Leading bits of a bucket.
BITS = 7
#: Documents that a group needs for thresholds of its own.
LEAST = 100
#: Spreads from the median.
REACH = 3
LEAST_WORDS = 50
MOST_REPEATED = 50

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
#: Rate: (times, of, per, least spread, whether there is a lower bound).
RATES = {
    "word_length": (100, "word_chars", "n_words", 30, True),
    "symbols": (10_000, "n_symbols", "n_words", 300, False),
    "dup_lines": (10_000, "n_dup_lines", "n_lines", 1_000, False),
    "repeats": (10_000, "n_repeat_words", "n_words", 1_000, False),
}
_SYMBOLS = b"#*$%&|<>"


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of three that occurs twice or more."""
    n = len(words)
    if n < 4:
        return 0
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, n)
    size = len(known)
    pairs = ids[:-1] * size + ids[1:]
    if size >= 1 << 21:  # three ids would not fit 63 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * size + ids[2:]
    order = np.argsort(windows, kind="stable")
    ranked = windows[order]
    twice = np.zeros(n - 2, bool)
    same = ranked[1:] == ranked[:-1]
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    inside = np.zeros(n, bool)
    for k in range(3):
        inside[k:n - 2 + k] |= twice
    return int(inside.sum())


def measure(text: bytes | None) -> tuple[int, ...]:
    """The ``MEASURES`` of a UTF-8 text; words are runs without ASCII white space."""
    text = text or b""
    words = text.split()
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    chars = sum(map(len, words)) if text.isascii() else sum(len(w.decode()) for w in words)
    return (len(words), chars, sum(text.count(c) for c in _SYMBOLS), len(lines) - len(set(lines)), repeated_words(words), len(lines))


def measures(documents: DataFrame) -> DataFrame:
    """doc_id, lang, source and the ``MEASURES`` of every row."""

    def run(batches):
        for b in batches:
            texts = b.column(3).cast(pa.binary()).to_pylist()
            got = np.array([measure(t) for t in texts], np.int64).reshape(-1, len(MEASURES))
            yield pa.RecordBatch.from_arrays([*b.columns[:3], *(pa.array(got[:, k]) for k in range(len(MEASURES)))],
                                             ["doc_id", "lang", "source", *MEASURES])

    rows = documents.select("doc_id", "lang", "source", F.col("text").cast("string").alias("text"))
    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in ("doc_id", "lang", "source"))
    return rows.mapInArrow(run, kinds + "".join(f", {m} long" for m in MEASURES))


def with_rates(rows: DataFrame) -> DataFrame:
    return rows.withColumns({k: F.expr(f"{times} * {of} div nullif({per}, 0)") for k, (times, of, per, _, _) in RATES.items()})


def sketches(rows: DataFrame) -> DataFrame:
    """(lang, source, rate, bucket, n) of the documents with words."""
    each = rows.where("n_words > 0").select("lang", "source", F.explode(F.array(*(
        F.struct(F.lit(k).alias("rate"), F.col(k).alias("v")) for k in RATES))).alias("e"))
    cut = F.expr(f"greatest(length(bin(e.v)) - {BITS}, 0)")
    each = each.select("lang", "source", "e.rate", F.col("e.v").alias("v"), cut.alias("cut"))
    return each.groupBy("lang", "source", "rate", F.expr("shiftleft(shiftright(v, cut), cut)").alias("bucket")).agg(F.count("*").alias("n"))


def merge(sketch: DataFrame, *keys: str) -> DataFrame:
    return sketch.groupBy(*keys, "rate", "bucket").agg(F.sum("n").alias("n"))


def bounds(sketch: DataFrame, *keys: str) -> DataFrame:
    """(keys, rate, docs, low, high) from the sketches of the keys' groups; low
    is null where a rate has no lower bound."""
    group = Window.partitionBy(*keys, "rate")
    so_far = group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    at = sketch.select(*keys, "rate", "bucket", F.sum("n").over(so_far).alias("upto"), F.sum("n").over(group).alias("docs"))
    quarter = [F.min(F.when(F.col("upto") * 4 >= F.col("docs") * k, F.col("bucket"))).alias(f"q{k}") for k in (1, 2, 3)]
    q = at.groupBy(*keys, "rate").agg(F.first("docs").alias("docs"), *quarter)
    least = F.create_map(*(x for k, r in RATES.items() for x in (F.lit(k), F.lit(r[3]))))[F.col("rate")]
    two = F.col("rate").isin([k for k, r in RATES.items() if r[4]])
    return q.select(*keys, "rate", "docs",
                    F.when(two, F.col("q2") - REACH * F.greatest(F.col("q3") - F.col("q2"), least)).alias("low"),
                    (F.col("q2") + REACH * F.greatest(F.col("q2") - F.col("q1"), least)).alias("high"))


def thresholds(sketch: DataFrame) -> DataFrame:
    """(lang, source, and low and high of each rate) for every group: its own
    bounds, its language's or the whole table's."""

    def wide(rows: DataFrame, mark: str, *keys: str) -> DataFrame:
        picks = [F.max(F.when(F.col("rate") == k, F.col(side))).alias(f"{mark}_{k}_{side}") for k in RATES for side in ("low", "high")]
        return rows.groupBy(*keys).agg(F.first("docs").alias(f"{mark}_docs"), *picks)

    own = wide(bounds(sketch, "lang", "source"), "own", "lang", "source")
    lang = wide(bounds(merge(sketch, "lang"), "lang"), "lang", "lang").withColumnRenamed("lang", "_lang")
    whole = wide(bounds(merge(sketch).withColumn("_all", F.lit(0)), "_all"), "all", "_all")
    joined = own.withColumn("_one", F.lit(0)).join(lang, F.col("lang").eqNullSafe(F.col("_lang"))).join(whole, F.col("_one") == F.col("_all"))

    def chosen(c: str):
        return F.when(F.col("own_docs") >= LEAST, F.col(f"own_{c}")).when(F.col("lang_docs") >= LEAST, F.col(f"lang_{c}")).otherwise(F.col(f"all_{c}"))

    return joined.select(F.col("lang").alias("_lang"), F.col("source").alias("_source"),
                         *(chosen(f"{k}_{side}").alias(f"{k}_{side}") for k in RATES for side in ("low", "high")))


def judge(documents: DataFrame) -> DataFrame:
    """doc_id, lang, source, the ``MEASURES``, the rates with their bounds,
    base_failed and kept of every row.  The measures, numbers only, are written to the
    shared folder once and read by both the sketches and the join."""
    spark = documents.sparkSession
    path = scratch(spark, "measures")
    measures(documents).write.parquet(path)
    rows = with_rates(spark.read.parquet(path))
    limits = thresholds(sketches(rows))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    out = F.lit(False)
    for k in RATES:
        out = out | F.coalesce(F.col(k) > F.col(f"{k}_high"), F.lit(False)) | F.coalesce(F.col(k) < F.col(f"{k}_low"), F.lit(False))
    same = F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source"))
    rows = rows.withColumn("base_failed", failed)
    return rows.join(limits, same, "left").withColumn("kept", ~F.col("base_failed") & ~out).drop("_lang", "_source")
