"""Sentiment lexicon preparation (inventory F4-F8).

The lexicon is an annotated word list (tens of thousands of rows): every step
is a column expression or a small aggregate; nothing is collected.

Entry order matters for the stem merge (F7), so every entry carries an
explicit order key ``(grp, fpos, idx)`` reproducing the order of the
reference's dictionaries: single terms keep the position of their first row
(``grp`` 0); forms that only come from comma lists follow all of them
(``grp`` 1), in order of their first list and place in it.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rostrum.functions import text as tx
from rostrum.operators import corpus as co
from rostrum.operators.tfidf import Stems

POLARITY_COLS = ["polarity1", "polarity2", "polarity3", "polarity4"]
# Annotator labels and their scores; anything else scores 0.
POLARITY_SCORES = {"POS": 1, "NEG": -1, "BOTH": 0, "N/A": 0}

#: Rows of the lexicon whose forms of one stem are folded together.
SEGMENT = 4096


def read_lexicon(spark, path: str, sep: str = "\t") -> DataFrame:
    """A5: a tab-separated lexicon with a header: column ``Term`` and the four
    annotators' polarity labels in value positions 8-11 (columns 10-13 of
    the file, counting ``Term`` as the first)."""
    raw = spark.read.option("header", True).option("sep", sep).csv(path)
    cols = raw.columns
    term_col = "Term" if "Term" in cols else cols[0]
    values = [c for c in cols if c != term_col]
    pos = F.monotonically_increasing_id()
    return raw.select(
        pos.alias("pos"),
        F.col(term_col).alias("term"),
        *[F.col(f"`{values[i]}`").alias(POLARITY_COLS[i - 8]) if i < len(values) else F.lit(None).cast("string")
          .alias(POLARITY_COLS[i - 8]) for i in range(8, 12)],
    )


def clean_terms(rows: DataFrame, term_col: str = "term") -> DataFrame:
    """lower-case; a term with a space keeps its first word and adds, for
    every ending after the first in the second word's ``-``-separated list,
    the first word minus two characters plus that ending; forms are joined by
    commas.  Adds ``cleaned``."""
    low = F.lower(F.col(term_col))
    comps = F.split(low, " ", -1)
    first = F.get(comps, 0)
    extra = F.split(F.replace(F.get(comps, 1), F.lit(" "), F.lit("")), "-", -1)
    stem = F.expr("substring(_first, 1, greatest(length(_first) - 2, 0))")
    with_parts = rows.withColumn("_first", first).withColumn("_extra", extra)
    endings = F.slice("_extra", 2, F.greatest(F.size("_extra") - 1, F.lit(0)))
    forms = F.concat(F.array("_first"), F.transform(endings, lambda e: F.concat(stem, e)))
    cleaned = F.when(F.instr(low, " ") > 0, F.array_join(forms, ",")).otherwise(low)
    return with_parts.withColumn("cleaned", cleaned).drop("_first", "_extra")


def expand_forms(cleaned: DataFrame) -> DataFrame:
    """one row per word form (comma lists split), with the values that
    win for it and its entry order ``(grp, fpos, idx)``: a later duplicate
    row wins the values; a comma list overrides a single term's values; the
    later of two comma lists containing a form wins."""
    vals = F.struct(*POLARITY_COLS)
    keys = cleaned.groupBy("cleaned").agg(F.min("pos").alias("fpos"), F.max_by(vals, F.col("pos")).alias("vals"))
    singles = keys.filter(~F.col("cleaned").contains(",")).select(
        F.col("cleaned").alias("form"), F.col("fpos").alias("s_fpos"), F.col("vals").alias("s_vals"))
    lists = keys.filter(F.col("cleaned").contains(",")).select(
        "fpos", "vals", F.posexplode(F.split("cleaned", ",", -1)).alias("idx", "form"))
    from_lists = lists.groupBy("form").agg(
        F.max_by("vals", "fpos").alias("l_vals"),
        F.min(F.struct("fpos", "idx")).alias("first"),
    )
    j = singles.join(from_lists, "form", "full")
    return j.select(
        "form",
        F.when(F.col("s_fpos").isNotNull(), F.lit(0)).otherwise(F.lit(1)).alias("grp"),
        F.coalesce("s_fpos", "first.fpos").alias("fpos"),
        F.when(F.col("s_fpos").isNotNull(), F.lit(0)).otherwise(F.col("first.idx")).cast("int").alias("idx"),
        *[F.when(F.col("l_vals").isNotNull(), F.col(f"l_vals.{c}")).otherwise(F.col(f"s_vals.{c}")).alias(c)
          for c in POLARITY_COLS],
    )


def _score(c: str):
    expr = F.lit(0)
    for label, score in POLARITY_SCORES.items():
        if score:
            expr = F.when(F.col(c) == label, F.lit(score)).otherwise(expr)
    return expr


def average_polarity(forms: DataFrame) -> DataFrame:
    """mean of the four annotators' scores (POS 1, NEG -1, else 0),
    always divided by four."""
    total = sum((_score(c) for c in POLARITY_COLS), F.lit(0))
    return forms.withColumn("polarity", total / F.lit(4.0))


def stem_forms(forms: DataFrame, stopwords: Iterable[str] = (), stems: Stems = None) -> DataFrame:
    """F7 first half: each form normalised like speech text (lexicon variant:
    punctuation removed, digits kept) and its stems joined by spaces."""
    if isinstance(stems, DataFrame):
        kept = forms.withColumn("_t", tx.kept_tokens("form", stopwords, tx.LEXICON_DROP_PATTERN))
        out = co.stem_arrays(kept, stems, key=["form"], tokens_col="_t")
        return out.withColumn("stem", F.array_join("_t", " ")).drop("_t")
    toks = tx.normalize("form", stopwords, stems, drop_pattern=tx.LEXICON_DROP_PATTERN)
    return forms.withColumn("stem", F.array_join(toks, " "))


def merge_stems(stemmed: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """one polarity per stem; forms colliding on a stem are merged by the
    running half-average ``(old + new) / 2`` in entry order.

    Half-averages over a run of n entries take any old value to
    ``old / 2**n + s`` with ``s`` the sum of entry i times ``2**-(n - i)``, so runs
    merge: a stem's entries are cut by ``fpos`` into segments of ``segment`` rows of the
    lexicon, each gives its (n, s, first), and a segment's s counts ``2**-(entries
    after it)``.  (Folding the first entry into itself leaves it as it is.)
    No group holds all forms of a stem.  Entries far enough back to underflow
    count as zero, as they do when folded one by one."""
    ok = stemmed.filter(F.length("stem") > 0)
    runs = ok.groupBy("stem", "grp", F.floor(F.col("fpos") / segment).alias("seg")).agg(
        F.sort_array(F.collect_list(F.struct("fpos", "idx", "polarity"))).alias("xs"))
    fold = F.aggregate("xs", F.lit(0.0), lambda acc, x: (acc + x["polarity"]) / F.lit(2.0))
    runs = runs.select("stem", "grp", "seg", F.size("xs").alias("n"), fold.alias("s"), F.get("xs", 0)["polarity"].alias("first"))
    later = Window.partitionBy("stem").orderBy(F.desc("grp"), F.desc("seg")).rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("after", F.coalesce(F.sum("n").over(later), F.lit(0)))
    return runs.groupBy("stem").agg(
        (F.sum(F.col("s") * F.pow(F.lit(2.0), -F.col("after")))
         + F.min_by("first", F.struct("grp", "seg")) * F.pow(F.lit(2.0), -F.sum("n"))).alias("polarity"))


def rejects(stemmed: DataFrame) -> DataFrame:
    """F8: forms whose normalisation leaves nothing (warned about and skipped)."""
    return stemmed.filter(F.length("stem") == 0).select("form")


def prepare(rows: DataFrame, stopwords: Iterable[str] = (), stems: Stems = None) -> DataFrame:
    """Raw lexicon rows -> (stem, polarity)."""
    forms = average_polarity(expand_forms(clean_terms(rows)))
    return merge_stems(stem_forms(forms, stopwords, stems))
