"""Lexicon sentiment per speech, party and year (inventory F1-F3, with B4,
B9, B10).

Words are counted in each speech's row, stemmed and joined with the stemmed
lexicon (no hint); the per-speech mean is an aggregate whose
partial step collapses each speech inside its own task, so one row per
speech is shuffled.  Word counts per party are (party, word) aggregates,
never per-party collections, so a party holding a third of the corpus costs
no more than any other key.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rostrum.functions import text as tx
from rostrum.operators import corpus as co
from rostrum.operators import tfidf

# The reference's canonical party names (lower-cased raw name ->
# canonical) and the five parties it analyses.
GREEK_PARTY_MAP = {
    "νεα δημοκρατια": "Νέα Δημοκρατία",
    "πανελληνιο σοσιαλιστικο κινημα": "ΠΑΣΟΚ-ΚΙΝΗΜΑ ΑΛΛΑΓΗΣ",
    "δημοκρατικη συμπαραταξη (πανελληνιο σοσιαλιστικο κινημα - δημοκρατικη αριστερα)": "ΠΑΣΟΚ-ΚΙΝΗΜΑ ΑΛΛΑΓΗΣ",
    "κινημα αλλαγης": "ΠΑΣΟΚ-ΚΙΝΗΜΑ ΑΛΛΑΓΗΣ",
    "πασοκ-κινημα αλλαγης": "ΠΑΣΟΚ-ΚΙΝΗΜΑ ΑΛΛΑΓΗΣ",
    "συνασπισμος ριζοσπαστικης αριστερας": "Συνασπισμός Ριζοσπαστικής Αριστεράς",
    "συνασπισμος ριζοσπαστικης αριστερας - προοδευτικη συμμαχια": "Συνασπισμός Ριζοσπαστικής Αριστεράς",
    "κομμουνιστικο κομμα ελλαδας": "Κομμουνιστικό Κόμμα Ελλάδας",
    "λαικος συνδεσμος - χρυση αυγη": "Λαϊκός Σύνδεσμος - Χρυσή Αυγή",
}
GREEK_SELECTED_PARTIES = [
    "Νέα Δημοκρατία",
    "ΠΑΣΟΚ-ΚΙΝΗΜΑ ΑΛΛΑΓΗΣ",
    "Συνασπισμός Ριζοσπαστικής Αριστεράς",
    "Κομμουνιστικό Κόμμα Ελλάδας",
    "Λαϊκός Σύνδεσμος - Χρυσή Αυγή",
]


def party_speech_terms(speeches: DataFrame, party_map, parties: Iterable[str], stopwords: Iterable[str] = (),
                       stems: tfidf.Stems = None, lexicon: DataFrame | None = None) -> DataFrame:
    """Speeches of the selected parties with a valid year, as (id,
    standard_party, year, term, tf) rows; a speech without a term has one of
    null term.  Null text counts as empty (B2).  Speeches are selected before
    their text is read.  With a stem table and the ``lexicon`` only its stems are looked
    up, the terms of other words are null: they count for nothing in what follows."""
    std = co.selected_parties(co.standardize_party(speeches, party_map), parties)
    dated = std.withColumn("year", tx.lenient_year("sitting_date")).filter(F.col("year").isNotNull())
    return tfidf.stem_counts(dated, "id", "merged_speech", stopwords, stems, drop_null=False,
                             carry=["standard_party", "year"], min_len=1, keep_empty=True,
                             only=None if lexicon is None else lexicon.select(F.col("stem").alias("term")))


def speech_polarity(terms: DataFrame, lexicon: DataFrame, keys: Iterable[str] = ("standard_party", "year")) -> DataFrame:
    """mean lexicon polarity of each speech's tokens (repeats count),
    0 when none of its tokens is in the lexicon."""
    keys = list(keys)
    lex = lexicon.select(F.col("stem").alias("term"), "polarity")
    j = terms.join(lex, "term", "left")
    hits = F.sum(F.when(F.col("polarity").isNotNull(), F.col("tf")))
    mean = F.sum(F.col("polarity") * F.col("tf")) / hits
    return j.groupBy("id", *keys).agg(F.coalesce(mean, F.lit(0.0)).alias("polarity"))


def polarity_trend(polarity: DataFrame) -> DataFrame:
    """mean speech polarity per party and year."""
    return polarity.groupBy("standard_party", "year").agg(F.avg("polarity").alias("polarity"))


def polarity_pivot(trend: DataFrame, parties: list[str]) -> DataFrame:
    """Year x party matrix (missing cells stay null)."""
    return trend.groupBy("year").pivot("standard_party", parties).agg(F.first("polarity"))


def top_polar_words(terms: DataFrame, lexicon: DataFrame, stopwords: Iterable[str] = (), top_n: int = 10) -> DataFrame:
    """F3 (+B13): per party the ``top_n`` most frequent positive and negative
    lexicon words (stopwords skipped, zero polarity ignored); ties by word.
    (party, word, frequency, polarity)."""
    lex = lexicon.filter(F.col("polarity") != 0).select(F.col("stem").alias("word"), "polarity")
    ex = terms.select(F.col("standard_party").alias("party"), F.col("term").alias("word"), "tf")
    stop = sorted(set(stopwords))
    if stop:
        ex = ex.filter(~F.col("word").isin(stop))
    j = ex.join(lex, "word")
    sign = F.when(F.col("polarity") > 0, F.lit("positive")).otherwise(F.lit("negative"))
    counts = j.groupBy("party", sign.alias("polarity"), "word").agg(F.sum("tf").alias("frequency"))
    w = Window.partitionBy("party", "polarity").orderBy(F.desc("frequency"), F.asc("word"))
    ranked = counts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top_n)
    return ranked.select("party", "word", "frequency", "polarity", F.col("rank").cast("int"))
