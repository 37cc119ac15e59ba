"""TF-IDF as DataFrames (inventory C5, D3-D8).

Data layout
-----------
``tokens``   (id, tokens array<string>)          one row per document
``postings`` (id, term, tf)                      one row per document and term
``vocab``    (term, term_id, df, ctf, idf)       at most ``max_features`` rows
``weights``  (id, term, tf, weight)              L2-normalised tf*idf, vocab terms only

Plan shape at scale
-------------------
* Term counting stays inside each document's row (sort + run lengths), so the
  text never shuffles and no (id, term) exchange is needed.
* Document frequency is one ``groupBy(term)`` with map-side partial
  aggregation: each task ships at most its distinct terms.
* The vocabulary is a global top-k (``TakeOrderedAndProject``) bounded by
  ``max_features``; only that bounded table is broadcast.
* The per-document L2 norm is a window on ``id``; it is the only exchange of
  postings, and keyword ranking downstream re-uses it.
* The corpus size ``n`` is a scalar subquery, not a join.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rostrum.functions import text as tx
from rostrum.operators import corpus as co
from rostrum.session import stored

#: Stem dictionary: a short mapping or a (token, stem) table.
Stems = Mapping[str, str] | DataFrame | None

# Largest vocabulary we broadcast (rows); max_features of the reference is 10,000.
MAX_BROADCAST_VOCAB = 2_000_000


def tokenize(
    docs: DataFrame,
    id_col: str = "id",
    text_col: str = "merged_speech",
    stopwords: Iterable[str] = (),
    stems: Stems = None,
    drop_null: bool = True,
    suffix_rule: str | None = None,
    carry: Iterable[str] = (),
) -> DataFrame:
    """(id, *carry, tokens) per document.  ``drop_null`` follows the
    speech TF-IDF path (B1, rows without text are removed); otherwise null
    text counts as an empty document (B2).  ``carry`` keeps small metadata
    columns beside the tokens so later steps need no join back.  ``stems`` is a
    mapping (row-local) or a (token, stem) table (joined; ids must be unique)."""
    carry = list(carry)
    src = docs.select(F.col(id_col).alias("id"), *carry, F.col(text_col).alias("text"))
    if drop_null:
        src = src.dropna(subset=["text"])
    else:
        src = src.withColumn("text", F.coalesce("text", F.lit("")))
    if isinstance(stems, DataFrame):
        kept = src.select("id", *carry, tx.kept_tokens("text", stopwords).alias("tokens"))
        return co.stem_arrays(kept, stems, suffix_rule=suffix_rule)
    norm = tx.normalize("text", stopwords, stems, suffix_rule=suffix_rule).alias("tokens")
    return src.select("id", *carry, norm)


def to_all_tasks(table: DataFrame, name: str) -> DataFrame:
    """A table stored once, with a broadcast hint if it is no longer than the largest
    vocabulary that is broadcast; else its joins are the planner's."""
    table = stored(table, name)
    return F.broadcast(table) if table.count() <= MAX_BROADCAST_VOCAB else table


def _words_of(st: DataFrame, only: DataFrame) -> DataFrame:
    """(_low, _stem) of the words whose stem is a term of ``only``: those of the
    dictionary, and terms that it lacks, which are their own stems."""
    only = only.select(F.col("term").alias("_term")).dropna().distinct()
    known = st.join(only, F.col("_stem") == F.col("_term"), "left_semi")
    other = only.join(st, F.col("_low") == F.col("_term"), "left_anti")
    return to_all_tasks(known.union(other.select("_term", F.col("_term").alias("_stem"))), "words")


def _stem_of(stems: DataFrame, suffix_rule: str | None = None) -> tuple[DataFrame, F.Column]:
    """The dictionary as (_low, _stem) with one stem a token, and the stem of a
    lower-cased ``term`` joined with it."""
    st = stems.groupBy(F.col("token").alias("_low")).agg(F.min("stem").alias("_stem"))
    other = F.regexp_replace("term", F.lit(suffix_rule), F.lit("")) if suffix_rule else F.col("term")
    return st, F.coalesce("_stem", other)


def vocabulary_postings(docs: DataFrame, id_col: str, text_col: str, stopwords: Iterable[str], stems: DataFrame,
                        max_features: int, min_len: int = 2) -> DataFrame:
    """C5 + D3 + D5: (id, term, tf) of the ``max_features`` terms of highest corpus
    count (ties by term), with a (token, stem) table of any size.

    Corpus counts add up over a stem's words, so the terms are found from
    a table with a row for each distinct word, and only that table meets the
    dictionary.  Documents' counted words are stored once and meet only the
    words of those terms: their counts move once, to their document."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).dropna(subset=["text"])
    words = F.transform(tx.kept_tokens("text", stopwords), F.lower)
    counted = stored(tx.with_term_counts(src.select("id", words.alias("tokens")), min_len=1), "counted-words")
    rows = counted.select("id", F.inline_outer("terms")).filter(F.col("term").isNotNull())
    st, stem = _stem_of(stems)
    known = rows.groupBy("term").agg(F.sum("tf").alias("tf")).join(st, F.col("term") == F.col("_low"), "left")
    known = known.select(F.col("term").alias("_word"), stem.alias("_term"), "tf").filter(F.length("_term") >= max(min_len, 1))
    known = stored(known, "words")
    top = known.groupBy("_term").agg(F.sum("tf").alias("_ctf")).orderBy(F.desc("_ctf"), F.asc("_term")).limit(max_features)
    own = stored(known.join(top, "_term").select("_word", "_term"), "vocabulary-words")
    rows = rows.join(own, F.col("term") == F.col("_word")).select("id", F.col("_term").alias("term"), "tf")
    return rows.repartition("id").groupBy("id", "term").agg(F.sum("tf").alias("tf"))


def stem_counts(
    docs: DataFrame,
    id_col: str = "id",
    text_col: str = "merged_speech",
    stopwords: Iterable[str] = (),
    stems: Stems = None,
    drop_null: bool = True,
    suffix_rule: str | None = None,
    carry: Iterable[str] = (),
    min_len: int = 2,
    keep_empty: bool = False,
    only: DataFrame | None = None,
) -> DataFrame:
    """C5 + D3 where order does not matter: (id, *carry, term, tf), counted
    inside each document's row before it is stemmed, so that only distinct words
    meet the dictionary and no text or token moves.  With a (token, stem) table a
    document has a row for each of its words: words of one stem are not yet
    added up.  ``keep_empty`` keeps a document without a term as a row of null term.
    ``only``, a table of terms, says which terms are asked for: with a stem table and no
    suffix rule all others are null, and the documents' words meet only the words of these."""
    carry = list(carry)
    table = isinstance(stems, DataFrame)
    src = docs.select(F.col(id_col).alias("id"), *carry, F.col(text_col).alias("text"))
    src = src.dropna(subset=["text"]) if drop_null else src.withColumn("text", F.coalesce("text", F.lit("")))
    words = F.transform(tx.kept_tokens("text", stopwords), F.lower) if table else tx.normalize("text", stopwords, stems, suffix_rule=suffix_rule)
    counted = tx.with_term_counts(src.select("id", *carry, words.alias("tokens")), min_len=1 if table else min_len)
    rows = counted.select("id", *carry, F.inline_outer("terms"))
    if table:
        st, stem = _stem_of(stems, suffix_rule)
        if only is not None and suffix_rule is None:
            st, stem = _words_of(st, only), F.col("_stem")
        long = F.length(stem) >= max(min_len, 1)
        rows = rows.join(st, F.col("term") == F.col("_low"), "left").select("id", *carry, F.when(long, stem).alias("term"), "tf")
    return rows if keep_empty else rows.filter(F.col("term").isNotNull())


def postings(tokens: DataFrame, min_len: int = 2, carry: Iterable[str] = ()) -> DataFrame:
    """D3: (id, *carry, term, tf) — term counts per document, computed
    row-locally."""
    t = tx.with_term_counts(tokens.select("id", *carry, "tokens"), min_len=min_len)
    # inline_outer: a plain inline makes the optimizer infer a non-empty filter
    # on the generator input and push it below the projections above, which
    # would re-evaluate the whole sort per element.
    return t.select("id", *carry, F.inline_outer("terms")).filter(F.col("term").isNotNull())


def doc_freq(post: DataFrame, key: str = "id") -> DataFrame:
    """(term, df, ctf) — documents containing the term and total count."""
    return post.groupBy("term").agg(F.count(key).alias("df"), F.sum("tf").alias("ctf"))


def vocabulary(dfreq: DataFrame, n_docs, max_features: int | None = 10_000) -> DataFrame:
    """D5 + D6: the ``max_features`` terms of highest corpus count (ties by
    term), numbered in term order, with smooth idf ``ln((1+n)/(1+df)) + 1``."""
    top = dfreq
    if max_features is not None:
        top = dfreq.orderBy(F.desc("ctf"), F.asc("term")).limit(max_features)
    n = n_docs if isinstance(n_docs, F.Column) else F.lit(n_docs)
    idf = F.log((n + F.lit(1.0)) / (F.col("df") + F.lit(1.0))) + F.lit(1.0)
    # term_id follows the vectoriser's alphabetical feature order; a window only
    # numbers a bounded vocabulary, an unbounded one is numbered by range partitions
    if max_features is not None:
        term_id = F.row_number().over(Window.orderBy("term")) - 1
    else:
        top, term_id = co.with_position(dfreq, "term"), F.col("pos") - 1
    return top.select(
        "term",
        term_id.cast("int").alias("term_id"),
        F.col("df").cast("long").alias("df"),
        F.col("ctf").cast("long").alias("ctf"),
        idf.alias("idf"),
    )


def _vocab_side(vocab: DataFrame, max_features: int | None) -> DataFrame:
    if max_features is not None and max_features <= MAX_BROADCAST_VOCAB:
        return F.broadcast(vocab)
    return vocab


def weights(post: DataFrame, vocab: DataFrame, key: str = "id", max_features: int | None = 10_000) -> DataFrame:
    """(key, term, tf, weight) with weight = tf*idf / ||tf*idf||_2 over the
    document's vocabulary terms; terms outside the vocabulary are dropped."""
    v = _vocab_side(vocab.select("term", "idf"), max_features)
    raw = post.join(v, "term").withColumn("w", F.col("tf") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(key)))
    return raw.select(key, "term", "tf", (F.col("w") / norm).alias("weight"))


@dataclass
class TfidfModel:
    """A fitted corpus: documents (or groups), postings, vocabulary and weights."""

    docs: DataFrame
    postings: DataFrame
    vocab: DataFrame
    weights: DataFrame
    n_docs: F.Column
    max_features: int | None
    used: DataFrame | None = None  # the persisted postings that the weights read, where they are not all postings

    def unpersist(self) -> None:
        if self.used is not None:
            self.used.unpersist()
        self.postings.unpersist()
        self.vocab.unpersist()


def fit(
    docs: DataFrame,
    id_col: str = "id",
    text_col: str = "merged_speech",
    stopwords: Iterable[str] = (),
    stems: Stems = None,
    max_features: int | None = 10_000,
    persist: bool = True,
) -> TfidfModel:
    """C5 + D3-D7 over a document table (ids must be unique).  Words are
    counted in their rows; the counts of a document's words move once, to
    their document, where words of one stem are added up: the
    partitioning that the weights' norm needs anyway.  The postings and the
    vocabulary are persisted (memory and disk) because every later step reads
    them; they are recomputed from their lineage if an executor is lost.  With a
    stem table and a bounded vocabulary the weights come from the postings of the
    vocabulary's terms alone (``vocabulary_postings``); all postings are only
    computed where they are read."""
    ids = docs.dropna(subset=[text_col]).select(F.col(id_col).alias("id"))
    n = ids.select(F.count("*")).scalar()
    post = stem_counts(docs, id_col, text_col, stopwords, stems)
    if isinstance(stems, DataFrame):
        post = post.repartition("id").groupBy("id", "term").agg(F.sum("tf").alias("tf"))
    if persist:
        post = post.persist(StorageLevel.MEMORY_AND_DISK)
    used = post
    if persist and isinstance(stems, DataFrame) and max_features is not None:
        used = vocabulary_postings(docs, id_col, text_col, stopwords, stems, max_features).persist(StorageLevel.MEMORY_AND_DISK)
    vocab = vocabulary(doc_freq(used), n, max_features)
    if persist:
        vocab = vocab.persist(StorageLevel.MEMORY_AND_DISK)
    w = weights(used, vocab, "id", max_features)
    return TfidfModel(ids, post, vocab, w, n, max_features, used)


def transform(tokens: DataFrame, vocab: DataFrame, key: str = "id", max_features: int | None = 10_000) -> DataFrame:
    """Weights of unseen documents (e.g. queries) with a fitted vocabulary;
    unknown terms are ignored."""
    return weights(postings(tokens), vocab, key, max_features)


def group_postings(counts: DataFrame, group_col: str = "member_name") -> DataFrame:
    """D2 re-aimed: term counts of all documents of a group (e.g. a member),
    summed instead of concatenating the texts (the concatenation order is
    unspecified in the reference, the counts are not).  Partial aggregation
    runs before the shuffle, so a group holding a third of the corpus still
    ships at most one row per (task, term); the final aggregate is spread over
    reducers by (group, term)."""
    return counts.dropna(subset=[group_col]).groupBy(group_col, "term").agg(F.sum("tf").alias("tf"))


def fit_groups(
    docs: DataFrame,
    group_col: str = "member_name",
    text_col: str = "merged_speech",
    stopwords: Iterable[str] = (),
    stems: Stems = None,
    max_features: int | None = 10_000,
) -> TfidfModel:
    """TF-IDF with one document per group (member TF-IDF): n counts the
    groups that have any text."""
    groups = docs.dropna(subset=[text_col, group_col]).select(group_col).distinct()
    n = groups.select(F.count("*")).scalar()
    gp = group_postings(stem_counts(docs, "id", text_col, stopwords, stems, carry=[group_col]), group_col)
    gp = gp.persist(StorageLevel.MEMORY_AND_DISK)
    vocab = vocabulary(doc_freq(gp, group_col), n, max_features).persist(StorageLevel.MEMORY_AND_DISK)
    w = weights(gp, vocab, group_col, max_features)
    return TfidfModel(groups, gp, vocab, w, n, max_features)
