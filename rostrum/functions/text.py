"""Column expressions for text normalisation and small scalar helpers.

Everything here returns a ``Column`` built from native Spark SQL functions, so
it runs inside whole-stage code generation (or Spark's own higher-order
function evaluation for arrays) and never crosses into Python.

The normaliser (inventory C1-C4) works on one document row at a time and keeps
the document in its row: tokens are an ``array<string>``, term counts an
``array<struct<term, tf>>``.  Nothing here shuffles.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A token is a run of Unicode letters, digits and underscores (Python's ``\w``;
# Java's and RE2's ``\w`` are ASCII-only, so the classes are spelled out).
TOKEN_PATTERN = r"[\p{L}\p{N}_]+"
# Characters the speech normaliser deletes inside a token: of its punctuation
# set only ASCII digits and the underscore can occur inside a token as defined
# above (the rest are separators already).
SPEECH_DROP_PATTERN = r"[0-9_]"
# The lexicon normaliser deletes ``[^\w\s]`` only, which leaves tokens intact.
LEXICON_DROP_PATTERN = None

# Python's str.strip() removes every character whose isspace() is true.
PY_SPACE = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\p{Z}]"
STRIP_PATTERN = f"^{PY_SPACE}+|{PY_SPACE}+$"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def raw_tokens(text: str | Column) -> Column:
    """Split a text into word tokens (null text gives null)."""
    return F.regexp_extract_all(_col(text), F.lit(TOKEN_PATTERN), 0)


def clean_tokens(tokens: Column, drop_pattern: str | None = SPEECH_DROP_PATTERN) -> Column:
    """Delete unwanted characters inside every token."""
    if not drop_pattern:
        return tokens
    return F.transform(tokens, lambda t: F.regexp_replace(t, F.lit(drop_pattern), F.lit("")))


def keep_tokens(tokens: Column, stopwords: Iterable[str] = (), min_len: int = 2) -> Column:
    """Drop empty and short tokens and stopwords (compared lower-cased).

    ``isin`` with more than ten literals is turned into a hash-set lookup by
    the optimizer, so long stopword lists stay cheap."""
    stop = sorted(set(stopwords))

    def keep(t: Column) -> Column:
        cond = F.length(t) >= min_len
        if stop:
            cond = cond & ~F.lower(t).isin(stop)
        return cond

    return F.filter(tokens, keep)


def stem_tokens(tokens: Column, stems: Mapping[str, str] | None = None, suffix_rule: str | None = None) -> Column:
    """Lower-case each token, replace it by its dictionary stem when the
    dictionary has one (else apply the optional suffix rule), drop empties.

    A mapping becomes a literal map, which is scanned once per token: it suits
    a short list of exceptions.  A real dictionary is a (token, stem) table
    and goes through ``operators.corpus.stem_arrays``."""
    stems = dict(stems or {})
    lookup = F.create_map(*[F.lit(x) for kv in sorted(stems.items()) for x in kv]) if stems else None

    def stem(t: Column) -> Column:
        low = F.lower(t)
        fallback = F.regexp_replace(low, F.lit(suffix_rule), F.lit("")) if suffix_rule else low
        return F.coalesce(F.try_element_at(lookup, low), fallback) if lookup is not None else fallback

    return F.filter(F.transform(tokens, stem), lambda s: F.length(s) > 0)


def normalize(
    text: str | Column,
    stopwords: Iterable[str] = (),
    stems: Mapping[str, str] | None = None,
    drop_pattern: str | None = SPEECH_DROP_PATTERN,
    suffix_rule: str | None = None,
) -> Column:
    """C1-C3 as one expression: text -> array of stems (null text -> null)."""
    return stem_tokens(kept_tokens(text, stopwords, drop_pattern), stems, suffix_rule)


def kept_tokens(text: str | Column, stopwords: Iterable[str] = (),
                drop_pattern: str | None = SPEECH_DROP_PATTERN) -> Column:
    """C1-C2 as one expression: text -> tokens before stemming.

    The characters deleted inside tokens are token characters themselves
    (never separators), so deleting them from the whole text first gives the
    same tokens with one regex pass per text instead of one per token."""
    t = _col(text)
    if drop_pattern:
        t = F.regexp_replace(t, F.lit(drop_pattern), F.lit(""))
    return keep_tokens(raw_tokens(t), stopwords)


def joined(tokens: Column) -> Column:
    """C4: stems re-joined by single spaces."""
    return F.array_join(tokens, " ")


def with_term_counts(df: DataFrame, tokens: str = "tokens", out: str = "terms", min_len: int = 2) -> DataFrame:
    """D3 without a shuffle: adds ``out`` = ``array<struct<term string, tf
    bigint>>`` of the distinct terms of each row, computed by sorting the
    row's tokens and measuring the runs of equal values.  ``min_len``
    re-applies the two-character rule of the vectoriser's token pattern
    (decision Q4).

    The sorted array and the run starts are separate projections: inside a
    lambda Spark would re-evaluate a referenced expression per element."""
    keep = [c for c in df.columns if c != tokens]
    s = df.select(*keep, F.sort_array(F.filter(tokens, lambda t: F.length(t) >= min_len)).alias("_s"))
    n = F.size("_s")
    starts = F.when(
        n > 0,
        F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (F.get("_s", i) != F.get("_s", i - 1))),
    ).otherwise(F.array().cast("array<int>"))
    s = s.select(*keep, "_s", starts.alias("_st"))
    counts = F.transform(
        "_st",
        lambda p, j: F.struct(
            F.get("_s", p).alias("term"),
            (F.coalesce(F.get("_st", j + 1), F.size("_s")) - p).cast("long").alias("tf"),
        ),
    )
    return s.select(*keep, counts.alias(out))


# ---------------------------------------------------------------- scalars (B)


def py_strip(text: str | Column) -> Column:
    """Leading and trailing whitespace removed as Python's ``str.strip``."""
    return F.regexp_replace(_col(text), F.lit(STRIP_PATTERN), F.lit(""))


def excerpt(text: str | Column, n: int = 20) -> Column:
    """Text of at most n characters unchanged, else first n, stripped, + '...'."""
    t = _col(text)
    return F.when(F.length(t) <= n, t).otherwise(F.concat(py_strip(F.substring(t, 1, n)), F.lit("...")))


def report_prefix(text: str | Column, n: int = 200) -> Column:
    """First n characters with '...' always appended."""
    return F.concat(F.substring(_col(text), 1, n), F.lit("..."))


def or_unknown(c: str | Column) -> Column:
    """Null or empty -> 'Unknown'."""
    x = _col(c)
    return F.when(x.isNull() | (x == ""), F.lit("Unknown")).otherwise(x)


def empty_to_null(c: str | Column) -> Column:
    """Empty date -> null."""
    x = _col(c)
    return F.when(x.cast("string") == "", F.lit(None)).otherwise(x)


def sitting_year(c: str | Column) -> Column:
    """Year of a date; strings are parsed strictly (ANSI raises)."""
    return F.year(F.to_date(_col(c))).cast("int")


def lenient_year(c: str | Column) -> Column:
    """Year of a leniently parsed date/time; unparsable -> null."""
    x = _col(c).cast("string")
    return F.year(F.coalesce(F.try_to_timestamp(x), F.try_to_timestamp(x, F.lit("yyyy-MM-dd")))).cast("int")


def text_pieces(text: str | Column, piece: int = 2_000_000, threshold: int = 4_000_000) -> Column:
    """A text longer than ``threshold`` characters cut into ``piece``-sized
    parts (array, in order); shorter texts give a one-element array."""
    t = _col(text)
    n = F.length(t)
    cuts = F.sequence(F.lit(0), ((n - 1) / piece).cast("int"))
    return F.when(n > threshold, F.transform(cuts, lambda i: F.substring(t, i * piece + 1, piece))).otherwise(
        F.array(t)
    )
