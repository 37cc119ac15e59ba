"""Stand-in views over the driver's test tables (see FIXTURES.md).

Each view exists twice: as a DataFrame built here and as the DuckDB SQL text
the oracle uses (``SQL_*``).  Both are written to agree row for row.  The small
inline tables (stopwords, stems, lexicon, party map) are fixed test values of
this repository; the library itself takes them as parameters.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rostrum.functions import text as tx
from rostrum.sources.layout import spread

# ----------------------------------------------------------- fixed test values
# Stopwords, stem dictionary, keyword blocklist, lexicon rows, party map and
# party selection used by every fixture query and its oracle.
FIX_STOPWORDS = [
    "the", "of", "and", "to", "in", "de", "la", "der", "die", "und",
    "le", "les", "des", "et", "el", "y", "que", "a", "an", "du",
]
FIX_STEMS = {
    "is": "be", "are": "be", "was": "be", "were": "be", "den": "der",
    "das": "der", "une": "un", "ein": "un", "this": "th", "that": "th",
    "with": "w", "from": "fr", "for": "f", "es": "est",
}
FIX_BLOCKLIST = ["be", "th", "it", "on", "as"]
FIX_PARTY_MAP = {"en": "Party A", "fr": "Party B", "de": "Party B"}
FIX_SELECTED_PARTIES = ["Party A", "Party B"]
FIX_SEARCH_QUERY = "Thnt eringing onheed treasury anntly whst ndble"
FIX_LOOKUP = {"period": "1", "session": "3", "sitting": "103", "date": "1999-05-03", "member_like": "src%"}

ORIGIN = _dt.date(1989, 1, 1)

LEXICON_SCHEMA = T.StructType(
    [
        T.StructField("pos", T.LongType(), False),
        T.StructField("term", T.StringType(), True),
        T.StructField("polarity1", T.StringType(), True),
        T.StructField("polarity2", T.StringType(), True),
        T.StructField("polarity3", T.StringType(), True),
        T.StructField("polarity4", T.StringType(), True),
    ]
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _sitting_date(key: F.Column) -> F.Column:
    return F.date_add(F.lit(ORIGIN), ((key * 37) % 13149).cast("int"))


def merged_speeches(spark: SparkSession, sf_dir: str, member: str = "source") -> DataFrame:
    """``merged_speeches`` stand-in over ``documents``.

    ``member='source_lang'`` gives the 80-member variant used for pairs."""
    d = table(spark, sf_dir, "documents")
    k = F.col("doc_id")
    name = F.col("source") if member == "source" else F.concat_ws("/", "source", "lang")
    return d.select(
        k.alias("id"),
        name.alias("member_name"),
        F.when(k % 41 == 3, F.lit(None).cast("string")).otherwise(F.upper("lang")).alias("political_party"),
        F.when(k % 7 == 0, F.lit("minister")).alias("roles"),
        _sitting_date(k).alias("sitting_date"),
        (1 + k % 17).cast("string").alias("parliamentary_period"),
        (1 + k % 5).cast("string").alias("parliamentary_session"),
        (1 + k % 200).cast("string").alias("parliamentary_sitting"),
        F.col("text").alias("merged_speech"),
    )


def sentiment_speeches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Speeches for the sentiment path: lenient date strings and some null
    texts (FIXTURES.md variants)."""
    m = merged_speeches(spark, sf_dir)
    k = F.col("id")
    return m.select(
        "id",
        "political_party",
        F.when(k % 50 == 7, F.lit("unknown")).otherwise(F.col("sitting_date").cast("string")).alias("sitting_date"),
        F.when(k % 97 == 5, F.lit(None).cast("string")).otherwise(F.col("merged_speech")).alias("merged_speech"),
    )


def dated_speeches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All speeches with their dates as strings (sentiment path)."""
    m = spread(merged_speeches(spark, sf_dir))
    return m.select("id", "political_party", F.col("sitting_date").cast("string").alias("sitting_date"), "merged_speech")


SQL_DATED_SPEECHES = """sent AS (
  SELECT id, political_party, CAST(sitting_date AS VARCHAR) AS sitting_date, merged_speech FROM merged)"""


def raw_speeches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw turn-level ``speeches`` stand-in over ``conversations``."""
    c = table(spark, sf_dir, "conversations")
    k = F.col("conv_id")
    return c.select(
        (k * 1000 + F.col("turn")).alias("id"),
        F.col("role").alias("member_name"),
        _sitting_date(k).alias("sitting_date"),
        (1 + k % 17).cast("string").alias("parliamentary_period"),
        (1 + k % 5).cast("string").alias("parliamentary_session"),
        k.cast("string").alias("parliamentary_sitting"),
        F.when(F.col("role") == "user", F.lit("PARTY A")).otherwise(F.lit("PARTY B")).alias("political_party"),
        F.col("text").alias("speech"),
    )


def search_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queries for batch search: every ``benchmark`` item."""
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))


def lexicon_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lexicon with a row for every labelled document: its first words are
    the term (alone, with endings, as a comma list, lower-cased; common words
    repeat), its labels and id give the annotators' polarities."""
    d, lab = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    k = F.col("doc_id")
    # only the first two words of a text are looked for, before it meets the labels
    first = F.nullif(F.regexp_extract("text", r"(\p{L}++)", 1), F.lit(""))
    second = F.nullif(F.regexp_extract("text", r"^\P{L}*+\p{L}++\P{L}++(\p{L}++)", 1), F.lit(""))
    words = d.select("doc_id", first.alias("w1"), second.alias("w2")).where("w1 is not null")
    rows = words.join(lab, "doc_id").select("doc_id", "quality", "toxic", "w1", F.coalesce("w2", "w1").alias("w2"))
    ending = F.concat(F.lit(" -"), F.substring("w2", 1, 2), F.lit(" -ly"))
    term = F.when(k % 4 == 0, F.col("w1")).when(k % 4 == 1, F.concat("w1", ending)) \
        .when(k % 4 == 2, F.concat("w1", F.lit(","), "w2")).otherwise(F.lower("w2"))
    verdict = F.when(F.col("toxic") == 1, "NEG").when(F.col("quality") == 1, "POS").otherwise("N/A")
    return rows.select(
        (k + 1).alias("pos"), term.alias("term"), verdict.alias("polarity1"),
        F.when(k % 3 == 0, "NEG").otherwise(verdict).alias("polarity2"),
        F.when(k % 5 == 0, "BOTH").otherwise("POS").alias("polarity3"),
        F.when(k % 7 == 0, "").when(k % 2 == 0, "NEG").otherwise("POS").alias("polarity4"))



def stem_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stem dictionary (token, stem) with an entry for every distinct token
    of ``documents``: the fixed stems, else the token without its last two
    characters when it is longer than six."""
    d = spread(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    tokens = d.select(F.explode(F.array_distinct(tx.kept_tokens("text"))).alias("t")).select(F.lower("t").alias("token")).distinct()
    fixed = F.create_map(*[F.lit(x) for kv in sorted(FIX_STEMS.items()) for x in kv])
    cut = F.when(F.length("token") > 6, F.expr("substring(token, 1, length(token) - 2)")).otherwise(F.col("token"))
    return tokens.select("token", F.coalesce(F.try_element_at(fixed, F.col("token")), cut).alias("stem"))


def party_map(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(sorted(FIX_PARTY_MAP.items()), "raw string, canonical string")


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense vectors (id, vector array<double>) and given labels."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(
        F.col("vec_id").alias("id"),
        F.transform("embedding", lambda x: x.cast("double")).alias("vector"),
        F.col("label").alias("cluster"),
    )


# --------------------------------------------------------------- DuckDB side


def _sql_list(values) -> str:
    return ", ".join("'" + str(v).replace("'", "''") + "'" for v in values)


SQL_MERGED = """merged AS (
  SELECT doc_id AS id, {member} AS member_name,
         CASE WHEN doc_id % 41 = 3 THEN NULL ELSE upper(lang) END AS political_party,
         CASE WHEN doc_id % 7 = 0 THEN 'minister' END AS roles,
         DATE '1989-01-01' + CAST((doc_id * 37) % 13149 AS INTEGER) AS sitting_date,
         CAST(1 + doc_id % 17 AS VARCHAR) AS parliamentary_period,
         CAST(1 + doc_id % 5 AS VARCHAR) AS parliamentary_session,
         CAST(1 + doc_id % 200 AS VARCHAR) AS parliamentary_sitting,
         text AS merged_speech
  FROM documents)"""


def sql_merged(member: str = "source") -> str:
    return SQL_MERGED.format(member="source" if member == "source" else "source || '/' || lang")


SQL_SENTIMENT_SPEECHES = """sent AS (
  SELECT id, political_party,
         CASE WHEN id % 50 = 7 THEN 'unknown' ELSE CAST(sitting_date AS VARCHAR) END AS sitting_date,
         CASE WHEN id % 97 = 5 THEN NULL ELSE merged_speech END AS merged_speech
  FROM merged)"""

SQL_RAW_SPEECHES = """raw AS (
  SELECT conv_id * 1000 + turn AS id, role AS member_name,
         DATE '1989-01-01' + CAST((conv_id * 37) % 13149 AS INTEGER) AS sitting_date,
         CAST(1 + conv_id % 17 AS VARCHAR) AS parliamentary_period,
         CAST(1 + conv_id % 5 AS VARCHAR) AS parliamentary_session,
         CAST(conv_id AS VARCHAR) AS parliamentary_sitting,
         CASE WHEN role = 'user' THEN 'PARTY A' ELSE 'PARTY B' END AS political_party,
         text AS speech
  FROM conversations)"""


def sql_stems() -> str:
    fixed = " ".join(f"WHEN {_sql_list([k])} THEN {_sql_list([v])}" for k, v in sorted(FIX_STEMS.items()))
    return f"""stemdict AS (
  SELECT token, CASE token {fixed}
         ELSE CASE WHEN length(token) > 6 THEN substring(token, 1, length(token) - 2) ELSE token END END AS stem
  FROM (SELECT DISTINCT lower(t) AS token FROM (
    SELECT regexp_replace(unnest(regexp_extract_all(text, '[\\p{{L}}\\p{{N}}_]+')), '[0-9_]', '', 'g') AS t
    FROM documents) WHERE length(t) >= 2))"""


def sql_stopwords() -> str:
    return _sql_list(sorted(FIX_STOPWORDS))


def sql_lexicon() -> str:
    return """lexwords AS (
  SELECT d.doc_id, quality, toxic, regexp_extract_all(text, '\\p{L}+') AS w
  FROM documents d JOIN labels l ON l.doc_id = d.doc_id),
lexpairs AS (SELECT *, w[1] AS w1, coalesce(w[2], w[1]) AS w2,
  CASE WHEN toxic = 1 THEN 'NEG' WHEN quality = 1 THEN 'POS' ELSE 'N/A' END AS verdict FROM lexwords),
lexrows AS (
  SELECT doc_id + 1 AS pos,
         CASE doc_id % 4 WHEN 0 THEN w1 WHEN 1 THEN w1 || ' -' || substr(w2, 1, 2) || ' -ly'
              WHEN 2 THEN w1 || ',' || w2 ELSE lower(w2) END AS term,
         verdict AS polarity1, CASE WHEN doc_id % 3 = 0 THEN 'NEG' ELSE verdict END AS polarity2,
         CASE WHEN doc_id % 5 = 0 THEN 'BOTH' ELSE 'POS' END AS polarity3,
         CASE WHEN doc_id % 7 = 0 THEN '' WHEN doc_id % 2 = 0 THEN 'NEG' ELSE 'POS' END AS polarity4
  FROM lexpairs WHERE w1 IS NOT NULL)"""



def sql_party_map() -> str:
    rows = ", ".join(f"({_sql_list([k])}, {_sql_list([v])})" for k, v in sorted(FIX_PARTY_MAP.items()))
    return f"partymap(raw, canonical) AS (VALUES {rows})"
