"""Registered queries of this package: one for each operator, over its whole
table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from rostrum.llm import (adaptive_rules, embed_dedup, hard_negatives, language_id, lexical_search, licenses, minhash, mixing, packing,
                         quality, simhash, toxicity, warc)
from rostrum.llm.common import scratch, table, tokenizer_path

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


@query("op1_minhash")
def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = minhash.fingerprint_documents(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_chars", "edited_sha256", minhash.digits(F.col("fp")).alias("fingerprint"),
                      minhash.digits(F.col("edited_fp")).alias("edited_fingerprint"), "near_edited", "near_next")


@query("op2_toxicity")
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


_OP3 = rf"""
WITH sized AS (
  SELECT doc_id, source, md5('{mixing.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS key,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
per AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CAST([5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS DOUBLE) AS w
  FROM sized GROUP BY source),
ratios AS (SELECT *, source_size * 2.0::DOUBLE AS cap, source_size * 2.0::DOUBLE / w AS ratio FROM per),
levels AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(cap) OVER before, 0))
            / (sum(w) OVER () - coalesce(sum(w) OVER before, 0)) AS level
  FROM ratios
  WINDOW before AS (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size, least(cap, coalesce(w * (SELECT min(level) FROM (
    SELECT level FROM levels WHERE ratio >= level ORDER BY ratio, source NULLS LAST LIMIT 1)), cap)) AS target
  FROM levels),
placed AS (
  SELECT s.*, t.source_size, t.target, CAST(floor(t.target) AS BIGINT) AS budget,
         CAST(coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY key, s.doc_id, s.size
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, CAST(
  CASE WHEN source_size > 0 THEN (budget // source_size) * size
       + least(greatest(budget - (budget // source_size) * source_size - before, 0), size) ELSE 0 END AS BIGINT) AS taken
FROM placed"""


@query("op3_mixing", _OP3)
def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.taken(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", "taken")


@query("op4_quality")
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op9_language_id")
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + (d{g} // {1 << s}) % 32 AS INTEGER), 1)" for g in range(8) for s in (15, 10, 5, 0))
_GROUPS = ", ".join(
    "(" + " + ".join(f"(strpos('0123456789abcdef', substr(h, {5 * g + k + 1}, 1)) - 1) * {16 ** (4 - k)}" for k in range(5)) + f") AS d{g}"
    for g in range(8))
_OP5 = f"""
WITH hashed AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS h FROM pages),
grouped AS (SELECT page_id, n, h, max(page_id) OVER (PARTITION BY h) AS top, {_GROUPS} FROM hashed)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to
FROM grouped"""


@query("op5_warc", _OP5)
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = warc.archive_pages(table(spark, sf_dir, "pages"), scratch(spark, "warc"))
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op6_embed_dedup")
def op6_embed_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


@query("op7_packing")
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


@query("op8_simhash")
def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", simhash.hex_digits("fp").alias("fingerprint"), "component_id")


def document_path():
    """Documents as files of a tree: source, language, a directory for 1000 ids
    and one for 50 in it.  The first id of each 50 names a licence file, in
    turn of the directory itself, the one above, or the language's."""
    shard = F.floor(F.col("doc_id") / 50)
    first, turn = F.col("doc_id") % 50 == 0, shard % 3
    upper = F.when(~first | (turn < 2), F.concat(F.lit("d"), F.floor(shard / 20)))
    lower = F.when(~first | (turn == 0), shard.cast("string"))
    name = F.when(first, "LICENSE").otherwise(F.concat("doc_id", F.lit(".txt")))
    path = F.concat_ws("/", F.coalesce("source", F.lit("-")), F.coalesce("lang", F.lit("-")), upper, lower, name)
    return F.when(F.col("doc_id").isNotNull(), path)


@query("op10_licenses")
def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = licenses.named_files(table(spark, sf_dir, "documents"), document_path())
    out = licenses.scan(files)
    return out.withColumn("licences", F.array_join("licences", ","))


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_OP11 = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({_LOWER}, '{lexical_search.TERM}') AS t FROM documents),
s AS (SELECT count(*) AS docs, CAST(sum(len(t)) AS BIGINT) AS total FROM d WHERE len(t) > 0),
i AS (SELECT DISTINCT item_id, unnest(regexp_extract_all({_LOWER}, '{lexical_search.TERM}')) AS term FROM benchmark),
each AS (SELECT rid, doc_id, CAST(len(t) AS BIGINT) AS n, unnest(t) AS term FROM d),
tf AS (SELECT rid, any_value(doc_id) AS doc_id, any_value(n) AS n, term, count(*) AS tf FROM each
       WHERE term IN (SELECT term FROM i) GROUP BY rid, term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, s GROUP BY term),
v AS (SELECT rid, doc_id, tf.term, w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * docs) // total)))) AS v
      FROM tf JOIN w ON tf.term = w.term, s),
scored AS (SELECT item_id, rid, any_value(doc_id) AS doc_id, CAST(sum(v) AS BIGINT) AS score
           FROM i JOIN v ON i.term = v.term GROUP BY item_id, rid HAVING sum(v) > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored)
WHERE rank <= {lexical_search.TOP}"""


@query("op11_search", _OP11)
def op11_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_OP12 = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x
           FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
             CAST(list_inner_product(a.x, b.x) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id % 50 = 0 AND len(a.x) = len(b.x) AND (a.vec_id <> b.vec_id OR a.label <> b.label)),
p AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER pair AS INTEGER) AS rank, other_id AS negative_id,
       positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW pair AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)
QUALIFY row_number() OVER pair <= 3"""


@query("op12_hard_negatives", _OP12)
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))
    return hard_negatives.mine(rows.withColumn("label", moved), F.col("vec_id") % 50 == 0)


_RULES = adaptive_rules
_LIMITS = ", ".join(
    f"CASE WHEN docs >= {_RULES.LEAST} THEN {k}_{s} WHEN lang_docs >= {_RULES.LEAST} THEN lang_{k}_{s} ELSE all_{k}_{s} END AS {k}_{s}"
    for k in _RULES.RATES for s in ("low", "high"))


def _bounds_sql(mark: str, keys: str, group: str) -> str:
    """Bounds of the groups ``keys`` from the table of sketches, one row each."""
    picks = ", ".join(f"max(CASE WHEN rate = '{k}' THEN {s} END) AS {mark}{k}_{s}" for k in _RULES.RATES for s in ("low", "high"))
    least = " ".join(f"WHEN '{k}' THEN {r[3]}" for k, r in _RULES.RATES.items())
    two = ", ".join(f"'{k}'" for k, r in _RULES.RATES.items() if r[4])
    quarters = ", ".join(f"min(CASE WHEN upto * 4 >= docs * {k} THEN bucket END) AS q{k}" for k in (1, 2, 3))
    return f"""(SELECT {keys}any_value(docs) AS {mark}docs, {picks} FROM (
      SELECT {keys}rate, docs, CASE WHEN rate IN ({two}) THEN q2 - {_RULES.REACH} * greatest(q3 - q2, least) END AS low,
             q2 + {_RULES.REACH} * greatest(q2 - q1, least) AS high
      FROM (SELECT {keys}rate, any_value(docs) AS docs, CASE rate {least} END AS least, {quarters}
            FROM (SELECT {keys}rate, bucket, sum(n) OVER (PARTITION BY {keys}rate ORDER BY bucket) AS upto,
                         sum(n) OVER (PARTITION BY {keys}rate) AS docs
                  FROM (SELECT {keys}rate, bucket, sum(n) AS n FROM sketch GROUP BY {keys}rate, bucket))
            GROUP BY {keys}rate)) {group})"""


_OP13 = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS t FROM documents),
split AS (SELECT *, regexp_extract_all(t, '[^ 	-]+') AS w,
                 list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ 	-]')) AS lines FROM d),
pos AS (SELECT rid, unnest(w) AS a, generate_subscripts(w, 1) AS p FROM split),
win AS (SELECT rid, p, a, lead(a) OVER next AS b, lead(a, 2) OVER next AS c FROM pos WINDOW next AS (PARTITION BY rid ORDER BY p)),
twice AS (SELECT rid, p, count(*) OVER (PARTITION BY rid, a, b, c) AS n FROM win WHERE c IS NOT NULL),
covered AS (SELECT rid, count(DISTINCT q) AS n FROM (SELECT rid, unnest([p, p + 1, p + 2]) AS q FROM twice WHERE n >= 2) GROUP BY rid),
measured AS (
  SELECT split.rid, doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words, len(lines) AS n_lines
  FROM split LEFT JOIN covered ON split.rid = covered.rid),
rated AS (SELECT *, {", ".join(f"{t} * {a} // nullif({b}, 0) AS {k}" for k, (t, a, b, _, _) in _RULES.RATES.items())} FROM measured),
long AS ({" UNION ALL ".join(f"SELECT lang, source, '{k}' AS rate, CAST({k} AS BIGINT) AS v FROM rated WHERE n_words > 0" for k in _RULES.RATES)}),
cut AS (SELECT lang, source, rate, v, greatest(length(bin(v)) - {_RULES.BITS}, 0) AS s FROM long),
sketch AS (SELECT lang, source, rate, (v >> s) << s AS bucket, count(*) AS n FROM cut GROUP BY ALL),
own AS {_bounds_sql("", "lang, source, ", "GROUP BY lang, source")},
of_lang AS {_bounds_sql("lang_", "lang, ", "GROUP BY lang")},
of_all AS {_bounds_sql("all_", "", "")},
limits AS (SELECT own.lang, own.source, {_LIMITS} FROM own JOIN of_lang ON own.lang IS NOT DISTINCT FROM of_lang.lang, of_all)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {" AND ".join(f"coalesce({k} <= {k}_high, true) AND coalesce({k} >= {k}_low, true)" for k in _RULES.RATES)} AS kept
FROM (SELECT *, n_words < {_RULES.LEAST_WORDS} OR 100 * n_repeat_words > {_RULES.MOST_REPEATED} * n_words AS base_failed FROM rated) r
LEFT JOIN limits ON r.lang IS NOT DISTINCT FROM limits.lang AND r.source IS NOT DISTINCT FROM limits.source"""


@query("op13_quality_rules", _OP13)
def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = adaptive_rules.judge(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
