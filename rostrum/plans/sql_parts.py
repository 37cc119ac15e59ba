"""DuckDB SQL fragments (common table expressions) mirroring the Spark
operators, used to compose the oracle text of each registered query."""

from __future__ import annotations

from rostrum.sources import fixtures as fx

TOKEN_RE = r"[\p{L}\p{N}_]+"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def tokens_cte(name: str, src: str, id_col: str, text_col: str, drop_null: bool = True,
               extra: str = "", drop_pattern: str | None = "[0-9_]", stop: bool = True) -> str:
    """C1-C3 over ``src``: one row per kept stem (``name``(id, pos?, term, ...))."""
    text = text_col if drop_null else f"coalesce({text_col}, '')"
    where = f"WHERE {text_col} IS NOT NULL" if drop_null else ""
    clean = f"regexp_replace(raw, '{drop_pattern}', '', 'g')" if drop_pattern else "raw"
    stop_cond = f"AND lower(t) NOT IN ({fx.sql_stopwords()})" if stop else ""
    extra_sel = (", " + extra) if extra else ""
    return f"""{name}_raw AS (
  SELECT {id_col} AS id{extra_sel}, unnest(regexp_extract_all({text}, '{TOKEN_RE}')) AS raw FROM {src} {where}),
{name}_clean AS (SELECT *, {clean} AS t FROM {name}_raw),
{name} AS (
  SELECT c.* EXCLUDE (raw, t), coalesce(sd.stem, lower(c.t)) AS term
  FROM {name}_clean c LEFT JOIN stemdict sd ON sd.token = lower(c.t)
  WHERE length(c.t) >= 2 {stop_cond} AND length(coalesce(sd.stem, lower(c.t))) > 0)"""


def tfidf_ctes(prefix: str, toks: str, key: str, n_expr: str, max_features: int = 10000) -> str:
    """D3-D7 over a stem table ``toks``(key, term): ``{prefix}_post``,
    ``{prefix}_vocab``, ``{prefix}_w``(key, term, tf, weight)."""
    return f"""{prefix}_post AS (SELECT {key}, term, count(*) AS tf FROM {toks} WHERE length(term) >= 2 GROUP BY {key}, term),
{prefix}_df AS (SELECT term, count(*) AS df, sum(tf) AS ctf FROM {prefix}_post GROUP BY term),
{prefix}_n AS (SELECT CAST(({n_expr}) AS DOUBLE) AS n),
{prefix}_vocab AS (
  SELECT term, CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS term_id, CAST(df AS BIGINT) AS df,
         CAST(ctf AS BIGINT) AS ctf, ln((1 + n) / (1 + CAST(df AS DOUBLE))) + 1 AS idf
  FROM (SELECT * FROM {prefix}_df ORDER BY ctf DESC, term ASC LIMIT {max_features}) v, {prefix}_n),
{prefix}_w0 AS (SELECT p.{key}, p.term, p.tf, p.tf * v.idf AS w FROM {prefix}_post p JOIN {prefix}_vocab v USING (term)),
{prefix}_w AS (SELECT {key}, term, tf, w / sqrt(sum(w * w) OVER (PARTITION BY {key})) AS weight FROM {prefix}_w0)"""


def speech_corpus_ctes() -> list[str]:
    """merged view + stem dictionary + tokens + speech TF-IDF (prefix ``d``)."""
    return [
        fx.sql_merged(),
        fx.sql_stems(),
        tokens_cte("dtok", "merged", "id", "merged_speech"),
        tfidf_ctes("d", "dtok", "id", "SELECT count(*) FROM merged WHERE merged_speech IS NOT NULL"),
    ]


def keyword_ctes(top_n: int = 10) -> list[str]:
    block = ", ".join(f"'{b}'" for b in sorted(fx.FIX_BLOCKLIST))
    return [
        f"""kw AS (
  SELECT id, term AS keyword, weight AS score,
         row_number() OVER (PARTITION BY id ORDER BY round(weight, 9) DESC, term ASC) AS rank
  FROM d_w WHERE weight > 0 AND term NOT IN ({block}))""",
        f"""kwmeta AS (
  SELECT k.id, k.keyword, k.score, k.rank, m.member_name, m.political_party, m.sitting_date,
         CAST(year(m.sitting_date) AS INTEGER) AS sitting_year
  FROM kw k LEFT JOIN merged m USING (id) WHERE k.rank <= {top_n} AND m.member_name IS NOT NULL)""",
    ]
