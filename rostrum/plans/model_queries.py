"""Registered queries: clustering (H6-H11), topic models (H1-H5) and their
report files (A10, A11)."""

from __future__ import annotations

from pyspark.sql import functions as F

from rostrum.functions import text as tx
from rostrum.operators import cluster as cl
from rostrum.operators import kmeans
from rostrum.operators import topics as tp
from rostrum.plans import corpora
from rostrum.plans import sql_parts as sp
from rostrum.plans.registry import query
from rostrum.sources import fixtures as fx

R = 6


def _sql(*ctes: str, body: str) -> str:
    return sp.with_(*ctes) + body


_EMB = [
    """emb AS (SELECT vec_id AS id, label, CAST(unnest(embedding) AS DOUBLE) AS x,
                      unnest(range(0, len(embedding))) AS dim FROM embeddings)""",
    "nv AS (SELECT id, label, dim, x / sqrt(sum(x * x) OVER (PARTITION BY id)) AS x FROM emb)",
    "cen AS (SELECT label, dim, avg(x) AS m FROM nv GROUP BY label, dim)",
    """own AS (SELECT v.id, v.label, sqrt(sum((v.x - c.m) * (v.x - c.m))) AS d
              FROM nv v JOIN cen c ON c.label = v.label AND c.dim = v.dim GROUP BY v.id, v.label)""",
    """rep AS (SELECT label AS cluster, CAST(rank AS INTEGER) AS rank, id, d FROM (
              SELECT *, row_number() OVER (PARTITION BY label ORDER BY round(d, 9), id) AS rank FROM own)
              WHERE rank <= 2)""",
]


def _vectors(spark, sf):
    return cl.normalize(fx.embeddings(spark, sf))


def _explode(df, col="vector", key="id"):
    return df.select(key, F.posexplode(col).alias("dim", "value"))


@query("normalize_vectors", _sql(*_EMB, body=f"SELECT id, CAST(dim AS INTEGER) AS dim, round(x, {R}) AS value FROM nv"))
def q_normalize_vectors(spark, sf):
    return _explode(_vectors(spark, sf)).withColumn("value", F.round("value", R))


@query("assign_clusters", _sql(*_EMB, body=f"""
SELECT id, label AS cluster, round(d, {R}) AS distance FROM (
  SELECT v.id, c.label, sqrt(sum((v.x - c.m) * (v.x - c.m))) AS d,
         row_number() OVER (PARTITION BY v.id ORDER BY sqrt(sum((v.x - c.m) * (v.x - c.m))), c.label) AS rn
  FROM nv v JOIN cen c ON c.dim = v.dim GROUP BY v.id, c.label)
WHERE rn = 1"""))
def q_assign_clusters(spark, sf):
    v = _vectors(spark, sf)
    out = cl.assign(v, cl.centres_of(v))
    return out.withColumn("distance", F.round("distance", R))


@query("silhouette", _sql(*_EMB, body=f"""
SELECT round(avg(CASE WHEN n = 1 THEN 0 ELSE (b - a) / greatest(a, b) END), {R}) AS silhouette FROM (
  SELECT p.i, max(CASE WHEN p.li = p.lj THEN p.md END) AS a, min(CASE WHEN p.li <> p.lj THEN p.md END) AS b,
         any_value(s.n) AS n
  FROM (SELECT i, li, lj, avg(d) AS md FROM (
          SELECT a.id AS i, b.id AS j, a.label AS li, b.label AS lj, 1 - sum(a.x * b.x) AS d
          FROM nv a JOIN nv b ON a.dim = b.dim AND a.id <> b.id GROUP BY 1, 2, 3, 4) GROUP BY 1, 2, 3) p
  JOIN (SELECT label, count(DISTINCT id) AS n FROM nv GROUP BY label) s ON s.label = p.li
  GROUP BY p.i)"""))
def q_silhouette(spark, sf):
    from pyspark.ml.functions import array_to_vector

    v = _vectors(spark, sf).select("id", array_to_vector("vector").alias("features"), "cluster")
    return spark.createDataFrame([(round(cl.silhouette(v), R),)], "silhouette double")


@query("wcss", _sql(*_EMB, body=f"""
SELECT round(sum((v.x - c.m) * (v.x - c.m)), {R}) AS wcss FROM nv v JOIN cen c ON c.label = v.label AND c.dim = v.dim"""))
def q_wcss(spark, sf):
    return cl.wcss(_vectors(spark, sf)).select(F.round("wcss", R).alias("wcss"))


@query("cluster_representatives", _sql(*_EMB, body=f"SELECT cluster, rank, id, round(d, {R}) AS distance FROM rep"))
def q_cluster_representatives(spark, sf):
    v = _vectors(spark, sf)
    r = cl.representatives(v, cl.centres_of(v))
    return r.withColumn("distance", F.round("distance", R))


_REPORT = _EMB + [fx.sql_merged(), """lines AS (
  SELECT cluster, 0 AS line_no, 'Cluster ' || cluster || ':' AS line FROM (SELECT DISTINCT cluster FROM rep)
  UNION ALL
  SELECT r.cluster, 1 + (r.rank - 1) * 7 + x.i AS line_no, x.line FROM rep r JOIN merged m USING (id),
    LATERAL (SELECT unnest(range(0, 7)) AS i,
                    unnest(['  Speech ID: ' || m.id, '  Member Name: ' || coalesce(m.member_name, 'None'),
                            '  Sitting Date: ' || coalesce(CAST(m.sitting_date AS VARCHAR), 'None'),
                            '  Political Party: ' || coalesce(m.political_party, 'None'),
                            '   Role: ' || coalesce(m.roles, 'None'),
                            '  Speech: ' || substring(m.merged_speech, 1, 200) || '...', '']) AS line) x
  UNION ALL
  SELECT cluster, 1 + max(rank) * 7, '' FROM rep GROUP BY cluster)"""]


def _report(spark, sf):
    v = _vectors(spark, sf)
    reps = cl.representatives(v, cl.centres_of(v))
    return cl.report_lines(reps, fx.merged_speeches(spark, sf))


@query("cluster_report", _sql(*_REPORT, body="SELECT cluster, CAST(line_no AS INTEGER) AS line_no, line FROM lines"))
def q_cluster_report(spark, sf):
    return _report(spark, sf)


@query("filter_report_lines", _sql(*_REPORT, body=f"""
SELECT cluster, CAST(line_no AS INTEGER) AS line_no, regexp_replace(line, '{tx.STRIP_PATTERN}', '', 'g') AS line
FROM lines WHERE NOT contains(line, 'Speech ID:')"""))
def q_filter_report_lines(spark, sf):
    from rostrum.sources import io

    return io.filter_report_lines(_report(spark, sf))


# concept extraction and its report on a data-derived matrix: embeddings rows
# as topics, dimensions as terms ('d00' ... 'd63')
_CONCEPT_SRC = """ct AS (SELECT id + 1 AS topic, dim AS term_id, printf('d%02d', dim) AS term, x AS loading FROM emb)"""


def _concept_input(spark, sf):
    e = fx.embeddings(spark, sf)
    topics = e.select((F.col("id") + 1).alias("topic"), F.posexplode("vector").alias("term_id", "loading"))
    vocab = topics.select("term_id").distinct().select("term_id", F.format_string("d%02d", "term_id").alias("term"))
    return topics, vocab


def _concept_sql(absolute: bool, descending: bool) -> str:
    sig = "abs(loading)" if absolute else "loading"
    pos = "r" if descending else "11 - r"
    return f"""cc AS (
  SELECT t.topic, CAST({pos} AS INTEGER) AS position, t.term, t.loading, n.n_significant FROM (
    SELECT topic, term, loading, row_number() OVER (PARTITION BY topic ORDER BY loading DESC, term ASC) AS r FROM ct) t
  JOIN (SELECT topic, count(*) FILTER (WHERE {sig} > 0.01) AS n_significant FROM ct GROUP BY topic) n USING (topic)
  WHERE t.r <= 10)"""


@query("concept_terms", _sql(_EMB[0], _CONCEPT_SRC, _concept_sql(True, False), body=f"""
SELECT topic, position, term, round(loading, {R}) AS loading, n_significant FROM cc"""))
def q_concept_terms(spark, sf):
    t, v = _concept_input(spark, sf)
    return tp.concepts(t, v, absolute=True, descending=False).withColumn("loading", F.round("loading", R))


@query("topic_report_lines", _sql(_EMB[0], _CONCEPT_SRC, _concept_sql(False, True), body="""
SELECT topic, CAST(x.i AS INTEGER) AS line_no, x.line FROM (
  SELECT topic, any_value(n_significant) AS n, string_agg(term, ' ' ORDER BY position) AS words FROM cc GROUP BY topic),
  LATERAL (SELECT unnest(range(0, 4)) AS i, unnest(['Theme ' || topic || ':', 'Top Words: ' || words,
           'Number of significant words: ' || n, '']) AS line) x"""))
def q_topic_report_lines(spark, sf):
    t, v = _concept_input(spark, sf)
    return tp.concept_report(tp.concepts(t, v, absolute=False, descending=True)).select(
        "topic", F.col("line_no").cast("int"), "line")


# ---- topic models.  Factors of a randomised or iterative fit, and the clusters
# of those factors, have no SQL equivalent: the queries over the whole corpus return them
# without one; the kernels are compared value by value below.

_SPEECH = sp.speech_corpus_ctes()
_LSI_K = 100
_SWEEP = range(10, 250, 10)


def _speech_rows(spark, sf):
    m = corpora.speech_model(spark, sf)
    rows = tp.doc_rows(m.weights, m.vocab, all_ids=m.docs)
    return m, rows, m.vocab.count()


def _lsi(spark, sf, k=_LSI_K):
    key = ("lsi", spark.sparkContext.applicationId, sf, k)
    if key not in corpora._MEMO:
        m, rows, nt = _speech_rows(spark, sf)
        corpora._MEMO[key] = (m, rows, nt, tp.lsi(spark, rows, nt, k))
    return corpora._MEMO[key]


def _nmf(spark, sf, k=100):
    key = ("nmf", spark.sparkContext.applicationId, sf, k)
    if key not in corpora._MEMO:
        m, rows, nt, svd = _lsi(spark, sf, k)
        corpora._MEMO[key] = (m, tp.nmf(spark, rows, nt, k, init=svd))
    return corpora._MEMO[key]


def _lsi_vectors(spark, sf):
    return _lsi(spark, sf)[3].doc_vectors


def _nmf_vectors(spark, sf):
    return _nmf(spark, sf)[1].doc_vectors


def _square(col):
    return F.aggregate(col, F.lit(0.0), lambda a, x: a + x * x)


@query("lsi_vectors")
def q_lsi_vectors(spark, sf):
    """H1: every document's components."""
    return _lsi_vectors(spark, sf).select("id", F.posexplode("vector").alias("component", "value")).withColumn("value", F.round("value", R))


@query("lsi_concepts")
def q_lsi_concepts(spark, sf):
    """H2: the ten words of every concept, from the weakest to the strongest."""
    m, _, _, svd = _lsi(spark, sf)
    c = tp.concepts(svd.topics, m.vocab, absolute=True, descending=False)
    return c.withColumn("loading", F.round("loading", R))


@query("lsi_variance")
def q_lsi_variance(spark, sf):
    """H3: singular values of the first 150 concepts with their shares of the 150
    and of the whole matrix, and how far each is from satisfying its equation."""
    _, rows, nt = _speech_rows(spark, sf)
    svd = tp.lsi(spark, rows, nt, 150)
    total = rows.select(_square("val").alias("s")).agg(F.sum("s")).first()[0]
    out = [(rank, *(round(float(x), R) for x in rest), round(float(e), R))
           for (rank, *rest), e in zip(tp.variance(svd.sigma, total), svd.residuals)]
    svd.unpersist()
    return spark.createDataFrame(out, "rank int, sigma double, ratio_within_k double, cumulative double, ratio_total double, residual double")


@query("nmf_vectors")
def q_nmf_vectors(spark, sf):
    """H4: every document's weights of the themes."""
    return _nmf_vectors(spark, sf).select("id", F.posexplode("vector").alias("theme", "weight")).withColumn("weight", F.round("weight", R))


@query("nmf_concepts")
def q_nmf_concepts(spark, sf):
    """H5: the ten words of every theme, strongest first."""
    m, res = _nmf(spark, sf)
    c = tp.concepts(res.topics, m.vocab, absolute=False, descending=True)
    return c.withColumn("loading", F.round("loading", R))


# ---- K-means


_POINTS = """p AS MATERIALIZED (
  SELECT id, CASE WHEN n > 0 THEN list_transform(e, lambda v: v / n) ELSE e END AS x,
         -ln((CAST('0x' || substr(md5('42:' || id), 1, 13) AS BIGINT) + 1) / 4503599627370496.0::DOUBLE) AS race
  FROM (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS e, sqrt(list_inner_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))) AS n
        FROM embeddings))"""


def _seeds_sql(k: int) -> str:
    """The first ``k`` seeds: the least race by squared distance, again and again."""
    return f"""s AS (
  SELECT 1 AS step, id, x, race, 1e300::DOUBLE AS near, row_number() OVER (ORDER BY race, id) = 1 AS picked FROM p
  UNION ALL
  SELECT step + 1, id, x, race, closer,
         row_number() OVER (ORDER BY CASE WHEN closer > 0 THEN race / closer ELSE 'inf'::DOUBLE END, id) = 1
  FROM (SELECT *, least(near, list_distance(x, first_value(x) OVER (ORDER BY picked DESC)) ** 2) AS closer FROM s)
  WHERE step < {k})"""


def _fit_sql(ks: str, k: int, steps: int) -> list[str]:
    """Points p, seeds s, and for every k of the list ``ks`` centres c0 .. and
    assignments a1 .. of ``steps`` Lloyd steps; the last assignment is to the last centres."""
    def nearest(i):
        return f"""a{i + 1} AS MATERIALIZED (
  SELECT k, id, x, best.cluster AS cluster, best.d AS d FROM (
    SELECT c.k, p.id, any_value(p.x) AS x, min({{'d': list_distance(p.x, c.c), 'cluster': c.cluster}}) AS best
    FROM p, c{i} c GROUP BY c.k, p.id))"""

    out = [_POINTS, _seeds_sql(k), f"""c0 AS MATERIALIZED (
  SELECT k, step - 1 AS cluster, x AS c FROM s, (SELECT unnest({ks}) AS k) WHERE picked AND step <= k)"""]
    for i in range(steps):
        out.append(nearest(i))
        out.append(f"""c{i + 1} AS MATERIALIZED (
  SELECT c.k, c.cluster, coalesce(m.c, c.c) AS c FROM c{i} c LEFT JOIN (
    SELECT k, cluster, list(m ORDER BY dim) AS c FROM (
      SELECT k, cluster, dim, avg(v) AS m FROM (
        SELECT k, cluster, unnest(x) AS v, unnest(range(len(x))) AS dim FROM a{i + 1}) GROUP BY k, cluster, dim)
    GROUP BY k, cluster) m ON m.k = c.k AND m.cluster = c.cluster)""")
    return [*out, nearest(steps)]


def _recursive(ctes: list[str], body: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(ctes) + body


_FIT_STEPS, _SWEEP_STEPS = 12, 2


@query("kmeans_embeddings", _recursive(_fit_sql("[10]", 10, _FIT_STEPS), f"""
SELECT id, CAST(cluster AS INTEGER) AS cluster, round(d, {R}) AS distance FROM a{_FIT_STEPS + 1}"""))
def q_kmeans_embeddings(spark, sf):
    """H6 + H7: a whole fit, seeds and steps."""
    found = cl.clustered(fx.embeddings(spark, sf), 10, max_iter=_FIT_STEPS, tol=0)
    return found.select("id", "cluster", F.round("distance", R).alias("distance"))


def _labels(vectors, k):
    return cl.clustered(vectors, k).select("id", "cluster", F.round("distance", R).alias("distance"))


@query("kmeans_lsi")
def q_kmeans_lsi(spark, sf):
    return _labels(_lsi_vectors(spark, sf), 50)


@query("kmeans_nmf")
def q_kmeans_nmf(spark, sf):
    return _labels(_nmf_vectors(spark, sf), 70)


def _lloyd_sql(steps: int) -> list[str]:
    """Assignments a1 .. and centres c1 .. from c0, the labels' means."""
    out = ["c0 AS (SELECT label AS cluster, dim, m FROM cen)"]
    for i in range(steps):
        out.append(f"""a{i + 1} AS (SELECT id, cluster, d FROM (
          SELECT id, cluster, d, row_number() OVER (PARTITION BY id ORDER BY d, cluster) AS rn FROM (
            SELECT v.id, c.cluster, sqrt(sum((v.x - c.m) * (v.x - c.m))) AS d
            FROM nv v JOIN c{i} c ON c.dim = v.dim GROUP BY v.id, c.cluster)) WHERE rn = 1)""")
        out.append(f"c{i + 1} AS (SELECT a.cluster, v.dim, avg(v.x) AS m FROM nv v JOIN a{i + 1} a ON a.id = v.id GROUP BY a.cluster, v.dim)")
    return out


@query("kmeans_steps", _sql(*_EMB, *_lloyd_sql(3), body=f"SELECT id, cluster, round(d, {R}) AS distance FROM a3"))
def q_kmeans_steps(spark, sf):
    """H7 step by step: three Lloyd steps from the labels' means."""
    v = _vectors(spark, sf)
    centres = cl.centres_of(v)
    for _ in range(2):
        moved = v.drop("cluster").join(cl.assign(v, centres).select("id", "cluster"), "id")
        centres = cl.centres_of(moved)
    return cl.assign(v, centres).withColumn("distance", F.round("distance", R))


def _sweep(spark, vectors, **limits):
    """Inertia and silhouette of every k."""
    rows = [(k, round(inertia, R), None if score is None else round(score, R))
            for k, inertia, score in kmeans.sweep(cl.normalize(vectors.select("id", "vector")), _SWEEP, **limits)]
    return spark.createDataFrame(rows, "k int, inertia double, silhouette double")


@query("kmeans_sweep", _recursive([
    *_fit_sql(f"range({_SWEEP.start}, {_SWEEP.stop}, {_SWEEP.step})", _SWEEP[-1], _SWEEP_STEPS),
    f"""t AS MATERIALIZED (
  SELECT k, cluster, sum(n) AS n, list(total ORDER BY dim) AS t FROM (
    SELECT k, cluster, dim, sum(v) AS total, CASE WHEN dim = 0 THEN count(*) ELSE 0 END AS n FROM (
      SELECT k, cluster, unnest(x) AS v, unnest(range(len(x))) AS dim FROM a{_SWEEP_STEPS + 1}) GROUP BY k, cluster, dim)
  GROUP BY k, cluster)""",
    f"""sil AS (
  SELECT k, id, max(n) FILTER (WHERE own) AS n, max((n - 1 - dot + self) / greatest(n - 1, 1)) FILTER (WHERE own) AS a,
         min(1 - dot / n) FILTER (WHERE NOT own) AS b
  FROM (SELECT a.k, a.id, a.cluster = t.cluster AS own, t.n, list_inner_product(a.x, t.t) AS dot, list_inner_product(a.x, a.x) AS self
        FROM a{_SWEEP_STEPS + 1} a JOIN t ON t.k = a.k) GROUP BY k, id)"""], f"""
SELECT CAST(a.k AS INTEGER) AS k, round(sum(a.d * a.d), {R}) AS inertia,
       round(avg(CASE WHEN n > 1 AND greatest(sil.a, sil.b) <> 0 THEN (sil.b - sil.a) / greatest(sil.a, sil.b) ELSE 0 END), {R}) AS silhouette
FROM a{_SWEEP_STEPS + 1} a JOIN sil ON sil.k = a.k AND sil.id = a.id GROUP BY a.k"""))
def q_kmeans_sweep(spark, sf):
    """H11 with a fixed number of steps, so that SQL can follow."""
    return _sweep(spark, fx.embeddings(spark, sf), max_iter=_SWEEP_STEPS, tol=0)


@query("kmeans_sweep_lsi")
def q_kmeans_sweep_lsi(spark, sf):
    """H11 over LSI vectors."""
    return _sweep(spark, _lsi_vectors(spark, sf))


@query("kmeans_sweep_nmf")
def q_kmeans_sweep_nmf(spark, sf):
    """H11 over NMF vectors."""
    return _sweep(spark, _nmf_vectors(spark, sf))


@query("lsi_cluster_report")
def q_lsi_cluster_report(spark, sf):
    """E8, H6, H7, H9, H10 over LSI vectors."""
    return cl.topic_cluster_report(_lsi_vectors(spark, sf), 50, fx.merged_speeches(spark, sf))


@query("nmf_cluster_report")
def q_nmf_cluster_report(spark, sf):
    """E8, H6, H7, H9, H10 over NMF vectors."""
    return cl.topic_cluster_report(_nmf_vectors(spark, sf), 70, fx.merged_speeches(spark, sf))


# ---- kernels, value by value, over embeddings


def _embedding_rows(spark, sf, absolute=False):
    e = fx.embeddings(spark, sf)
    val = F.transform("vector", lambda x: F.abs(x)) if absolute else F.col("vector")
    return e.select("id", F.sequence(F.lit(0), F.size("vector") - 1).alias("idx"), val.alias("val"))


@query("svd_product", _sql(_EMB[0], body=f"SELECT id, CAST(dim AS INTEGER) AS dim, round(x, {R}) AS value FROM emb"))
def q_svd_product(spark, sf):
    """H1: the full-rank factors multiplied again are the matrix."""
    svd = tp.lsi(spark, _embedding_rows(spark, sf), _NMF_DIM, _NMF_DIM)
    u = svd.doc_vectors.select("id", F.posexplode("vector").alias("t", "u"))
    j = u.join(svd.topics, F.col("topic") == F.col("t") + 1)
    out = j.groupBy("id", F.col("term_id").alias("dim")).agg(F.sum(F.col("u") * F.col("loading")).alias("value"))
    return out.select("id", "dim", F.round("value", R).alias("value"))


@query("svd_traces", _sql(_EMB[0], """gram AS (SELECT a.dim AS i, b.dim AS j, sum(a.x * b.x) AS g
              FROM emb a JOIN emb b ON a.id = b.id GROUP BY a.dim, b.dim)""", body="""
SELECT round(sum(CASE WHEN i = j THEN g END), 4) AS sigma2, round(sum(g * g), 2) AS sigma4 FROM gram"""))
def q_svd_traces(spark, sf):
    """H1: the sums of the squared and fourth powers of the singular values
    are the traces of the Gram matrix and of its square."""
    svd = tp.lsi(spark, _embedding_rows(spark, sf), _NMF_DIM, _NMF_DIM)
    out = [(round(float((svd.sigma ** 2).sum()), 4), round(float((svd.sigma ** 4).sum()), 2))]
    svd.unpersist()
    return spark.createDataFrame(out, "sigma2 double, sigma4 double")


_NMF_K, _NMF_DIM = 3, 64


def _nmf_h0():
    import numpy as np

    c = np.arange(_NMF_K)[:, None]
    j = np.arange(_NMF_DIM)[None, :]
    return 1 + ((c * 7 + j) % 5) / 10.0


def _nmf_w0():
    return F.array(*[(1 + (F.col("id") + c) % 3).cast("double") for c in range(_NMF_K)])


_NMF_START = [
    """emb AS (SELECT vec_id AS id, abs(CAST(unnest(embedding) AS DOUBLE)) AS x,
                      unnest(range(0, len(embedding))) AS j FROM embeddings)""",
    f"w0 AS (SELECT id, c, CAST(1 + ((id + c) % 3) AS DOUBLE) AS w FROM (SELECT DISTINCT id FROM emb), range(0, {_NMF_K}) t(c))",
    f"h0 AS (SELECT c, j, 1 + ((c * 7 + j) % 5) / 10.0 AS h FROM range(0, {_NMF_K}) a(c), range(0, {_NMF_DIM}) b(j))",
]


@query("nmf_step", _sql(
    *_NMF_START,
    """wh AS (SELECT e.id, e.j, e.x, sum(w0.w * h0.h) AS wh FROM emb e JOIN w0 ON w0.id = e.id
              JOIN h0 ON h0.c = w0.c AND h0.j = e.j GROUP BY e.id, e.j, e.x)""",
    "num AS (SELECT wh.id, h0.c, sum(wh.x / wh.wh * h0.h) AS num FROM wh JOIN h0 ON h0.j = wh.j GROUP BY wh.id, h0.c)",
    "hs AS (SELECT c, sum(h) AS hs FROM h0 GROUP BY c)",
    body=f"""
SELECT num.id, CAST(num.c AS INTEGER) AS topic, round(w0.w * num.num / hs.hs, {R}) AS w
FROM num JOIN w0 ON w0.id = num.id AND w0.c = num.c JOIN hs ON hs.c = num.c"""))
def q_nmf_step(spark, sf):
    """H4 kernel check: one KL multiplicative W update on a data-derived
    non-negative matrix (|embeddings|) with fixed starting factors."""
    rows = _embedding_rows(spark, sf, absolute=True).withColumn("w", _nmf_w0())
    out = tp.nmf_w_step(spark, rows, _nmf_h0())
    return out.select("id", F.posexplode("w").alias("topic", "w")).select(
        "id", F.col("topic").cast("int"), F.round("w", R).alias("w"))


def _nmf_iteration_sql(i: int) -> list[str]:
    """w{i+1} and h{i+1} from w{i} and h{i}."""
    def product(name, w):
        return f"""{name} AS (SELECT e.id, e.j, e.x / sum(w.w * h.h) AS r FROM emb e JOIN {w} w ON w.id = e.id
                   JOIN h{i} h ON h.c = w.c AND h.j = e.j GROUP BY e.id, e.j, e.x)"""

    n = i + 1
    return [
        product(f"p{i}", f"w{i}"),
        f"""w{n} AS (SELECT w.id, w.c, w.w * num.s / hs.s AS w FROM w{i} w
            JOIN (SELECT p.id, h.c, sum(p.r * h.h) AS s FROM p{i} p JOIN h{i} h ON h.j = p.j GROUP BY p.id, h.c) num
              ON num.id = w.id AND num.c = w.c
            JOIN (SELECT c, sum(h) AS s FROM h{i} GROUP BY c) hs ON hs.c = w.c)""",
        product(f"q{i}", f"w{n}"),
        f"""h{n} AS (SELECT h.c, h.j, h.h * num.s / ws.s AS h FROM h{i} h
            JOIN (SELECT q.j, w.c, sum(q.r * w.w) AS s FROM q{i} q JOIN w{n} w ON w.id = q.id GROUP BY q.j, w.c) num
              ON num.j = h.j AND num.c = h.c
            JOIN (SELECT c, sum(w) AS s FROM w{n} GROUP BY c) ws ON ws.c = h.c)""",
    ]


@query("nmf_iterations", _sql(*_NMF_START, *_nmf_iteration_sql(0), *_nmf_iteration_sql(1), body=f"""
SELECT 'W' AS factor, id AS row, CAST(c AS INTEGER) AS topic, round(w, {R}) AS value FROM w2
UNION ALL SELECT 'H', j, CAST(c AS INTEGER), round(h, {R}) FROM h2"""))
def q_nmf_iterations(spark, sf):
    """H4: two whole iterations, W and H, from fixed factors."""
    rows = _embedding_rows(spark, sf, absolute=True)
    res = tp.nmf(spark, rows, _NMF_DIM, _NMF_K, max_iter=2, tol=0, start=(rows.select("id", _nmf_w0().alias("w")), _nmf_h0()))
    w = res.doc_vectors.select(F.lit("W").alias("factor"), F.col("id").cast("long").alias("row"), F.posexplode("vector").alias("topic", "value"))
    h = res.topics.select(F.lit("H"), F.col("term_id").cast("long"), F.col("topic") - 1, "loading")
    return w.unionAll(h).withColumn("value", F.round("value", R))
