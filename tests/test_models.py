import numpy as np
from pyspark.ml.functions import array_to_vector

from rostrum.operators import cluster as cl
from rostrum.operators import topics as tp


def _rows(spark, a):
    rows = [(i, [int(j) for j in np.nonzero(a[i])[0]], [float(x) for x in a[i][np.nonzero(a[i])[0]]])
            for i in range(a.shape[0])]
    return spark.createDataFrame(rows, "id long, idx array<int>, val array<double>")


def test_krylov_svd_matches_numpy(spark):
    rng = np.random.default_rng(0)
    a = rng.random((50, 40)) * (rng.random((50, 40)) < 0.3)
    r = tp.lsi(spark, _rows(spark, a), 40, 10)
    u, s, vt = np.linalg.svd(a, full_matrices=False)
    assert np.allclose(r.sigma, s[:10], atol=1e-8)
    assert np.all(np.diff(r.sigma) <= 0)
    got = np.vstack(r.doc_vectors.orderBy("id").toPandas()["vector"].to_numpy())
    ref = (u[:, :10] * s[:10]) * tp._canonical_signs(vt[:10].T)[None, :]
    assert np.allclose(got, ref, atol=1e-6)


def test_arpack_and_full_rank(spark):
    rng = np.random.default_rng(5)
    a = rng.random((30, 12)) * (rng.random((30, 12)) < 0.5)
    a[4] = 0  # a document without terms
    s = np.linalg.svd(a, compute_uv=False)
    assert np.allclose(tp.lsi(spark, _rows(spark, a), 12, 5, method="arpack").sigma, s[:5], atol=1e-8)
    r = tp.lsi(spark, _rows(spark, a), 12, 12)
    got = np.vstack(r.doc_vectors.orderBy("id").toPandas()["vector"].to_numpy())
    assert np.allclose(got @ r.v, a, atol=1e-8)


def test_restarts_and_residuals(spark):
    """Few components of many terms: several passes, restarts of a short basis, and residuals as numpy has them."""
    rng = np.random.default_rng(8)
    a = rng.random((90, 70)) * (rng.random((90, 70)) < 0.4)
    a[:, 5] = a[:, 6]  # a rank less
    s = np.linalg.svd(a, compute_uv=False)
    for blocks, passes in ((6, 30), (2, 60)):
        r = tp.krylov_svd(spark, _rows(spark, a), 70, 6, oversample=2, max_passes=passes, most_blocks=blocks, tol=1e-10)
        assert np.allclose(r.sigma, s[:6], atol=1e-8)
        want = np.linalg.norm(a.T @ (a @ r.v.T) - r.v.T * r.sigma ** 2, axis=0)
        assert r.residuals.max() <= 1e-9 * s[0] ** 2 and np.allclose(want, r.residuals, atol=1e-8)
        assert np.allclose(r.v @ r.v.T, np.eye(6), atol=1e-9)
    short = tp.krylov_svd(spark, _rows(spark, a), 70, 6, oversample=2, max_passes=2)
    assert short.residuals.max() > 1e-9 * s[0] ** 2  # ended early, and says so
    full = tp.krylov_svd(spark, _rows(spark, a), 70, 68, oversample=0)
    assert np.allclose(full.sigma, s[:68], atol=1e-7)


def test_svd_of_many_chunks(spark, monkeypatch):
    rng = np.random.default_rng(6)
    a = rng.random((60, 120)) * (rng.random((60, 120)) < 0.2)
    monkeypatch.setattr(tp, "CELLS", 50)
    r = tp.lsi(spark, _rows(spark, a), 120, 4, oversample=40)
    assert np.allclose(r.sigma, np.linalg.svd(a, compute_uv=False)[:4], atol=1e-8)


def _kl(a, w, h):
    wh = np.maximum(w @ h, tp.EPS32)
    return np.sqrt(2 * (np.where(a > 0, a * np.log(np.where(a > 0, a, 1) / wh), 0).sum() - a.sum() + (w @ h).sum()))


def test_nmf_steps_against_numpy(spark):
    rng = np.random.default_rng(1)
    a = rng.random((30, 20)) * (rng.random((30, 20)) < 0.5)
    a[3] = 0
    w, h = 1 + rng.random((30, 4)), 1 + rng.random((4, 20))
    last = _kl(a, w, h)
    for _ in range(3):  # every iteration against numpy, and none raises the divergence
        w0 = spark.createDataFrame([(i, w[i].tolist()) for i in range(30)], "id long, w array<double>")
        res = tp.nmf(spark, _rows(spark, a), 20, k=4, max_iter=1, tol=0, start=(w0, h))
        w = w * (np.where(a > 0, a / np.maximum(w @ h, tp.EPS32), 0) @ h.T) / h.sum(1)
        h = h * (w.T @ np.where(a > 0, a / np.maximum(w @ h, tp.EPS32), 0)) / w.sum(0)[:, None]
        got = np.vstack(res.doc_vectors.orderBy("id").toPandas()["vector"].to_numpy())
        assert np.allclose(got, w, atol=1e-10)
        got = res.topics.orderBy("topic", "term_id").toPandas()["loading"].to_numpy().reshape(4, 20)
        assert np.allclose(got, h, atol=1e-10)
        now = _kl(a, w, h)
        assert now <= last + 1e-9
        last = now


def test_nmf_run(spark):
    rng = np.random.default_rng(1)
    a = rng.random((30, 20)) * (rng.random((30, 20)) < 0.5)
    res = tp.nmf(spark, _rows(spark, a), 20, k=4, max_iter=30, tol=1e-9)
    w = np.vstack(res.doc_vectors.orderBy("id").toPandas()["vector"].to_numpy())
    h = res.topics.orderBy("topic", "term_id").toPandas()["loading"].to_numpy().reshape(4, 20)
    assert (w >= 0).all() and (h >= 0).all()
    assert res.n_iter == 30 and len(res.errors) == 4 and np.all(np.diff(res.errors) <= 1e-9)
    assert abs(res.errors[-1] - _kl(a, w, h)) < 1e-6


def test_topic_cluster_report(spark):
    rng = np.random.default_rng(3)
    pts = np.vstack([rng.normal(c, 0.05, (8, 3)) for c in ([1, 0, 0], [0, 1, 0], [0, 0, 1])])
    v = spark.createDataFrame([(i, pts[i].tolist()) for i in range(24)], "id long, vector array<double>")
    details = spark.createDataFrame([(i, f"m{i}", None, "p", "r", "x" * 300) for i in range(24)],
                                    "id long, member_name string, sitting_date date, political_party string, roles string, merged_speech string")
    lines = cl.topic_cluster_report(v, 3, details).orderBy("cluster", "line_no").collect()
    x = pts / np.linalg.norm(pts, axis=1, keepdims=True)
    want = set()
    for g in range(3):
        d = np.linalg.norm(x[8 * g:8 * g + 8] - x[8 * g:8 * g + 8].mean(0), axis=1)
        want.add(tuple(8 * g + i for i in np.argsort(d)[:2]))
    got = {}
    for r in lines:
        if "Speech ID:" in r["line"]:
            got.setdefault(r["cluster"], []).append(int(r["line"].split(":")[1]))
    assert {tuple(g) for g in got.values()} == want
    assert len(lines) == 3 * 16 and "  Sitting Date: None" in {r["line"] for r in lines}


def test_assign_and_silhouette(spark):
    rng = np.random.default_rng(2)
    pts = np.vstack([rng.normal(c, 0.1, (10, 3)) for c in ([1, 0, 0], [0, 1, 0], [0, 0, 1])])
    labels = np.repeat([0, 1, 2], 10)
    df = spark.createDataFrame([(i, [float(x) for x in pts[i]], int(labels[i])) for i in range(30)],
                               "id long, vector array<double>, cluster int")
    v = cl.normalize(df)
    cen = cl.centres_of(v)
    got = {r["id"]: r["cluster"] for r in cl.assign(v, cen).collect()}
    assert all(got[i] == labels[i] for i in range(30))
    x = pts / np.linalg.norm(pts, axis=1, keepdims=True)
    d = 1 - x @ x.T
    s = []
    for i in range(30):
        same = labels == labels[i]
        a = d[i, same].sum() / (same.sum() - 1)
        b = min(d[i, labels == c].mean() for c in set(labels) if c != labels[i])
        s.append((b - a) / max(a, b))
    feats = v.select("id", array_to_vector("vector").alias("features"), "cluster")
    assert abs(cl.silhouette(feats) - np.mean(s)) < 1e-9


def test_one_partial_matrix_for_each_core(spark):
    """However many partitions the rows have, a pass sends no more partial sums than there are cores."""
    made = spark.sparkContext.accumulator(0)

    def share(batch, total):
        if not total.any():
            made.add(1)
        total += batch.num_rows

    rows = spark.range(400).selectExpr("id").repartition(40)
    assert (tp._summed(rows, share, 60, 2) == 400).all()
    assert 1 <= made.value <= spark.sparkContext.defaultParallelism


def test_products_of_sparse_rows():
    """Chunks of few entries, rows without terms and a term in many rows, against numpy."""
    import pyarrow as pa

    rng = np.random.default_rng(11)
    a = rng.random((25, 9)) * (rng.random((25, 9)) < 0.4)
    a[[0, 7, 24]] = 0
    at = [np.nonzero(r)[0] for r in a]
    batch = pa.RecordBatch.from_arrays([pa.array([x.tolist() for x in at], pa.list_(pa.int32())),
                                        pa.array([r[x].tolist() for r, x in zip(a, at)], pa.list_(pa.float64()))], ["idx", "val"])
    z, total, seen = rng.random((25, 3)), np.zeros((9, 3)), 0
    for c in tp._chunks(batch, 7):
        assert c.first == seen and (len(c.data) <= 7 or c.last == c.first + 1)
        seen = c.last
        c.add_transposed(total, c.data, z[c.first:c.last])
    assert seen == 25 and np.allclose(total, a.T @ z)


def test_nmf_does_not_make_the_rows_again(spark):
    """NMF of the rows an SVD was made of starts from the SVD's stored blocks, with the factors that the rows give."""
    rng = np.random.default_rng(12)
    a = rng.random((40, 25)) * (rng.random((40, 25)) < 0.4)
    a[[0, 9]] = 0
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    rows = _rows(spark, a)
    rows = rows.mapInArrow(counted, rows.schema)
    svd = tp.lsi(spark, rows, 25, 5)
    assert read.value == 40
    res = tp.nmf(spark, rows, 25, 5, max_iter=2, tol=0, init=svd)
    got = {r["id"]: r["vector"] for r in res.doc_vectors.collect()}
    assert read.value == 40
    want = tp.nmf(spark, rows, 25, 5, max_iter=2, tol=0, start=tp._nndsvda(spark, rows, 25, 5, svd))
    want_w = {r["id"]: r["vector"] for r in want.doc_vectors.collect()}
    assert got.keys() == want_w.keys() and all(np.allclose(got[i], want_w[i], atol=1e-10) for i in got)
    assert np.isclose(res.errors[0], want.errors[0])


def test_nmf_of_repeated_ids_and_other_rows(spark):
    """An SVD of other rows, or ids that repeat, give the join of the rows with their factors."""
    rng = np.random.default_rng(13)
    a = rng.random((12, 9)) * (rng.random((12, 9)) < 0.6)
    rows, k = _rows(spark, a), 3
    svd = tp.lsi(spark, rows, 9, k)
    some = rows.where("id < 5")
    assert tp.nmf(spark, some, 9, k, max_iter=1, init=svd).doc_vectors.count() == 5
    twice = rows.unionAll(rows.where("id = 4"))
    assert tp.nmf(spark, twice, 9, k, max_iter=1, init=tp.lsi(spark, twice, 9, k)).doc_vectors.where("id = 4").count() == 4


def test_small_blocks_are_read_together():
    """Blocks of one batch up to the stated entries are one chunk, other rows are passed over; terms above 65,535 keep their order."""
    import pyarrow as pa

    rng = np.random.default_rng(14)
    parts, a = [], rng.integers(0, 1 << 20, (8, 3)).astype(np.int32)
    for i in range(8):
        ids = pa.ListArray.from_arrays(pa.array([0, 1], pa.int32()), pa.array([i]))
        parts.append(tp._block(ids, np.array([0, 3]), a[i], np.ones(3), np.full((1, 2), i)))
    none = pa.RecordBatch.from_arrays([pa.nulls(1, c.type) for c in parts[0].columns], parts[0].schema.names)
    batch = pa.Table.from_batches([*parts[:5], none, *parts[5:]]).combine_chunks().to_batches()[0]
    got = list(tp._read_blocks(batch, 6))
    assert [ids.to_pylist() for ids, _, _ in got] == [[[0, 1]], [[2, 3]], [[4]], [[5, 6]], [[7]]]
    assert np.array_equal(np.concatenate([c.cols for _, c, _ in got]), a.ravel())
    assert [w[:, 0].tolist() for _, _, w in got] == [[0, 1], [2, 3], [4], [5, 6], [7]]
    order = tp._term_order(a.ravel())
    assert np.array_equal(order, np.argsort(a.ravel(), kind="stable"))
