"""Topic models over TF-IDF rows: LSI by distributed SVD, Kullback-Leibler
NMF by multiplicative updates (inventory H1-H5).

Driver-side objects are bounded by the vocabulary, never by the corpus:
singular values (k), right factors / topic loadings (vocabulary x k).  Left
factors (one k-vector per document) stay distributed.

A pass over the rows is one ``mapInArrow``: each task adds up its share of a
vocabulary-wide matrix, the shares travel in slices of ``SLICE`` terms and are
added up by slice in an exchange, so the driver receives one matrix however
many tasks there are.  NMF has no MLlib counterpart; each iteration is one
pass: the document factor W is a column beside the sparse rows, the
topic matrix H (k x vocabulary) is broadcast, and a task returns its rows with
their new W and after them its share of the sums for H's update, which are
added up the same way.  Lineage is cut with reliable checkpoints (the folder named by
``spark.checkpoint.dir``) every ``checkpoint_every`` iterations.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.mllib.linalg import Vectors
from pyspark.mllib.linalg.distributed import IndexedRow, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rostrum.functions.blas import single_thread
from rostrum.session import ensure_checkpoint_dir

single_thread()

EPS32 = float(np.finfo(np.float32).eps)
EPS64 = float(np.finfo(np.float64).eps)

#: Terms of one travelling slice of a partial sum.
SLICE = 50
#: Entries (non-zeros) of one block of rows.
CELLS = 500_000
#: Entries of the rows of one task of an NMF iteration, about: a task sends one partial matrix.
TASK_CELLS = 8_000_000
#: Blocks of a batch from which on small ones are read together; fewer are not worth another order of sums.
TOGETHER = 8
#: Gathered rows of a factor that a task holds at once where a document or a term has no more entries.
GATHERED = 4096


def doc_rows(weights: DataFrame, vocab: DataFrame, key: str = "id", all_ids: DataFrame | None = None,
             max_features: int | None = 10_000) -> DataFrame:
    """(id, idx array<int>, val array<double>) sparse rows in term-id order.
    ``weights`` is already hash-partitioned by id (its normalisation window),
    so this aggregate adds no exchange; a row has at most vocabulary-size
    entries.  The vocabulary is broadcast where ``max_features`` bounds it.  With ``all_ids``, documents without any vocabulary term are kept
    as empty (all-zero) rows, as in the reference's matrix."""
    terms = vocab.select("term", "term_id")
    j = weights.join(terms if max_features is None else F.broadcast(terms), "term")
    g = j.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("term_id", "weight"))).alias("e"))
    rows = g.select(F.col(key).alias("id"), F.col("e.term_id").alias("idx"), F.col("e.weight").alias("val"))
    if all_ids is not None:
        empty = all_ids.select(F.col(key).alias("id")).join(rows.select("id"), "id", "left_anti").select(
            "id", F.array().cast("array<int>").alias("idx"), F.array().cast("array<double>").alias("val"))
        rows = rows.unionByName(empty)
    return rows


@dataclass
class SVDResult:
    doc_vectors: DataFrame  # (id, vector array<double>)  = U * sigma
    topics: DataFrame  # (topic, term_id, loading)
    sigma: np.ndarray
    n_terms: int
    v: np.ndarray  # k x n_terms right factors (sign-canonical), vocabulary-bounded
    rows: DataFrame | None = None  # the persisted blocks that doc_vectors reads
    residuals: np.ndarray | None = None  # |AᵀA v - sigma² v| of every component
    source: DataFrame | None = None  # the rows that the blocks were made of

    def unpersist(self) -> None:
        if self.rows is not None:
            self.rows.unpersist()


def _canonical_signs(v: np.ndarray) -> np.ndarray:
    """Flip each component so its largest-magnitude loading is positive."""
    idx = np.argmax(np.abs(v), axis=0)
    s = np.sign(v[idx, np.arange(v.shape[1])])
    s[s == 0] = 1.0
    return s


def lsi(spark: SparkSession, rows: DataFrame, n_terms: int, k: int = 100, method: str = "krylov",
        oversample: int = 20, max_passes: int = 30, seed: int = 42, partitions: int | None = None) -> SVDResult:
    """H1: truncated, uncentred SVD of the document-term matrix with k
    components (descending singular values); document vectors U*sigma.

    ``krylov`` (default): block Krylov method with a residual stop; a pass
    over the rows serves a whole block of vectors.  ``arpack``: MLlib
    ``computeSVD`` (one pass per Lanczos step: hundreds of passes)."""
    if not 0 < k <= n_terms or (method == "arpack" and k == n_terms):
        raise ValueError(f"{k} components need more terms; the vocabulary has {n_terms}")
    if method == "arpack":
        return _lsi_arpack(spark, rows, n_terms, k, partitions)
    return krylov_svd(spark, rows, n_terms, k, oversample, max_passes, seed, partitions)


def _cores(df: DataFrame) -> int:
    return max(1, df.sparkSession.sparkContext.defaultParallelism)


def _spread(rows: DataFrame, partitions: int | None) -> DataFrame:
    """Rows by id over a stated number of partitions (default: the session's,
    made up to a multiple of the cores, so that tasks of several partitions have equal shares)."""
    if not partitions:
        cores = _cores(rows)
        partitions = -(-int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) // cores) * cores
    return rows.repartition(partitions, "id")


def _lsi_arpack(spark, rows, n_terms, k, partitions):
    rdd = _spread(rows, partitions).rdd.map(
        lambda r: IndexedRow(int(r["id"]), Vectors.sparse(n_terms, list(r["idx"]), list(r["val"]))))
    mat = IndexedRowMatrix(rdd, 0, n_terms)
    svd = mat.computeSVD(k, computeU=True)
    sigma = np.asarray(svd.s.toArray())
    v = svd.V.toArray()  # n_terms x k, bounded by the vocabulary
    signs = _canonical_signs(v)
    v = v * signs
    scale = F.array(*[F.lit(float(x)) for x in sigma * signs])
    u = MLUtils.convertVectorColumnsToML(svd.U.rows.toDF(), "vector")
    docs = u.select(F.col("index").alias("id"),
                    F.zip_with(vector_to_array("vector"), scale, lambda a, b: a * b).alias("vector"))
    topics = _loadings_df(spark, v.T)
    return SVDResult(docs, topics, sigma, n_terms, v.T.copy())


# ------------------------------------------------- passes over sparse rows


def _column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def _values(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return _column(batch, name).flatten().to_numpy(zero_copy_only=False)


def _factor(batch: pa.RecordBatch, name: str = "w") -> np.ndarray:
    return _values(batch, name).reshape(batch.num_rows, -1)


def _lists(x: np.ndarray) -> pa.Array:
    """The rows of a matrix as list values."""
    offsets = np.arange(x.shape[0] + 1, dtype=np.int32) * x.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.ascontiguousarray(x).ravel()))


@dataclass
class _Chunk:
    """Rows ``first`` to ``last`` of a batch as compressed sparse rows."""

    first: int
    last: int
    ends: np.ndarray
    cols: np.ndarray
    data: np.ndarray

    def __iter__(self) -> Iterator[tuple[int, np.ndarray, np.ndarray, slice]]:
        """(row, terms, values, place in the chunk) of the rows that have terms."""
        ends = self.ends.tolist()
        for i, (s, e) in enumerate(zip(ends[:-1], ends[1:])):
            if e > s:
                yield i, self.cols[s:e], self.data[s:e], slice(s, e)

    def add_transposed(self, total: np.ndarray, values: np.ndarray, y: np.ndarray) -> None:
        """Adds to ``total`` the transposed chunk, with ``values`` in place of its
        own, times the rows ``y``, term by term."""
        if not len(self.cols):
            return
        order = _term_order(self.cols)
        cols, values = self.cols[order], values[order]
        rows = np.repeat(np.arange(len(y)), np.diff(self.ends))[order]
        starts = np.flatnonzero(np.concatenate([[True], cols[1:] != cols[:-1]]))
        terms, starts = cols[starts].tolist(), starts.tolist()
        gathered = _gatherer(y)
        for t, s, e in zip(terms, starts, [*starts[1:], len(cols)]):
            total[t] += values[s:e] @ gathered(rows[s:e])

    def times(self, m: np.ndarray) -> np.ndarray:
        """The chunk times a matrix with a row for each term."""
        y, gathered = np.zeros((self.last - self.first, m.shape[1])), _gatherer(m)
        for i, terms, d, _ in self:
            y[i] = d @ gathered(terms)
        return y


def _term_order(cols: np.ndarray) -> np.ndarray:
    """The stable order of entries by term: 16 bits at a time, which numpy sorts by radix."""
    order = np.argsort((cols & 0xFFFF).astype(np.uint16), kind="stable")
    high = cols >> 16
    return order[np.argsort(high[order].astype(np.uint16), kind="stable")] if high.any() else order


def _gatherer(x: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
    """Rows of ``x`` by number, in one piece of memory that the next call uses again."""
    x = np.ascontiguousarray(x)  # take() copies any other layout at every call
    buffer = np.empty((GATHERED, x.shape[1]))

    def rows(at: np.ndarray) -> np.ndarray:
        if len(at) > GATHERED:
            return x[at]
        return x.take(at, axis=0, out=buffer[:len(at)], mode="clip")

    return rows


def _chunks(batch: pa.RecordBatch, most: int) -> Iterator[_Chunk]:
    """The batch's rows in chunks of at most ``most`` entries (or one row)."""
    ends = np.concatenate([[0], np.cumsum(_column(batch, "idx").value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
    cols, data = _values(batch, "idx"), _values(batch, "val")
    r0, n = 0, batch.num_rows
    while r0 < n:
        r1 = max(r0 + 1, int(np.searchsorted(ends, ends[r0] + most, side="right")) - 1)
        yield _Chunk(r0, r1, ends[r0:r1 + 1] - ends[r0], cols[ends[r0]:ends[r1]], data[ends[r0]:ends[r1]])
        r0 = r1


def _blocks(rows: DataFrame, cells: int | None = None) -> DataFrame:
    """The rows (id, idx, val and, where they have it, w) as blocks of at most
    ``cells`` entries (or one row): ids, and the numbers as binary, which pass
    between Spark and Python without a conversion of every entry.  Products gather
    the factor's rows of a document's own terms."""
    most, kind, has_w = cells or CELLS, rows.schema["id"].dataType.simpleString(), "w" in rows.columns

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            for c in _chunks(b, most):
                ids = _column(b, "id").slice(c.first, c.last - c.first)
                ids = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
                # a batch with a null list has no lengths: its rows count as rows without terms
                parts = [c.ends if c.ends[-1] == len(c.cols) else np.zeros_like(c.ends), c.cols, c.data]
                if has_w:
                    parts.append(_factor(b.slice(c.first, c.last - c.first)))
                yield _block(ids, *parts)

    cols = ["id", "idx", "val", *(["w"] if has_w else [])]
    return rows.select(*cols).mapInArrow(run, _block_schema(kind, has_w))


_PARTS = {"ends": np.int64, "cols": np.int32, "data": float, "w": float}


def _block_schema(kind: str, has_w: bool) -> str:
    return f"ids array<{kind}>, " + ", ".join(f"{c} binary" for c in [*_PARTS][:3 + has_w])


def _block(ids: pa.Array, *parts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([ids, *(pa.array([np.ascontiguousarray(x, t).tobytes()], pa.binary()) for x, t in zip(parts, _PARTS.values()))],
                                      ["ids", *[*_PARTS][:len(parts)]])


def _read_blocks(batch: pa.RecordBatch, most: int | None = None) -> Iterator[tuple[pa.Array, _Chunk, np.ndarray | None]]:
    """(ids, entries, W) of the blocks of a batch; of ``TOGETHER`` blocks or more those that together have at
    most ``most`` entries are read as one.  Rows that are no blocks are passed over."""
    has_w, most = "w" in batch.schema.names, most or CELLS
    size = pc.fill_null(pc.binary_length(_column(batch, "cols")), -1).to_numpy(zero_copy_only=False).astype(np.int64) // 4
    group: list[int] = []
    if (size >= 0).sum() < TOGETHER:
        most = 0

    def part(name: str, at: list[int]) -> list[np.ndarray]:
        return [np.frombuffer(_column(batch, name)[i].as_buffer(), _PARTS[name]) for i in at]

    def read(at: list[int]):
        ends = part("ends", at)
        shifts = np.cumsum([0, *(x[-1] for x in ends)])
        ends = np.concatenate([[0], *(x[1:] + shift for x, shift in zip(ends, shifts))]).astype(np.int64)
        cols, data = np.concatenate(part("cols", at)).astype(np.intp), np.concatenate(part("data", at))
        ids = pc.list_flatten(_column(batch, "ids").slice(at[0], at[-1] - at[0] + 1))
        w = np.concatenate(part("w", at)).reshape(len(ends) - 1, -1) if has_w else None
        return pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), _Chunk(0, len(ends) - 1, ends, cols, data), w

    for i in range(batch.num_rows):
        if group and (size[i] < 0 or size[group].sum() + size[i] > most):
            yield read(group)
            group = []
        if size[i] >= 0:
            group.append(i)
    if group:
        yield read(group)


def _vectors(blocks: DataFrame, name: str = "vector") -> DataFrame:
    """(id, W) of every row of the blocks."""
    kind = blocks.schema["ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            for ids, _, w in _read_blocks(b):
                yield pa.RecordBatch.from_arrays([ids.flatten(), _lists(w)], ["id", name])

    return blocks.mapInArrow(run, f"id {kind}, {name} array<double>")


_SLICES = "at int, part binary"


def _slices(total: np.ndarray) -> list[pa.Array]:
    """A matrix as slices of ``SLICE`` rows: where each begins, and its numbers."""
    starts = range(0, len(total), SLICE)
    return [pa.array(starts, pa.int32()), pa.array([total[i:i + SLICE].tobytes() for i in starts], pa.binary())]


def _added(slices: DataFrame, n: int, width: int) -> np.ndarray:
    """The (n x width) matrix that is the sum of all tasks' slices (at, part)."""

    def add(batches: Iterator[pa.RecordBatch]):
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for i, part in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                x = np.frombuffer(part)
                sums[i] = sums[i] + x if i in sums else x
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([p.tobytes() for p in sums.values()], pa.binary())], ["at", "part"])

    total = np.zeros((n, width))
    for r in slices.repartition("at").mapInArrow(add, _SLICES).collect():
        total[r["at"]:r["at"] + SLICE] = np.frombuffer(r["part"]).reshape(-1, width)
    return total


def _summed(rows: DataFrame, share: Callable[[pa.RecordBatch, np.ndarray], None], n: int, width: int) -> np.ndarray:
    """The (n x width) matrix to which ``share`` adds each Arrow batch of the
    rows, added up over all tasks slice by slice.  A task takes several
    partitions, so that there is one partial matrix for each core, however
    many partitions the rows have."""

    def slices(batches: Iterator[pa.RecordBatch]):
        total = None
        for b in batches:
            if b.num_rows:
                total = np.zeros((n, width)) if total is None else total
                share(b, total)
        if total is not None:
            yield pa.RecordBatch.from_arrays(_slices(total), ["at", "part"])

    return _added(rows.coalesce(_cores(rows)).mapInArrow(slices, _SLICES), n, width)


def _projected(blocks: DataFrame, v) -> DataFrame:
    """(id, vector): every row times the broadcast (n_terms x k) matrix."""

    def run(batches: Iterator[pa.RecordBatch]):
        m = v.value
        for b in batches:
            for ids, c, _ in _read_blocks(b):
                yield pa.RecordBatch.from_arrays([ids.flatten(), _lists(c.times(m))], ["id", "vector"])

    kind = blocks.schema["ids"].dataType.elementType.simpleString()
    return blocks.mapInArrow(run, f"id {kind}, vector array<double>")


def _orthonormal(x: np.ndarray, against: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what the columns of x add to the span of the
    orthonormal ``against``; columns that add nothing are left out."""
    size = np.linalg.norm(x, axis=0).max(initial=0.0)
    for _ in range(2):  # once more for what rounding left
        x = x - against @ (against.T @ x)
        q, r = np.linalg.qr(x)
        x = q[:, np.abs(np.diag(r)) > 1e-12 * max(size, EPS64)]
        size = 1.0
    return x


def krylov_svd(spark: SparkSession, rows: DataFrame, n_terms: int, k: int, oversample: int = 20, max_passes: int = 30,
               seed: int = 42, partitions: int | None = None, tol: float = 1e-7, most_blocks: int = 6) -> SVDResult:
    """Truncated SVD of distributed sparse rows by a block Krylov method.

    Each pass forms W = AᵀA Z for a block Z of k + ``oversample`` orthonormal columns.  All
    blocks and their products stay as a basis Q, AᵀA Q on the driver, so Rayleigh-Ritz
    over the whole basis costs no further pass; the next block is what W
    adds to the basis.  A basis of ``most_blocks`` blocks is restarted with its
    leading Ritz vectors (thick restart).  Passes end when every residual
    |AᵀA v - s² v| is at most ``tol`` of the largest s², when the basis cannot
    grow, or after ``max_passes``; the residuals are returned.  Driver state is
    n_terms x (``most_blocks`` blocks), bounded by the vocabulary; U S = A V is row-local."""
    sc, source = spark.sparkContext, rows
    block = min(k + oversample, n_terms)
    rows = _blocks(_spread(rows, partitions)).persist(StorageLevel.MEMORY_AND_DISK)
    z, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((n_terms, block)))
    q, aq, g = np.zeros((n_terms, 0)), np.zeros((n_terms, 0)), np.zeros((0, 0))
    for _ in range(max_passes):
        zb = sc.broadcast(z)

        def gram(batch, total, zb=zb):
            m = zb.value
            for _, c, _ in _read_blocks(batch):
                c.add_transposed(total, c.data, c.times(m))

        w = _summed(rows, gram, n_terms, z.shape[1])
        zb.destroy()
        side, corner = q.T @ w, z.T @ w
        g = np.block([[g, side], [side.T, (corner + corner.T) / 2]])
        q, aq = np.hstack([q, z]), np.hstack([aq, w])
        z = _orthonormal(w, q)
        values, e = np.linalg.eigh(g)
        values, e = values[::-1], e[:, ::-1]
        v = q @ e[:, :k]
        residuals = np.linalg.norm(aq @ e[:, :k] - v * values[:k], axis=0)
        if not z.shape[1] or residuals.max() <= tol * max(values[0], EPS64):
            break
        if q.shape[1] + z.shape[1] > most_blocks * block:
            keep = min(k + block // 2, q.shape[1])
            q, aq, g = q @ e[:, :keep], aq @ e[:, :keep], np.diag(values[:keep])
    sigma = np.sqrt(np.maximum(values[:k], 0.0))
    v = v * _canonical_signs(v)
    return SVDResult(_projected(rows, sc.broadcast(v)), _loadings_df(spark, v.T), sigma, n_terms, v.T.copy(), rows, residuals, source)


def _loadings_df(spark: SparkSession, comp: np.ndarray) -> DataFrame:
    """(topic, term_id, loading) from a k x n_terms array (vocabulary-bounded);
    a topic's loadings go to Spark as one binary value."""
    rows = [(i + 1, bytearray(x.astype(float).tobytes())) for i, x in enumerate(comp)]

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            for topic, part in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                x = np.frombuffer(part)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), topic, np.int32)), pa.array(np.arange(len(x), dtype=np.int32)), pa.array(x)],
                                                 ["topic", "term_id", "loading"])

    return spark.createDataFrame(rows, "topic int, part binary").mapInArrow(run, "topic int, term_id int, loading double")


def concepts(topics: DataFrame, vocab: DataFrame, n_top: int = 10, threshold: float = 0.01,
             absolute: bool = True, descending: bool = False) -> DataFrame:
    """H2 / H5: per topic the ``n_top`` terms of largest (signed) loading and
    the number of loadings above ``threshold`` (absolute value for LSI, signed
    for NMF).  ``position`` gives the listing order: ascending for LSI (the
    strongest last), descending for NMF.  Ties by term."""
    t = topics.join(vocab.select("term", "term_id"), "term_id")
    w = Window.partitionBy("topic").orderBy(F.desc("loading"), F.asc("term"))
    ranked = t.withColumn("r", F.row_number().over(w))
    top = ranked.filter(F.col("r") <= n_top)
    pos = F.col("r") if descending else (F.lit(n_top) + 1 - F.col("r"))
    sig = F.abs("loading") if absolute else F.col("loading")
    counts = t.groupBy("topic").agg(F.count_if(sig > threshold).alias("n_significant"))
    out = top.select("topic", pos.cast("int").alias("position"), "term", "loading").join(counts, "topic")
    return out


def concept_report(concept_rows: DataFrame) -> DataFrame:
    """A10: the concept file as (topic, line_no, line) rows: ``Theme i:``, the
    top words, the count, a blank line."""
    words = concept_rows.groupBy("topic", "n_significant").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("position", "term"))), lambda s: s["term"]),
                     " ").alias("words"))
    lines = F.array(
        F.concat(F.lit("Theme "), F.col("topic").cast("string"), F.lit(":")),
        F.concat(F.lit("Top Words: "), F.col("words")),
        F.concat(F.lit("Number of significant words: "), F.col("n_significant").cast("string")),
        F.lit(""),
    )
    return words.select("topic", F.posexplode(lines).alias("line_no", "line"))


def variance(sigma: np.ndarray, total_sq: float | None = None) -> list[tuple]:
    """H3: per component (rank, sigma, ratio within the k components,
    cumulative, ratio of the whole matrix's squared Frobenius norm)."""
    sq = sigma ** 2
    within = sq / sq.sum()
    cum = np.cumsum(within)
    tot = sq / total_sq if total_sq else np.full_like(sq, np.nan)
    return [(i + 1, float(s), float(a), float(c), float(t)) for i, (s, a, c, t) in enumerate(zip(sigma, within, cum, tot))]


# ------------------------------------------------------------------ NMF


def _nndsvd_h(sig: np.ndarray, v: np.ndarray, xp: np.ndarray, xn: np.ndarray, avg: float):
    """H (k x vocabulary) of the NNDSVD start (Boutsidis & Gallopoulos 2008), zeros
    replaced by ``avg``; and for every component the scale and the side of U (+1
    positive part, -1 negative part, 0 absolute value) that make W.  ``xp`` and ``xn`` are the
    lengths of the positive and of the negative part of U's columns."""
    k, n_terms = v.shape
    h = np.zeros((k, n_terms))
    col_scale = np.zeros(k)
    col_side = np.zeros(k)
    h[0] = np.sqrt(sig[0]) * np.abs(v[0])
    col_scale[0] = np.sqrt(sig[0])
    for j in range(1, k):
        y = v[j]
        yp, yn = np.maximum(y, 0), np.abs(np.minimum(y, 0))
        ypn, ynn = np.linalg.norm(yp), np.linalg.norm(yn)
        mp, mn = xp[j] * ypn, xn[j] * ynn
        if mp > mn:
            lbd = np.sqrt(sig[j] * mp)
            h[j] = lbd * yp / ypn if ypn > 0 else 0
            col_scale[j] = lbd / xp[j] if xp[j] > 0 else 0
            col_side[j] = 1
        else:
            lbd = np.sqrt(sig[j] * mn)
            h[j] = lbd * yn / ynn if ynn > 0 else 0
            col_scale[j] = lbd / xn[j] if xn[j] > 0 else 0
            col_side[j] = -1
    h[h < EPS64] = 0
    h[h == 0] = avg
    return h, col_scale, col_side


def _nndsvda(spark: SparkSession, rows: DataFrame, n_terms: int, k: int, svd: SVDResult):
    """NNDSVD start from an SVD of other rows or without blocks, zeros replaced by the mean of
    X over all cells.  Returns (W rows DataFrame (id, w), H ndarray)."""
    sig = svd.sigma
    # U columns: doc_vectors = U * sigma
    sig_lit = F.array(*[F.lit(float(s) if s > 0 else 1.0) for s in sig])
    u = svd.doc_vectors.select("id", F.zip_with("vector", sig_lit, lambda a, b: a / b).alias("u"))
    pos_sq = F.array(*[F.sum(F.pow(F.greatest(F.col("u")[j], F.lit(0.0)), 2)) for j in range(len(sig))])
    neg_sq = F.array(*[F.sum(F.pow(F.least(F.col("u")[j], F.lit(0.0)), 2)) for j in range(len(sig))])
    stats = u.agg(pos_sq.alias("p"), neg_sq.alias("n")).first()
    n_docs = rows.count()
    avg = rows.select(F.aggregate("val", F.lit(0.0), lambda a, x: a + x).alias("s")).agg(F.sum("s")).first()[0]
    avg = float(avg or 0.0) / float(n_docs * n_terms)
    h, col_scale, col_side = _nndsvd_h(sig, svd.v, np.sqrt(np.array(stats["p"])), np.sqrt(np.array(stats["n"])), avg)

    def w_of(j):
        x = F.col("u")[j]
        if col_side[j] == 0:
            val = F.abs(x)
        elif col_side[j] > 0:
            val = F.greatest(x, F.lit(0.0))
        else:
            val = F.abs(F.least(x, F.lit(0.0)))
        w = val * F.lit(float(col_scale[j]))
        return F.when(w < EPS64, F.lit(avg)).otherwise(w)

    w0 = u.select("id", F.array(*[w_of(j) for j in range(k)]).alias("w"))
    return w0, h


def _started_blocks(blocks: DataFrame, svd: SVDResult, block_cells: int | None) -> tuple[DataFrame, np.ndarray]:
    """The start of ``_nndsvda`` where the SVD's own blocks are the rows: blocks
    with W, which is row-local (U is A V / sigma), and H.  One pass adds up what both need."""
    sc, k, n_terms = blocks.sparkSession.sparkContext, *svd.v.shape
    shared = sc.broadcast((np.ascontiguousarray(svd.v.T), np.where(svd.sigma > 0, svd.sigma, 1.0)))

    def share(b: pa.RecordBatch, total: np.ndarray) -> None:
        v, sig = shared.value
        for _, c, _ in _read_blocks(b):
            u = c.times(v) / sig
            total[0, :k] += (np.maximum(u, 0) ** 2).sum(axis=0)
            total[0, k:2 * k] += (np.minimum(u, 0) ** 2).sum(axis=0)
            total[0, 2 * k:] += c.data.sum(), len(c.ends) - 1, len(c.data)

    found = _summed(blocks, share, 1, 2 * k + 3)[0]
    xp, xn, (mass, n_docs, cells) = np.sqrt(found[:k]), np.sqrt(found[k:2 * k]), found[2 * k:]
    avg = float(mass) / float(n_docs * n_terms)
    h, col_scale, col_side = _nndsvd_h(svd.sigma, svd.v, xp, xn, avg)

    def run(batches: Iterator[pa.RecordBatch]):
        v, sig = shared.value
        for b in batches:
            for ids, c, _ in _read_blocks(b, block_cells):
                u = c.times(v) / sig
                w = np.where(col_side == 0, np.abs(u), np.where(col_side > 0, np.maximum(u, 0), np.abs(np.minimum(u, 0)))) * col_scale
                yield _block(ids, c.ends, c.cols, c.data, np.where(w < EPS64, avg, w))

    tasks = blocks.coalesce(_tasks(blocks, cells))
    return tasks.mapInArrow(run, _block_schema(blocks.schema["ids"].dataType.elementType.simpleString(), True)), h


def _tasks(blocks: DataFrame, cells: float) -> int:
    """Tasks of an iteration over blocks with so many entries: the cores, or a
    multiple of them where a task would have more than ``TASK_CELLS``."""
    cores = _cores(blocks)
    return cores * max(1, -int(-cells // (cores * TASK_CELLS)))


def _floor(x: np.ndarray) -> np.ndarray:
    return np.where(x == 0, EPS32, x)


def _by_term(h) -> np.ndarray:
    """The broadcast H (k x vocabulary) with a row for each term."""
    return np.ascontiguousarray(h.value.T)


def _w_step(c: _Chunk, w: np.ndarray, ht: np.ndarray, ratio: np.ndarray | None = None) -> np.ndarray:
    """W after one multiplicative KL update under H (rows of ``ht`` are its
    columns); ``ratio`` gets X / (W H) with the new W at the entries."""
    new, den, gathered = np.zeros_like(w), _floor(ht.sum(axis=0)), _gatherer(ht)  # a row without terms has no numerator
    for i, terms, d, at in c:
        own = gathered(terms)
        new[i] = x = w[i] * ((d / np.maximum(own @ w[i], EPS32)) @ own) / den
        if ratio is not None:
            np.divide(d, np.maximum(own @ x, EPS32), out=ratio[at])
    return new


def _w_updated(state: DataFrame, h) -> DataFrame:
    """The blocks with W after one multiplicative KL update under the
    broadcast H (row-local)."""

    def run(batches: Iterator[pa.RecordBatch]):
        ht = _by_term(h)
        for b in batches:
            for ids, c, w in _read_blocks(b):
                yield _block(ids, c.ends, c.cols, c.data, _w_step(c, w, ht))

    return state.mapInArrow(run, _block_schema(state.schema["ids"].dataType.elementType.simpleString(), True))


def _products(c: _Chunk, w: np.ndarray, ht: np.ndarray) -> np.ndarray:
    """W H at the entries of a chunk."""
    out, gathered = np.empty(len(c.data)), _gatherer(ht)
    for i, terms, _, at in c:
        out[at] = gathered(terms) @ w[i]
    return np.maximum(out, EPS32)


_STATE = ["ids", *_PARTS]


def _iterated(state: DataFrame, h, block_cells: int | None = None) -> DataFrame:
    """The blocks with W after one update under the broadcast H and, as
    further rows (at, part), every task's share of the (n_terms + 1 x k) matrix
    that has the numerator of H's update and, below it, the column sums of W."""
    k, n_terms = h.value.shape
    blocks = state.select(*_STATE)
    kind = blocks.schema["ids"].dataType

    def run(batches: Iterator[pa.RecordBatch]):
        ht, total = _by_term(h), None
        for b in batches:
            for ids, c, w in _read_blocks(b, block_cells):
                total, ratio = np.zeros((n_terms + 1, k)) if total is None else total, np.empty(len(c.data))
                new = _w_step(c, w, ht, ratio)
                c.add_transposed(total, ratio, new)
                total[n_terms] += new.sum(axis=0)
                block = _block(ids, c.ends, c.cols, c.data, new)
                yield pa.RecordBatch.from_arrays([*block.columns, pa.nulls(1, pa.int32()), pa.nulls(1, pa.binary())], [*_STATE, "at", "part"])
        if total is not None:
            at, part = _slices(total)
            yield pa.RecordBatch.from_arrays([pa.nulls(len(at), ids.type), *[pa.nulls(len(at), pa.binary())] * len(_PARTS), at, part], [*_STATE, "at", "part"])

    return blocks.mapInArrow(run, f"{_block_schema(kind.elementType.simpleString(), True)}, {_SLICES}")


def _divergence(state: DataFrame, h) -> float:
    """sqrt(2 KL(X, W H)) over the blocks."""
    k = h.value.shape[0]

    def share(b: pa.RecordBatch, total: np.ndarray) -> None:
        ht = _by_term(h)
        for _, c, w in _read_blocks(b):
            total[0, :k] += w.sum(axis=0)
            wh, some = _products(c, w, ht), c.data > 0
            x = c.data[some]
            total[0, k] += x @ np.log(x / wh[some]) - x.sum()

    found = _summed(state.select(*_STATE), share, 1, k + 1)[0]
    return float(np.sqrt(2 * max(found[k] + found[:k] @ h.value.sum(axis=1), 0.0)))


@dataclass
class NMFResult:
    doc_vectors: DataFrame  # (id, vector)
    topics: DataFrame  # (topic, term_id, loading)
    n_iter: int
    errors: list
    rows: DataFrame | None = None  # the persisted state that doc_vectors reads

    def unpersist(self) -> None:
        if self.rows is not None:
            self.rows.unpersist()


def nmf(spark: SparkSession, rows: DataFrame, n_terms: int, k: int = 100, max_iter: int = 100, tol: float = 1e-4,
        init: SVDResult | None = None, start: tuple[DataFrame, np.ndarray] | None = None,
        checkpoint_every: int = 10, partitions: int | None = None, block_cells: int | None = None) -> NMFResult:
    """H4: NMF with Kullback-Leibler loss and multiplicative updates (W then
    H each iteration), NNDSVDa start from an SVD, stop when the divergence
    drop over 10 iterations relative to the start is below ``tol``.  ``start``
    gives the factors to begin with instead: W rows (id, w) and H.

    The state is a DataFrame of blocks: ids, X's entries and W of some rows, at most
    ``block_cells`` entries each.  An iteration is one pass: it updates W and adds up
    H's numerator by slices of the vocabulary; a task holds an Arrow batch of
    blocks and one numerator.  Two iterations' states are persisted at most; every
    ``checkpoint_every`` iterations the state is written to the checkpoint folder."""
    ensure_checkpoint_dir(spark)
    sc = spark.sparkContext
    if not 0 < k < n_terms:
        raise ValueError(f"{k} components need more than {k} terms; the vocabulary has {n_terms}")
    svd = None if start else init or lsi(spark, rows, n_terms, k)
    if svd is not None and svd.rows is not None and svd.source is rows and _distinct_ids(svd.rows):
        blocks, h = _started_blocks(svd.rows, svd, block_cells)
        state = blocks.checkpoint()  # iterations do not carry the plan that made the rows
    else:
        w0, h = start or _nndsvda(spark, rows, n_terms, k, svd)
        joined = rows.join(w0, "id").select("id", "idx", "val", "w")
        state = _blocks(_spread(joined, partitions), block_cells).checkpoint()
        cells = (state.agg(F.sum(F.length("cols"))).first()[0] or 0) // 4
        state = state.coalesce(_tasks(state, cells))
    shared = sc.broadcast(h)
    first = last = _divergence(state, shared)
    errors = [first]
    it = 0
    for it in range(1, max_iter + 1):
        before, state = state, _iterated(state, shared, block_cells).persist(StorageLevel.MEMORY_AND_DISK)
        found = _added(state.select("at", "part").where("at IS NOT NULL"), n_terms + 1, k)
        numerator, mass = found[:n_terms], found[n_terms]
        if it % checkpoint_every == 0:
            updated, state = state, state.select(*_STATE).where("ends IS NOT NULL").checkpoint()
            updated.unpersist()
        before.unpersist()
        h = h * numerator.T / _floor(mass)[:, None]
        h[h < EPS64] = 0.0
        shared.unpersist()  # executors' copies only; fetched again where a lost task needs them
        shared = sc.broadcast(h)
        if tol > 0 and it % 10 == 0:
            errors.append(_divergence(state, shared))
            if (last - errors[-1]) / first < tol:
                break
            last = errors[-1]
    return NMFResult(_vectors(state.select(*_STATE)), _loadings_df(spark, h), it, errors, state)


def _distinct_ids(blocks: DataFrame) -> bool:
    """Whether every row of the blocks has an id of its own."""
    n = blocks.select(F.explode("ids").alias("id")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("id").alias("ids")).first()
    return n["n"] == n["ids"]


def nmf_w_step(spark: SparkSession, rows_w: DataFrame, h: np.ndarray) -> DataFrame:
    """One multiplicative KL update of the document factors (the W half of an
    NMF iteration) for rows (id, idx, val, w) and a fixed H: (id, w)."""
    return _vectors(_w_updated(_blocks(rows_w), spark.sparkContext.broadcast(h)), "w")
