"""Embedding near-duplicates by an epsilon grid order join.

Unit vectors whose cosine is at least c lie within epsilon = sqrt(2 - 2c) of
each other, and no projection increases a distance.  Vectors are projected on
the leading principal dimensions, put in grid cells of side epsilon there and
sorted by label and cell (epsilon grid order, Boehm et al. 2001).  The sequence
is cut into blocks of ``BLOCK`` vectors; blocks of one label whose boxes lie
within epsilon are joined pair by pair, each pair in a task of its own, by
recursion on halves of both intervals that skips halves whose boxes are too
far apart; what is left is compared in double precision on all dimensions.

Equal vectors of a label are one class with a count, so copies are never
expanded; the others' links are counted and reduced to a spanning forest where
they are found.  Vectors with a null id, label or vector, without components,
of length zero or with null or non-finite components link with nothing.
Vectors of different lengths are not compared.  Repeated rows are vectors of
their own.  An empty table gives no row."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostrum.llm.common import column_lists, shuffle_partitions
from rostrum.llm.components import components
from rostrum.llm.sampling import hash_share
from rostrum.llm.simhash import _stars

COSINE = 0.93
BLOCK = 512
LEAF = 64
DIMS = 6
#: Vectors that the principal dimensions are fitted on, at most about; they only decide what is skipped.
SAMPLE = 10_000
_SLACK = 1e-9


def usable(rows: DataFrame):
    v = F.col("embedding")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    zero = F.forall(v, lambda x: x == 0)
    return F.coalesce(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size(v) > 0) & finite & ~zero, F.lit(False))


def _matrix(batch: pa.RecordBatch, column: str) -> np.ndarray:
    """Vectors of one length as rows of doubles."""
    lists = batch.column(batch.schema.get_field_index(column))
    return np.asarray(lists.flatten().to_numpy(zero_copy_only=False), float).reshape(len(lists), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)  # no overflow or underflow of squares
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def principal(classes: DataFrame, sample: int = SAMPLE) -> dict[int, np.ndarray]:
    """By vector length, the leading principal directions of a bounded sample."""
    n = classes.count()
    part = classes.where(hash_share(F.col("node"), 23) < min(1 << 31, (1 << 31) * sample // max(1, n)))
    by_size: dict[int, list] = {}
    for r in part.select("embedding").collect():
        by_size.setdefault(len(r[0]), []).append(r[0])
    out = {}
    for size, vectors in by_size.items():
        x = _unit(np.array(vectors, float))
        _, directions = np.linalg.eigh((x - x.mean(0)).T @ (x - x.mean(0)))
        out[size] = np.ascontiguousarray(directions[:, ::-1][:, :DIMS])
    return out


def _project(x: np.ndarray, axes: dict[int, np.ndarray]) -> np.ndarray:
    a = axes.get(x.shape[1])
    return np.zeros((len(x), 1)) if a is None else x @ a


def _by_size(batch: pa.RecordBatch, column: str):
    sizes = np.array(batch.column(batch.schema.get_field_index(column)).value_lengths())
    for s in np.unique(sizes):
        yield np.flatnonzero(sizes == s)


def grid_order(classes: DataFrame, axes: dict[int, np.ndarray], epsilon: float) -> DataFrame:
    """Blocks of the sequence: label, size, block, low, high (box in the
    projection), first and last cell of the leading dimension, nodes, counts
    and vectors as bytes of long and double."""

    def cells(batches):
        for b in batches:
            for at in _by_size(b, "embedding"):
                part = b.take(pa.array(at))
                c = np.floor(_project(_unit(_matrix(part, "embedding")), axes) / epsilon).astype(np.int32)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(list(c), pa.list_(pa.int32()))], [*part.schema.names, "cells"])

    kind = classes.schema["label"].dataType.simpleString()
    vector = classes.schema["embedding"].dataType.simpleString()
    order = ["label", "size", "cells", "node"]
    placed = classes.select("node", "label", F.size("embedding").alias("size"), "n", "embedding").mapInArrow(
        cells, f"node long, label {kind}, size int, n long, embedding {vector}, cells array<int>").checkpoint()
    placed = placed.repartitionByRange(shuffle_partitions(classes.sparkSession), *order).sortWithinPartitions(*order)

    def blocks(batches):
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        held: list[tuple] = []

        def out():
            nonlocal number
            label, _, _, _ = held[0]
            x = _unit(np.array([h[3] for h in held], float))
            p = _project(x, axes)
            cell = np.floor(p[:, 0] / epsilon).astype(int)
            number += 1
            return pa.RecordBatch.from_pylist([{
                "label": label, "size": x.shape[1], "block": number, "low": p.min(0).tolist(), "high": p.max(0).tolist(),
                "first": int(cell.min()), "last": int(cell.max()), "nodes": np.array([h[1] for h in held], np.int64).tobytes(),
                "counts": np.array([h[2] for h in held], np.int64).tobytes(), "vectors": x.tobytes()}], schema=schema)

        schema = pa.schema([("label", label_type[0]), ("size", pa.int32()), ("block", pa.int64()), ("low", pa.list_(pa.float64())),
                            ("high", pa.list_(pa.float64())), ("first", pa.int32()), ("last", pa.int32()), ("nodes", pa.binary()),
                            ("counts", pa.binary()), ("vectors", pa.binary())])
        for _, labels, nodes, ns, vectors in column_lists(batches, "label", "node", "n", "embedding"):
            for row in zip(labels, nodes, ns, vectors):
                if held and (len(held) == BLOCK or held[0][0] != row[0] or len(held[0][3]) != len(row[3])):
                    yield out()
                    held = []
                held.append(row)
        if held:
            yield out()

    from pyspark.sql.pandas.types import to_arrow_type

    label_type = [to_arrow_type(classes.schema["label"].dataType)]
    return placed.mapInArrow(blocks, f"label {kind}, size int, block long, low array<double>, high array<double>, first int, "
                                     "last int, nodes binary, counts binary, vectors binary").checkpoint()


def join_intervals(x: np.ndarray, y: np.ndarray, px: np.ndarray, py: np.ndarray, cosine: float, epsilon: float, same: bool):
    """(i, j) of rows of x and y whose cosine reaches the bound (i < j if x is
    y), by recursion on halves of both intervals."""
    found = []

    def box(p, a, b):
        return p[a:b].min(0), p[a:b].max(0)

    def step(a, b, c, d):
        if same and a >= d:
            return
        (lo, hi), (low, high) = box(px, a, b), box(py, c, d)
        gap = np.maximum(0, np.maximum(lo - high, low - hi))
        if gap @ gap > epsilon * epsilon:
            return
        if b - a <= LEAF and d - c <= LEAF:
            i, j = np.nonzero(x[a:b] @ y[c:d].T >= cosine)
            keep = (i + a < j + c) if same else slice(None)
            found.append(np.stack([i + a, j + c], 1)[keep])
            return
        first = [(a, (a + b) // 2), ((a + b) // 2, b)] if b - a > LEAF else [(a, b)]
        second = [(c, (c + d) // 2), ((c + d) // 2, d)] if d - c > LEAF else [(c, d)]
        for f in first:
            for s in second:
                step(*f, *s)

    step(0, len(x), 0, len(y))
    pairs = np.concatenate(found) if found else np.zeros((0, 2), int)
    return pairs[:, 0], pairs[:, 1]


def links(blocks: DataFrame, axes: dict[int, np.ndarray], cosine: float, epsilon: float) -> DataFrame:
    """Rows (node, n, dst): the links of a node found with one pair of blocks
    (n), or an edge of the forest of those links (dst)."""
    box = blocks.select("label", "size", "block", "low", "high", "first", "last")
    left = box.select("label", "size", *(F.col(c).alias(f"a_{c}") for c in ("block", "low", "high", "first")),
                      F.explode(F.sequence("first", "last")).alias("cell"))
    right = box.select("label", "size", *(F.col(c).alias(f"b_{c}") for c in ("block", "low", "high", "first")),
                       F.explode(F.sequence(F.col("first") - 1, F.col("last") + 1)).alias("cell"))
    gaps = F.zip_with(F.zip_with("a_low", "b_high", lambda p, q: p - q), F.zip_with("b_low", "a_high", lambda p, q: p - q),
                      lambda p, q: F.greatest(p, q, F.lit(0.0)))
    far = F.aggregate(gaps, F.lit(0.0), lambda s, g: s + g * g)
    # two blocks may meet in several cells: the first common one counts
    pairs = left.join(right, ["label", "size", "cell"]).where(
        (F.col("a_block") <= F.col("b_block")) & (F.col("cell") == F.greatest(F.col("a_first"), F.col("b_first") - 1))
        & (far <= epsilon * epsilon)).select("a_block", "b_block")
    for s in "ab":
        pairs = pairs.join(blocks.select(F.col("block").alias(f"{s}_block"), *(F.col(c).alias(f"{s}_{c}") for c in ("nodes", "counts", "vectors"))), f"{s}_block")

    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                same = r["a_block"] == r["b_block"]
                (na, ca, x), (nb, cb, y) = ((np.frombuffer(r[f"{s}_nodes"], np.int64), np.frombuffer(r[f"{s}_counts"], np.int64),
                                             np.frombuffer(r[f"{s}_vectors"]).reshape(len(r[f"{s}_nodes"]) // 8, -1)) for s in "ab")
                i, j = join_intervals(x, y, _project(x, axes), _project(y, axes), cosine, epsilon, same)
                if not len(i):
                    continue
                nodes, at = np.unique(np.concatenate([na[i], nb[j]]), return_inverse=True)
                n = np.bincount(at, np.concatenate([cb[j], ca[i]]), len(nodes)).astype(np.int64)
                src, dst = _stars(na[i], nb[j])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([nodes, src])), pa.array(np.concatenate([n, np.zeros(len(src), np.int64)])),
                     pa.array([None] * len(nodes) + dst.tolist(), pa.int64())], ["node", "n", "dst"])

    return pairs.mapInArrow(run, "node long, n long, dst long").checkpoint()


def near_duplicates(embeddings: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    epsilon = float(np.sqrt(max(0.0, 2 - 2 * cosine))) + _SLACK
    ok = usable(embeddings)
    rows = embeddings.select("vec_id", F.when(ok, F.xxhash64("label", "embedding")).alias("node"), "label", "embedding")
    classes = rows.where("node is not null").groupBy("node").agg(
        F.first("label").alias("label"), F.first("embedding").alias("embedding"), F.min("vec_id").alias("first_id"),
        F.count("*").alias("n")).checkpoint()
    axes = principal(classes)
    found = links(grid_order(classes, axes, epsilon), axes, cosine, epsilon)
    linked = components(found.where("dst is not null").select(F.col("node").alias("src"), "dst"))
    counts = found.where("dst is null").groupBy("node").agg(F.sum("n").alias("others"))
    whole = classes.select("node", "first_id", "n").join(linked, "node", "left").join(counts, "node", "left")
    whole = whole.withColumn("component", F.coalesce("component", "node"))
    lowest = whole.groupBy("component").agg(F.min("first_id").alias("component_id"))
    whole = whole.join(lowest, "component").select(
        "node", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), "component_id")
    out = rows.select("vec_id", "node").join(whole, "node", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
