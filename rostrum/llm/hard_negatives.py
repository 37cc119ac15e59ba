"""Hard negatives by an exact maximum-inner-product search in the manner of LEMP.

Rows are sorted by length and cut to groups of about equal size; each task
holds one group as buckets of similar length.  A bucket keeps for every coordinate its
unit vectors' values in sorted order.  For an anchor and a score that it must reach,
a bucket whose longest row cannot reach it is skipped; else the angle that the
score leaves gives a feasible range of values in each of the anchor's ``FOCUS`` largest
coordinates, the rows in all ranges are the candidates (the sorted lists are
cut by binary search and the cuts intersected), and only those are verified exactly, in
whole numbers.  Where the ranges hold most of a bucket, all of it is verified as one
matrix product.  The score to reach rises as better rows are found, or starts at an
interval's lower end; nothing is estimated.

Anchors are sent once to every group (whose number grows with the rows beyond
``LEAST_GROUPS``) and pass through its task in Arrow batches; rows are never joined with rows.

Rows without a label or a vector, or with a null or non-finite component, take no part;
vectors of different lengths have no product.  A null id is no anchor (its test is null), is a row like any other,
and comes last among ties.  Repeated rows are rows of their own: each anchor row has results, and its
copies are other rows.  Scores beyond 64 bits count as the nearest 64-bit number.  Labels are compared as
they are, other columns are not read.  No anchors or no rows give no row."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rostrum.llm.common import scratch
from rostrum.llm.lexical_search import rank_within
from rostrum.llm.prefix import running

SCALE = 256
POSITIVES = 5
NEGATIVES = 3
FOCUS = 3
BUCKET = 2048
#: Components that a group holds at most about; a task keeps some 30 bytes for each.
GROUP_COMPONENTS = 4_000_000
LEAST_GROUPS = 16
_CHUNK = 256
_SLACK = 1e-5
_EXACT = 2.0 ** 53
_MOST = 2 ** 63 - 1


# ------------------------------------------------------------------ in a task


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of rows of whole numbers kept as doubles."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    if np.abs(a).max() * np.abs(b).max() * a.shape[1] < _EXACT:
        return (a @ b.T).astype(np.int64)
    whole = [[sum(int(p) * int(q) for p, q in zip(x, y)) for y in b] for x in a]
    return np.array([[max(-_MOST, min(_MOST, v)) for v in row] for row in whole], np.int64).reshape(len(a), len(b))


def _lengths(x: np.ndarray) -> np.ndarray:
    most = np.abs(x).max(1, initial=0.0)
    scaled = x / np.where(most > 0, most, 1)[:, None]
    return np.sqrt((scaled * scaled).sum(1)) * most


def _units(x: np.ndarray, length: np.ndarray) -> np.ndarray:
    return x / np.where(length > 0, length, 1)[:, None]


class Bucket:
    """Rows of similar length: number, id, label, values, sorted coordinate lists."""

    def __init__(self, pos, ids, nulls, labels, values):
        self.pos, self.ids, self.nulls, self.labels, self.values = pos, ids, nulls, labels, values
        length = _lengths(values)
        self.longest = float(length.max(initial=0.0))
        units = _units(values, length).T
        self.order = np.argsort(units, axis=1, kind="stable").astype(np.int32)
        self.lists = np.take_along_axis(units, self.order, 1).astype(np.float32)

    def candidates(self, units: np.ndarray, lengths: np.ndarray, least: np.ndarray) -> list[np.ndarray | None]:
        """For each anchor the rows that may reach its least score: None for all of them."""
        out: list[np.ndarray | None] = [None] * len(units)
        far = lengths * self.longest
        bounded = np.flatnonzero(least > 0)
        if not len(bounded) or not units.shape[1]:
            return out
        none = np.zeros(0, np.int64)
        need = np.full(len(units), 2.0)
        need[bounded] = np.divide(least[bounded], far[bounded], out=np.full(len(bounded), 2.0), where=far[bounded] > 0)
        for k in bounded[need[bounded] > 1 + _SLACK]:
            out[k] = none
        open_ = bounded[need[bounded] <= 1 + _SLACK]
        if not len(open_):
            return out
        width = min(FOCUS, units.shape[1])
        focus = np.argpartition(-np.abs(units[open_]), width - 1, axis=1)[:, :width]
        spread = np.arccos(np.clip(need[open_], -1, 1))[:, None]
        at = np.arccos(np.clip(np.take_along_axis(units[open_], focus, 1), -1, 1))
        low = np.cos(np.minimum(np.pi, at + spread)) - _SLACK
        high = np.cos(np.maximum(0, at - spread)) + _SLACK
        begin, end = np.zeros(focus.shape, np.int64), np.zeros(focus.shape, np.int64)
        for f in np.unique(focus):
            here = focus == f
            begin[here] = np.searchsorted(self.lists[f], low[here], "left")
            end[here] = np.searchsorted(self.lists[f], high[here], "right")
        for k in np.flatnonzero((end - begin).min(1) < len(self.pos) // 3):
            hits = np.zeros(len(self.pos), np.int8)
            for f, b, e in zip(focus[k], begin[k], end[k]):
                hits[self.order[f, b:e]] += 1
            out[open_[k]] = np.flatnonzero(hits == width)
        return out


class Best:
    """The first ``top`` rows of each key: scores descending, ids ascending, null ids last."""

    def __init__(self, keys: int, top: int):
        self.keys, self.top = keys, top
        self.kept = [np.zeros(0, np.int64)] * 5

    def add(self, key, score, null, ids, pos) -> None:
        columns = [np.concatenate(c) for c in zip(self.kept, (key, score, null.astype(np.int64), ids, pos))]
        key, score, null, ids, pos = columns
        order = np.lexsort((pos, ids, null, -score, key))
        keep = order[rank_within(key[order]) < self.top]
        self.kept = [c[keep] for c in columns]

    def worst(self, otherwise: np.ndarray) -> np.ndarray:
        """The last score of each full key."""
        out = otherwise.copy()
        key = self.kept[0]
        last = rank_within(key) == self.top - 1
        out[key[last]] = np.maximum(out[key[last]], self.kept[1][last])
        return out


def _scores(buckets: list[Bucket], anchors: np.ndarray, least_of, keep) -> None:
    """Verify each bucket's candidates; ``keep`` gets (anchor, bucket, row, score) arrays."""
    lengths = _lengths(anchors)
    units = _units(anchors, lengths)
    for bucket in buckets:
        least = least_of()
        found = bucket.candidates(units, lengths, least.astype(float))
        whole = np.array([k for k, c in enumerate(found) if c is None], np.int64)
        got = products(anchors[whole], bucket.values)
        a, j = np.nonzero(got >= least[whole][:, None])
        parts = [(whole[a], j, got[a, j])]
        for k, c in enumerate(found):
            if c is not None and len(c):
                s = products(anchors[k:k + 1], bucket.values[c])[0]
                good = s >= least[k]
                parts.append((np.full(int(good.sum()), k), c[good], s[good]))
        a, j, s = (np.concatenate(x) for x in zip(*parts))
        keep(a, bucket, j, s)


_NEVER = -_MOST - 1


def find_positives(buckets, pos, labels, values, _low, _high, top: int):
    best = Best(len(pos), top)

    def keep(a, bucket, j, s):
        own = (bucket.labels[j] == labels[a]) & (bucket.pos[j] != pos[a])
        a, j, s = a[own], j[own], s[own]
        best.add(a, s, bucket.nulls[j], bucket.ids[j], bucket.pos[j])

    _scores(buckets, values, lambda: best.worst(np.full(len(pos), _NEVER)), keep)
    key, score, null, ids, row = best.kept
    return key, np.zeros(len(key), np.int64), score, null, ids, row


def find_negatives(buckets, pos, labels, values, low, high, top: int):
    """Rows of other labels with a score in each anchor's intervals [low, high]
    (one for each positive; -1 where there is none)."""
    width = low.shape[1]
    best = Best(len(pos) * width, top)
    start = np.where(low < 0, _MOST, low)

    def least():
        return best.worst(start.reshape(-1)).reshape(start.shape).min(1)

    def keep(a, bucket, j, s):
        other = bucket.labels[j] != labels[a]
        a, j, s = a[other], j[other], s[other]
        for w in range(width):
            fits = (low[a, w] >= 0) & (s >= low[a, w]) & (s <= high[a, w])
            best.add(a[fits] * width + w, s[fits], bucket.nulls[j[fits]], bucket.ids[j[fits]], bucket.pos[j[fits]])

    _scores(buckets, values, least, keep)
    key, score, null, ids, row = best.kept
    return key // width, key % width, score, null, ids, row


_FOUND = "anchor long, place long, score long, id long, pos long"


def probing(find, top: int):
    """A function of Arrow batches sorted by group, rows of the group first, then its anchors."""

    def run(batches):
        group, held, buckets = None, [], None

        def build():
            by_size: dict[int, list] = {}
            for part in held:
                by_size.setdefault(part[4].shape[1], []).append(part)
            out = {}
            for size, parts in by_size.items():
                columns = [np.concatenate(c) for c in zip(*parts)]
                out[size] = [Bucket(*(c[k:k + BUCKET] for c in columns)) for k in range(0, len(columns[0]), BUCKET)]
            return out

        for b in batches:
            col = {n: b.column(k) for k, n in enumerate(b.schema.names)}
            groups, kinds, sizes = (col[n].to_numpy(zero_copy_only=False) for n in ("group", "kind", "size"))
            edges = np.flatnonzero(np.r_[True, (groups[1:] != groups[:-1]) | (kinds[1:] != kinds[:-1]) | (sizes[1:] != sizes[:-1])][:len(groups)])
            for begin, end in zip(edges, np.r_[edges[1:], len(groups)]):
                part = slice(int(begin), int(end))
                if groups[begin] != group:
                    group, held, buckets = groups[begin], [], None
                nulls = np.array(col["id"].slice(begin, end - begin).is_null())
                ids = col["id"].slice(begin, end - begin).fill_null(0).to_numpy()
                pos, labels = (col[n].to_numpy()[part] for n in ("pos", "label"))
                size = int(sizes[begin])
                values = np.stack([np.frombuffer(v, np.float32 if len(v) == 4 * size else np.float64).astype(float)
                                   for v in col["values"].slice(begin, end - begin).to_pylist()]).reshape(end - begin, size)
                if kinds[begin] == 0:
                    held.append((pos, ids, nulls, labels, values))
                    continue
                if buckets is None:
                    buckets = build()
                    held = []
                low, high = (np.array(col[n].slice(begin, end - begin).to_pylist(), np.int64).reshape(end - begin, -1) for n in ("low", "high"))
                for k in range(0, end - begin, _CHUNK):
                    c = slice(k, k + _CHUNK)
                    key, place, score, null, found, row = find(buckets.get(size, []), pos[c], labels[c], values[c], low[c], high[c], top)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(pos[c][key]), pa.array(place), pa.array(score), pa.array(found, mask=null.astype(bool)), pa.array(row)],
                        ["anchor", "place", "score", "id", "pos"])

    return run


# ---------------------------------------------------------------- Spark plans


def usable(rows: DataFrame) -> Column:
    v = F.col("embedding")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(F.col("label").isNotNull() & finite, F.lit(False))


def whole_numbers(rows: DataFrame, scale: int = SCALE) -> DataFrame:
    """id, label, anchor, size, length and values of the usable rows: floor(scale * component),
    as bytes of float where that is exact and of double where not."""

    def convert(batches):
        for b in batches:
            out = []
            for v in b.column(3).to_pylist():
                x = np.floor(np.array(v, float) * scale)
                x = np.where(np.isfinite(x), x, np.sign(x) * np.finfo(float).max) + 0.0
                out.append((len(x), float(_lengths(x[None])[0]), (x.astype(np.float32) if np.abs(x).max(initial=0) < 1 << 24 else x).tobytes()))
            size, length, values = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(size, pa.int32()), pa.array(length, pa.float64()),
                                              pa.array(values, pa.binary())], ["id", "label", "anchor", "size", "length", "values"])

    label = F.col("label").cast("long") if isinstance(rows.schema["label"].dataType, T.IntegralType) else F.xxhash64("label")
    rows = rows.where(usable(rows)).select("id", label.alias("label"), "anchor", "embedding")
    return rows.mapInArrow(convert, "id long, label long, anchor boolean, size int, length double, values binary")


def laid_out(rows: DataFrame) -> DataFrame:
    """Rows numbered in the order of (size, length) and dealt to groups of about equal
    numbers of components, written to the shared folder."""
    spark = rows.sparkSession
    rows = rows.withColumn("_work", F.col("size").cast("long") + 1).withColumn("_one", F.lit(1).cast("long"))
    path = scratch(spark, "negatives-rows")
    rows.write.parquet(path)
    rows = spark.read.parquet(path)
    total = rows.agg(F.sum("_work")).first()[0] or 0
    n = max(LEAST_GROUPS, -(-total // GROUP_COMPONENTS))
    placed = running(rows, [F.col("size"), F.col("length").desc(), F.col("id")], {"pos": "_one", "before": "_work"})
    path = scratch(spark, "negatives-laid")
    placed.select("pos", F.expr(f"before * {n} div {max(1, total)}").cast("int").alias("group"), "id", "label", "anchor", "size", "values").write.parquet(path)
    return spark.read.parquet(path)


def probe(laid: DataFrame, anchors: DataFrame, find, top: int) -> DataFrame:
    """``find`` over every group for all anchors (pos, label, size, values, low, high); the rows
    of a group stay in one task, anchors go to all groups with rows of their size."""
    spans = laid.groupBy("size").agg(F.min("group").alias("_from"), F.max("group").alias("_to"))
    n = (laid.agg(F.max("group")).first()[0] or 0) + 1
    none = F.lit(None).cast("array<long>")
    columns = ["group", "kind", "pos", "id", "label", "size", "values", "low", "high"]
    rows = laid.withColumns({"kind": F.lit(0), "low": none, "high": none}).select(*columns)
    sent = anchors.join(spans, "size").withColumns({"group": F.explode(F.sequence("_from", "_to")), "kind": F.lit(1)}).select(*columns)
    both = rows.unionAll(sent).repartition(n, "group").sortWithinPartitions("group", "kind", "size", "pos")
    return both.mapInArrow(probing(find, top), _FOUND)


def _first(rows: DataFrame, top: int, *keys: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("id").asc_nulls_last(), "pos")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def mine(rows: DataFrame, anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, scale: int = SCALE) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)
    of rows (vec_id, embedding, label); anchors are the rows for which ``anchor`` holds."""
    spark = rows.sparkSession
    rows = rows.select(F.col("vec_id").cast("long").alias("id"), "label", F.coalesce(anchor, F.lit(False)).alias("anchor"), "embedding")
    laid = laid_out(whole_numbers(rows, scale))
    anchors = laid.where("anchor")
    none = F.array().cast("array<long>")
    found = probe(laid, anchors.withColumns({"low": none, "high": none}), find_positives, positives)
    path = scratch(spark, "negatives-positives")
    _first(found, positives, "anchor").select("anchor", F.col("rank").alias("place"), F.col("id").alias("positive_id"),
                                              F.col("score").alias("positive_score")).write.parquet(path)
    chosen = spark.read.parquet(path)
    # lowest and highest score of a hard negative; -1 where the positive's score leaves none
    low = F.when(F.col("positive_score") < 0, -1).otherwise(F.expr("positive_score div 2 + positive_score % 2"))
    high = F.when(F.col("positive_score") < 0, -1).otherwise(F.expr("positive_score - positive_score div 20 - if(positive_score % 20 > 0, 1, 0)"))
    spans = chosen.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("place", low.cast("long").alias("low"), high.cast("long").alias("high")))).alias("_s"))
    pad = [F.array(*(F.coalesce(F.get("_s", F.lit(k))[c], F.lit(-1).cast("long")) for k in range(positives))) for c in ("low", "high")]
    spans = spans.select(F.col("anchor").alias("_a"), pad[0].alias("low"), pad[1].alias("high"))
    asked = anchors.join(spans, F.col("pos") == F.col("_a")).drop("_a")
    got = _first(probe(laid, asked, find_negatives, negatives), negatives, "anchor", "place")
    got = got.select("anchor", (F.col("place") + 1).cast("int").alias("place"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    names = anchors.select(F.col("pos").alias("anchor"), F.col("id").alias("anchor_id"))
    return got.join(chosen, ["anchor", "place"]).join(names, "anchor").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
