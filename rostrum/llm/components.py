"""Connected components of a graph of links, by alternating star contraction.

Edges are contracted inside each task first (a union-find over the task's
edges keeps at most one edge a node), then large-star and small-star steps
(Kiveris et al., Connected Components in MapReduce and Beyond, 2014) hook
every node to the smallest id it can reach until nothing changes.  Every step
is a grouped minimum and a join; each round's edges are written to the shared
checkpoint folder, so a lost executor costs no more than a round."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_FLUSH = 1 << 20


class Forest:
    """Union-find over long ids that reports the edges it keeps."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        up = self.up
        r = x
        while (p := up.get(r, r)) != r:
            r = p
        while x != r:
            up[x], x = r, up.get(x, x)
        return r

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        if a < b:
            a, b = b, a
        self.up[a] = b
        return True

    def edges(self) -> list[tuple[int, int]]:
        return [(x, self.root(x)) for x in list(self.up)]


def forest_edges(batches):
    """Arrow batches of (src, dst) to the stars of the components among them.
    The forest is handed on whenever it holds ``_FLUSH`` nodes, so memory does
    not grow with a task's edges."""
    f = Forest()

    def out():
        e = np.array(f.edges(), np.int64).reshape(-1, 2)
        f.up.clear()
        return pa.RecordBatch.from_arrays([pa.array(e[:, 0]), pa.array(e[:, 1])], ["src", "dst"])

    for b in batches:
        for a, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            f.join(a, c)
        if len(f.up) > _FLUSH:
            yield out()
    yield out()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the (src, dst) long pairs; the
    component is its smallest node.  Self links and repeats do no harm."""
    now = edges.select("src", "dst").mapInArrow(forest_edges, "src long, dst long")
    now = now.where("src != dst").distinct().checkpoint()
    mark = None
    while True:
        both = now.unionAll(now.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        least = both.groupBy(F.col("src").alias("u")).agg(F.least(F.min("dst"), F.col("src")).alias("m"))
        large = both.join(least, F.col("src") == F.col("u")).where("dst > src") \
            .select(F.col("dst").alias("src"), F.col("m").alias("dst")).where("src != dst").distinct()
        low = large.groupBy(F.col("src").alias("u")).agg(F.min("dst").alias("m"))
        small = large.join(low, F.col("src") == F.col("u"))
        small = small.select(F.col("dst").alias("src"), F.col("m").alias("dst")).unionAll(low.select("u", "m"))
        now = small.where("src != dst").distinct().checkpoint()
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))).first()
        if tuple(seen) == mark:
            break
        mark = tuple(seen)
    nodes = now.select(F.col("src").alias("node"), F.col("dst").alias("component"))
    return nodes.unionAll(now.select(F.col("dst").alias("node"), F.col("dst").alias("component"))).distinct()
