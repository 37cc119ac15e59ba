"""SimHash near-duplicates: fingerprints within a Hamming distance, linked by
the generalised pigeonhole principle.

The 64 bits are dealt to partitions so that correlated bits stand together.
Every distinct fingerprint then gets its own thresholds t_1 .. t_m (-1: leave
the partition out) with sum max_distance - m + 1: whatever lies within
max_distance of it lies within t_i of it in some partition i.  The thresholds
are chosen by dynamic programming over the partitions, for the least sum of
probes and estimated candidates; the estimate of a partition's candidates is
the number of fingerprints times the chance, from the corpus's bit
frequencies, of at most t differing bits there.  Fingerprints are indexed by
their bits in each partition, probes are all values within t_i, and a probe
that meets an index row is verified on all 64 bits.

Probes and index rows meet in one sorted exchange.  A value shared by more
than ``BLOCK`` index rows is cut into blocks, and each pair of an index and a
probe block is a row of its own, so no task holds an unbounded group.  Links
found together are reduced to a spanning forest at once; only components are
asked for.

Null and empty texts have fingerprint zero and link like any other.  Equal
fingerprints are one class (its smallest id counts; rows without id are
members like others, a class without any id has a null id).  An empty table
gives no row."""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostrum.llm.common import column_lists, shuffle_partitions
from rostrum.llm.components import components

BITS = 64
SHINGLE = 3
SEED = 42
MAX_DISTANCE = 3
PARTITIONS = 2
#: Index rows of one value that one task compares; more are cut into blocks.
BLOCK = 8192
_PAIRS = 1 << 21
_ROWS = 1 << 15


# --------------------------------------------------------------- fingerprints


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Majority bits of the shingles' XXH64, as an unsigned integer."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist())],
                 np.uint64)
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(h), 1 << 16):
        part = h[i : i + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view(np.uint64)[0])


def fingerprints(documents: DataFrame, shingle: int = SHINGLE, keys: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, fp) and the long columns ``keys``: the fingerprint as a signed long."""

    def run(batches):
        for b, texts in column_lists(batches, "text"):
            fp = np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp), *b.columns[2:]], ["doc_id", "fp", *keys])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text", *keys).mapInArrow(run, ", ".join([f"doc_id {kind}, fp long", *(f"{k} long" for k in keys)]))


# ------------------------------------------------------- partitions, thresholds


def _bits(fp: np.ndarray) -> np.ndarray:
    return np.unpackbits(fp.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def bit_counts(prints: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and the (64, 64) counts of bits set together."""

    def run(batches):
        n, both = 0, np.zeros((BITS, BITS))
        for b in batches:
            x = _bits(b.column(0).to_numpy(zero_copy_only=False)).astype(np.float32)
            n += len(x)
            both += x.T @ x
        i, j = np.divmod(np.arange(BITS * BITS), BITS)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(i, -1)), pa.array(np.append(j, -1)), pa.array(np.append(both.ravel(), n).astype(np.int64))],
            ["i", "j", "n"])

    rows = prints.select("fp").mapInArrow(run, "i long, j long, n long").groupBy("i", "j").agg(F.sum("n").alias("n")).collect()
    found = {(r["i"], r["j"]): r["n"] for r in rows}
    return found.get((-1, -1), 0), np.array([[found.get((i, j), 0) for j in range(BITS)] for i in range(BITS)], float)


def partition_bits(n: int, both: np.ndarray, partitions: int = PARTITIONS) -> list[list[int]]:
    """Bits dealt to equal partitions; each grows around the most correlated
    pair left by the bit that correlates most with it."""
    p = np.diag(both) / max(1, n)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    corr = np.abs((both / max(1, n) - np.outer(p, p)) / np.outer(spread, spread))
    np.fill_diagonal(corr, 0)
    free, out = list(range(BITS)), []
    for size in (len(x) for x in np.array_split(np.arange(BITS), partitions)):
        part: list[int] = []
        while len(part) < size:
            if part:
                gain = corr[np.ix_(free, part)].sum(1)
            else:
                gain = corr[np.ix_(free, free)].max(1)
            part.append(free.pop(int(gain.argmax())))
        out.append(sorted(part))
    return out


def _masks(bits: list[int], most: int) -> list[np.ndarray]:
    """For t = 0 .. most, every mask with at most t of the bits."""
    out = []
    for t in range(most + 1):
        sets = [sum(1 << b for b in c) for c in itertools.combinations(bits, t)]
        out.append(np.concatenate([*out[-1:], np.array(sets, np.uint64)]))
    return out


def thresholds(fp: np.ndarray, n: int, ones: np.ndarray, parts: list[list[int]], most: int) -> np.ndarray:
    """(fingerprints, partitions) thresholds of least estimated cost."""
    m, total = len(parts), most - len(parts) + 1
    bits = _bits(fp)
    differs = np.where(bits == 1, 1 - ones, ones)
    best = {0: (np.zeros(len(fp)), np.zeros((len(fp), 0), np.int64))}  # sum so far, kept by t + 1
    for bits_of in parts:
        chance = np.zeros((len(fp), most + 1))
        chance[:, 0] = 1
        for b in bits_of:
            q = differs[:, b : b + 1]
            chance[:, 1:] = chance[:, 1:] * (1 - q) + chance[:, :-1] * q
            chance[:, :1] *= 1 - q
        near = n * np.cumsum(chance, 1)
        probes = np.cumsum([math.comb(len(bits_of), t) for t in range(most + 1)])
        step: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for s, (cost, chosen) in best.items():
            for t in range(-1, most + 1):
                if s + t + 1 > total + m:
                    break
                c = cost + (near[:, t] + probes[t] if t >= 0 else 0)
                took = np.hstack([chosen, np.full((len(fp), 1), t)])
                if s + t + 1 in step:
                    old, old_took = step[s + t + 1]
                    better = c < old
                    c, took = np.where(better, c, old), np.where(better[:, None], took, old_took)
                step[s + t + 1] = (c, took)
        best = step
    return best[total + m][1]


# ---------------------------------------------------------------------- linking


def _stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The components of the pairs as (node, smallest node) without the roots."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    rest = label != np.arange(len(nodes))
    return nodes[rest], nodes[label[rest]]


def near_pairs(probes: np.ndarray, first: np.ndarray, count: np.ndarray, index: np.ndarray, most: int):
    """Forests of the links between each probe and index[first : first + count],
    from blocks of at most about ``_PAIRS`` comparisons."""
    ends = np.cumsum(count)
    cuts = np.unique(np.searchsorted(ends, np.arange(_PAIRS, int(ends[-1]) + _PAIRS, _PAIRS), side="left") + 1) if len(ends) else []
    start = 0
    for stop in cuts:
        c, f = count[start:stop], first[start:stop]
        n = int(c.sum())
        if n:
            a = np.repeat(probes[start:stop], c)
            b = index[np.arange(n) - np.repeat(np.cumsum(c) - c, c) + np.repeat(f, c)]
            near = (np.bitwise_count(a ^ b) <= most) & (a != b)
            if near.any():
                yield _stars(a[near], b[near])
        start = stop


_OUT = "src long, dst long, value long, side byte, block binary"


def _batch(src=(), dst=(), value=(), side=(), block=()):
    n = max(len(src), len(value))
    fill = [None] * n
    return pa.RecordBatch.from_arrays(
        [pa.array(src if len(src) else fill, pa.int64()), pa.array(dst if len(dst) else fill, pa.int64()),
         pa.array(value if len(value) else fill, pa.int64()), pa.array(side if len(side) else fill, pa.int8()),
         pa.array(block if len(block) else fill, pa.binary())], ["src", "dst", "value", "side", "block"])


def meet(batches, most: int, block: int):
    """Rows (value, side, fp) sorted by value and side, index rows (side 0)
    before probes (side 1), to links and, for values with more than ``block``
    index rows, to blocks of index rows and of probes."""
    index = np.zeros(0, np.int64)  # of the value that the last rows had, while it is not crowded
    last, crowded = None, False
    pending, held = [], 0

    def blocks(value, side, fps):
        for i in range(0, len(fps), block):
            yield _batch(value=[value], side=[side], block=[fps[i : i + block].tobytes()])

    def work(rows):
        nonlocal index, last, crowded
        value, side, fp = (np.concatenate([r[i] for r in rows]) for i in range(3))
        starts = np.flatnonzero(np.r_[True, value[1:] != value[:-1]])
        stops = np.r_[starts[1:], len(value)]
        n_index = np.add.reduceat((side == 0).astype(np.int64), starts)
        probes, first, count, pool, size = [], [], [], [], 0
        tail = n_index.copy()
        if last is not None and value[0] == last:
            tail[0] += len(index)
        # most runs are a fingerprint alone, or with its own probe; the first and last may go on beyond these rows
        alone = (n_index == 1) & (stops - starts == 2) & (fp[starts] == fp[stops - 1])
        wanted = ((tail > 0) & (stops - starts > n_index) & ~alone) | (n_index > block)
        wanted[0] = wanted[-1] = True
        busy = np.flatnonzero(wanted)
        for r in busy:
            a, b, v = int(starts[r]), int(stops[r]), int(value[starts[r]])
            mine = fp[a : a + n_index[r]]
            goes_on = last is not None and v == last
            was_crowded = goes_on and crowded
            if goes_on and not was_crowded:
                mine = np.concatenate([index, mine])
            crowded = was_crowded or len(mine) > block
            if crowded:
                yield from blocks(v, 0, mine)
                yield from blocks(v, 1, fp[a + n_index[r] : b])
                mine = mine[:0]
            elif len(mine) and b - a > n_index[r]:
                p = fp[a + n_index[r] : b]
                probes.append(p)
                first.append(np.full(len(p), size))
                count.append(np.full(len(p), len(mine)))
                pool.append(mine)
                size += len(mine)
            index, last = mine, v
        if probes:
            for s, d in near_pairs(*map(np.concatenate, (probes, first, count, pool)), most):
                yield _batch(src=s, dst=d)

    for b in batches:
        pending.append(tuple(b.column(i).to_numpy(zero_copy_only=False) for i in range(3)))
        held += b.num_rows
        if held >= _ROWS:
            yield from work(pending)
            pending, held = [], 0
    if held:
        yield from work(pending)


def _block_links(batches, most: int):
    for b in batches:
        for left, right in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            probes, index = np.frombuffer(left, np.int64), np.frombuffer(right, np.int64)
            for s, d in near_pairs(probes, np.zeros(len(probes), np.int64), np.full(len(probes), len(index)), index, most):
                yield pa.RecordBatch.from_arrays([pa.array(s), pa.array(d)], ["src", "dst"])


def links(prints: DataFrame, most: int = MAX_DISTANCE, partitions: int = PARTITIONS, block: int = BLOCK) -> DataFrame:
    """(src, dst) of distinct fingerprints: a spanning forest of all pairs that
    differ in at most ``most`` bits, given distinct fps."""
    n, both = bit_counts(prints)
    parts = partition_bits(n, both, partitions)
    ones = np.diag(both) / max(1, n)
    masks = [_masks(p, most) for p in parts]
    whole = [m[1][1:].sum(dtype=np.uint64) if most else np.uint64(sum(1 << b for b in p)) for m, p in zip(masks, parts)]

    def spread(batches):
        for b in batches:
            fp = b.column(0).to_numpy(zero_copy_only=False)
            u = fp.view(np.uint64)
            t = thresholds(fp, n, ones, parts, most)
            for i, all_bits in enumerate(whole):
                own = u & all_bits
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own.view(np.int64)), pa.array(np.zeros(len(u), np.int8)), pa.array(fp)], ["value", "side", "fp"])
                for k in np.unique(t[:, i]):
                    if k < 0:
                        continue
                    at = np.flatnonzero(t[:, i] == k)
                    rows = max(1, (1 << 18) // len(masks[i][k]))
                    for s in range(0, len(at), rows):
                        sel = at[s : s + rows]
                        v = (own[sel][:, None] ^ masks[i][k][None, :]).ravel()
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(v.view(np.int64)), pa.array(np.ones(len(v), np.int8)),
                             pa.array(np.repeat(fp[sel], len(masks[i][k])))], ["value", "side", "fp"])

    rows = prints.select("fp").mapInArrow(spread, "value long, side byte, fp long")
    rows = rows.repartition(shuffle_partitions(prints.sparkSession), "value").sortWithinPartitions("value", "side")
    found = rows.mapInArrow(lambda b: meet(b, most, block), _OUT).checkpoint()
    crowded = found.where("value is not null")
    left = crowded.where("side = 1").select("value", F.col("block").alias("probes"))
    right = crowded.where("side = 0").select("value", F.col("block").alias("index"))
    more = left.join(right, "value").select("probes", "index").mapInArrow(lambda b: _block_links(b, most), "src long, dst long")
    return found.where("src is not null").select("src", "dst").unionAll(more)


def near_duplicates(documents: DataFrame, shingle: int = SHINGLE, most: int = MAX_DISTANCE) -> DataFrame:
    """(doc_id, fp, component_id) of every document."""
    prints = fingerprints(documents, shingle).checkpoint()
    classes = prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")).checkpoint()
    linked = components(links(classes, most)).withColumnRenamed("node", "fp")
    joined = linked.join(classes, "fp")
    lowest = joined.groupBy("component").agg(F.min("first_id").alias("component_id"))
    of_class = joined.join(lowest, "component").select("fp", "component_id")
    of_class = classes.join(of_class, "fp", "left").select(
        "fp", F.coalesce("component_id", "first_id").alias("component_id"))
    return prints.join(of_class, "fp").select("doc_id", "fp", "component_id")


def hex_digits(fp):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_first(documents: DataFrame, shingle: int = SHINGLE, most: int = MAX_DISTANCE) -> DataFrame:
    """One document of each group, also of a group without ids, with its own
    columns: the one with the smallest id (rows without id last), then the
    smallest fingerprint, then the smallest hashes.  A row is known by two
    hashes, of its text and of all it holds, never by its id alone; rows that
    agree in both have one text, so they are of one group."""
    hashed = [c for c in documents.columns if "map<" not in documents.schema[c].dataType.simpleString()]
    keys = F.xxhash64("text").alias("text_key"), F.xxhash64(F.col("doc_id").isNull(), *hashed).alias("row_key")
    prints = fingerprints(documents.select("doc_id", "text", *keys), shingle, ("text_key", "row_key"))
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "fp", "text_key", "row_key")
    classes = prints.groupBy("fp").agg(F.min(first).alias("first")).checkpoint()
    linked = components(links(classes, most)).withColumnRenamed("node", "fp")
    keep = classes.join(linked, "fp", "left").groupBy(F.coalesce("component", "fp")).agg(F.min("first").alias("first"))
    # the document's columns travel as one, whatever their names
    rows = documents.select(F.struct(*documents.columns).alias("doc"), *keys)
    rows = rows.join(keep.select("first.text_key", "first.row_key"), ["text_key", "row_key"]).dropDuplicates(["text_key", "row_key"])
    return rows.select(*(F.col("doc")[c].alias(c) for c in documents.columns))
