"""Ranked lexical search by scanning documents with one Aho-Corasick automaton.

The terms of all items, each guarded by a boundary on both sides, form one
automaton that every task holds; it counts the terms of a document straight
from its text, so no index of documents exists.  A first scan adds up the
number of documents, their terms and each item term's document frequency; a
second one scores: the automaton's outputs are mapped to the items that hold
the term, and each task keeps the best ``TOP`` documents of every item.  Those
are ranked in two steps (items and hash of the document, then items).

The automaton is broadcast: items are dealt to blocks of at most ``BLOCK_TERMS``
different terms (an item with more is a block of its own), and each block is a
pair of scans.

Terms are runs of ASCII letters and digits and of all characters beyond ASCII; only
A-Z are lower-cased.  A null or empty text has no term and is never found.
Rows of items that share an id are one item; a null id is an id.  Rows that repeat
a document are documents of their own; equal scores rank by ascending id, null ids last.
Very long texts are scanned whole, in chunks that end at a boundary.  Other
columns are not read.  No documents or no items give no row."""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rostrum.llm.prefix import running

TOP = 50
BLOCK_TERMS = 200_000
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bytes of UTF-8: separators become a blank, A-Z a-z; all bytes of characters beyond ASCII stay.
_GUARD = 32
_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else _GUARD for b in range(256))
_CHUNK = 1 << 20
_SLICE = 4_000_000


class Scanner:
    """Counts of a set of terms in texts."""

    def __init__(self, terms: list[str]):
        import ahocorasick

        self.size = len(terms)
        self.machine = ahocorasick.Automaton()
        for k, t in enumerate(terms):
            self.machine.add_word(f" {t.encode().decode('latin-1')} ", k)
        self.machine.make_automaton()

    def counts(self, text: bytes | None) -> tuple[int, np.ndarray, np.ndarray]:
        """(number of terms of any kind, numbers of the terms found, their counts)."""
        guarded = b" " + (text or b"").translate(_BYTES) + b" "
        total, found, start = 0, [], 0
        while start < len(guarded) - 1:
            end = len(guarded) - 1
            if end - start > _CHUNK:  # the last boundary of the chunk, or the first one after it
                cut = guarded.rfind(b" ", start + 1, start + _CHUNK)
                end = cut if cut > 0 else guarded.find(b" ", start + _CHUNK)
            part = guarded[start:end + 1]
            inside = np.frombuffer(part, np.uint8) != _GUARD
            total += int(np.count_nonzero(inside[1:] & ~inside[:-1]))
            found.append(np.array([k for _, k in self.machine.iter(part.decode("latin-1"))], np.int64))
            if len(found) > 64:
                found = [np.concatenate(found)]
            start = end
        terms, counts = np.unique(np.concatenate(found) if found else np.zeros(0, np.int64), return_counts=True)
        return total, terms, counts.astype(np.int64)


_HELD: dict[str, Scanner] = {}


def _scanner(key: str, terms: list[str]) -> Scanner:
    """One scanner for each block and worker process."""
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = Scanner(terms)
    return _HELD[key]


def item_terms(items: DataFrame) -> DataFrame:
    """The different (item_id, term)."""
    text = F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), _UPPER, _LOWER)
    return items.select("item_id", F.explode(F.regexp_extract_all(text, F.lit(TERM), F.lit(0))).alias("term")).distinct()


def blocks(terms: DataFrame, most: int = BLOCK_TERMS) -> Iterator[DataFrame]:
    """Items dealt to blocks of at most ``most`` of their terms, or one item."""
    n = terms.count()
    if n == 0:
        return
    if n <= most:
        yield terms
        return
    sized = terms.groupBy("item_id").agg(F.count("*").alias("size"))
    sized = running(sized, [F.col("item_id")], {"before": "size"})
    dealt = sized.select(F.col("item_id").alias("_item"), F.when(F.col("size") > most, F.concat(F.lit("i"), F.col("before")))
                         .otherwise(F.floor((F.col("before") + F.col("size")) / most).cast("string")).alias("_block")).checkpoint()
    laid = terms.join(dealt, F.col("item_id").eqNullSafe(F.col("_item"))).checkpoint()
    for r in dealt.select("_block").distinct().orderBy("_block").collect():
        yield laid.where(F.col("_block") == r[0]).select("item_id", "term")


class Ranking:
    """The best documents of each item among those seen so far."""

    def __init__(self, items: int, top: int):
        self.top = top
        self.least = np.ones(items, np.int64)
        self.kept = [np.zeros(0, np.int64)] * 4
        self.more: list[tuple] = []
        self.waiting = 0

    def add(self, item: np.ndarray, score: np.ndarray, doc: np.ndarray, null: np.ndarray) -> None:
        self.more.append((item, score, doc, null))
        self.waiting += len(item)
        if self.waiting > 2 * self.top * len(self.least) + 100_000:
            self.cut()

    def cut(self) -> None:
        columns = [np.concatenate(c) for c in zip(self.kept, *self.more)]
        item, score, doc, null = columns
        order = np.lexsort((doc, null, -score, item))
        rank = rank_within(item[order])
        last = order[rank == self.top - 1]
        self.least[item[last]] = score[last]
        self.kept = [c[order[rank < self.top]] for c in columns]
        self.more, self.waiting = [], 0


def rank_within(groups: np.ndarray) -> np.ndarray:
    """Position of each entry in its run of equal values."""
    first = np.flatnonzero(np.r_[True, groups[1:] != groups[:-1]][:len(groups)])
    return np.arange(len(groups)) - np.repeat(first, np.diff(np.r_[first, len(groups)]))


def _texts(batches) -> Iterator[tuple[pa.Array, list]]:
    for b in batches:
        yield b.column(0), b.column(1).cast(pa.binary()).to_pylist()


def statistics(documents: DataFrame, key: str, terms) -> tuple[int, int, np.ndarray]:
    """(N, L, document frequency of every term): one scan, summed by key; no
    more rows than terms come back."""

    def scan(batches):
        scanner = _scanner(key, terms.value)
        docs, total, df = 0, 0, np.zeros(scanner.size, np.int64)
        for _, texts in _texts(batches):
            for t in texts:
                n, found, _ = scanner.counts(t)
                docs, total = docs + (n > 0), total + n
                df[found] += 1
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[-1, -2, some]), pa.array(np.r_[docs, total, df[some]].astype(np.int64))], ["term", "n"])

    rows = documents.select("doc_id", "text").mapInArrow(scan, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    df, sums = np.zeros(len(terms.value), np.int64), {-1: 0, -2: 0}
    for r in rows:
        if r["term"] < 0:
            sums[r["term"]] = r["n"]
        else:
            df[r["term"]] = r["n"]
    return sums[-1], sums[-2], df


def _sums(at: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Whole-number sums of values by position (exact: two halves as doubles)."""
    low = np.bincount(at, (values & 0xFFFFFF).astype(float), size).astype(np.int64)
    return low + (np.bincount(at, (values >> 24).astype(float), size).astype(np.int64) << 24)


def best(documents: DataFrame, key: str, terms, links, stats: tuple[int, int, np.ndarray], top: int) -> DataFrame:
    """(item number, doc_id, score): the best documents of each item in each
    task; ``links`` has the item numbers of every term, end to end, and where each term's begin."""
    n_docs, n_terms, df = stats
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], np.int64)
    sent = documents.sparkSession.sparkContext.broadcast((weight, *links.value))

    def scan(batches):
        scanner = _scanner(key, terms.value)
        weight, items, start, n_items = sent.value
        degree = np.diff(start)
        ranking = Ranking(n_items, top)

        def score(part):
            doc = np.repeat(np.arange(len(part)), [len(p[2]) for p in part])
            term, tf = np.concatenate([p[2] for p in part]), np.concatenate([p[3] for p in part])
            m = np.array([50 + (50 * p[1] * n_docs) // n_terms for p in part], np.int64)[doc]
            value = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))
            wide = degree[term]
            inside = np.arange(int(wide.sum())) - np.repeat(np.cumsum(wide) - wide, wide)
            item = items[np.repeat(start[term], wide) + inside]
            got = _sums(np.repeat(doc, wide) * n_items + item, np.repeat(value, wide), len(part) * n_items).reshape(len(part), n_items)
            at, found = np.nonzero(got >= ranking.least)
            ids = np.array([p[0] or 0 for p in part], np.int64)
            null = np.array([p[0] is None for p in part])
            ranking.add(found, got[at, found], ids[at], null[at])

        for ids, texts in _texts(batches):
            part, work = [], 0
            for i, t in zip(ids.to_pylist(), texts):
                n, found, tf = scanner.counts(t)
                if not len(found):
                    continue
                part.append((i, n, found, tf))
                work += n_items + int(degree[found].sum())
                if work > _SLICE:
                    score(part)
                    part, work = [], 0
            if part:
                score(part)
        ranking.cut()
        item, got, ids, null = ranking.kept
        yield pa.RecordBatch.from_arrays([pa.array(item), pa.array(ids, mask=null.astype(bool)), pa.array(got)], ["item", "doc_id", "score"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(scan, "item long, doc_id long, score long")


def _ranked(rows: DataFrame, top: int, *keys: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def search(documents: DataFrame, items: DataFrame, top: int = TOP, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents of every item."""
    spark = documents.sparkSession
    kind = items.schema["item_id"].dataType.simpleString()
    out = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    documents = documents.select("doc_id", F.col("text").cast("string").alias("text"))
    for block in blocks(item_terms(items).checkpoint(), block_terms):
        pairs = block.collect()  # at most block_terms rows, or those of one item
        ids = list(dict.fromkeys(r["item_id"] for r in pairs))
        number = {i: k for k, i in enumerate(ids)}
        words = sorted({r["term"] for r in pairs})
        place = {w: k for k, w in enumerate(words)}
        links = np.array(sorted((place[r["term"]], number[r["item_id"]]) for r in pairs), np.int64)
        start = np.searchsorted(links[:, 0], np.arange(len(words) + 1))
        key = uuid.uuid4().hex
        terms = spark.sparkContext.broadcast(words)
        stats = statistics(documents, key, terms)
        if stats[0] == 0:
            continue
        found = best(documents, key, terms, spark.sparkContext.broadcast((links[:, 1], start, len(ids))), stats, top)
        found = _ranked(found.withColumn("_salt", F.pmod(F.xxhash64("doc_id"), F.lit(16))), top, "item", "_salt").drop("rank")
        found = _ranked(found, top, "item")
        names = spark.createDataFrame(list(enumerate(ids)), f"number long, item_id {kind}")
        found = found.join(names, F.col("item") == F.col("number"))
        out = out.unionAll(found.select("item_id", "rank", "doc_id", "score"))
    return out
