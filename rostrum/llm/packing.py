"""Best-fit packing of tokenised documents into sequences of bounded length.

A document's ids are its tokens and one end id; only a document longer than a
sequence is cut.  Pieces are dealt by hash to groups of about ``GROUP`` pieces
and each group is packed in one task by bin completion: best-fit decreasing
gives the incumbent; while it uses more sequences than the lower bound,
sequences are completed around the largest piece left with all fillings
that no other filling dominates, branches whose waste exceeds what the
incumbent allows are cut, and the search ends at the bound or after
``SEARCH_STEPS`` placements with the best packing found so far.  A group can waste
less than one sequence more than an undivided packing, so the loss is under
one sequence in ``GROUP`` pieces.

Null and empty texts have the end id alone.  Repeated rows are packed like any
others; an empty table gives no piece."""

from __future__ import annotations

import itertools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostrum.llm.common import column_lists, scratch

CAPACITY = 4096
END_ID = 1
GROUP = 16_384
SEARCH_STEPS = 3_000
_NODES = 200


# ----------------------------------------------------------------- tokenising


#: Fixed values of the vocabulary's file: its splitting pattern, written for the lower-cased characters up to U+00FF.
_LETTER, _NUMBER = "a-zªµºß-öø-ÿ", "0-9²³¹¼½¾"
_SPLIT = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^\\s{_LETTER}{_NUMBER}]+")
#: What the fast path leaves to the tokeniser: characters beyond U+00FF, separators that only Python
#: counts as white space, and the opening of special tokens.
_OTHER = ("\x1c", "\x1d", "\x1e", "\x1f", "<|")
#: What a string costs a store beside its characters and ids, about, and what a store may hold.
_ENTRY_BYTES = 200
STORE_BYTES = 128 << 20


def _plain(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return not any(x in text for x in _OTHER)


class _Store:
    """Ids of strings, end to end, and where each string's begin."""

    def __init__(self):
        self.rows: dict[str, int] = {}
        self.bytes = 0
        self.ids, self.starts, self.sizes = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, keys: list[str], ids: np.ndarray, sizes: np.ndarray):
        self.bytes += _ENTRY_BYTES * len(keys) + sum(map(len, keys)) + ids.nbytes
        self.rows.update(zip(keys, range(len(self.rows), len(self.rows) + len(keys))))
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.ids = np.concatenate([self.ids, ids])

    def of(self, split: list[list[str]], learn) -> tuple[np.ndarray, np.ndarray]:
        """All ids of all lists, end to end, and each list's number of ids;
        ``learn`` adds the strings that are new."""
        flat = list(itertools.chain.from_iterable(split))
        at = np.fromiter(map(self.rows.get, flat, itertools.repeat(-1)), np.int64, len(flat))
        missing = np.flatnonzero(at < 0)
        if len(missing):
            fresh = [flat[k] for k in missing.tolist()]
            learn(list(dict.fromkeys(fresh)))
            at[missing] = np.fromiter(map(self.rows.get, fresh), np.int64, len(fresh))
        sizes = self.sizes[at]
        ends = np.cumsum(sizes)
        ids = self.ids[np.arange(int(sizes.sum())) + np.repeat(self.starts[at] - ends + sizes, sizes)]
        last = np.concatenate([[0], ends])[np.cumsum([len(ks) for ks in split], dtype=np.int64)]
        return ids, np.diff(last, prepend=0)


class WordTokens:
    """Ids of texts by their words.  The vocabulary encodes each match of its
    splitting pattern on its own and no match crosses white space, so a text's
    ids are those of its chunks, a chunk's those of its matches, and every
    distinct chunk and match is encoded once.  Texts with other characters are
    encoded as they are.  A store that holds ``most`` bytes starts anew."""

    def __init__(self, path: str, most: int = STORE_BYTES):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocab = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for k, i in vocab.items() if k.endswith("</w>")]] = True
        self.most = most
        self.words, self.chunks = _Store(), _Store()

    def _encode(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)

    def _learn_words(self, words: list[str]):
        ids = self._encode(" ".join(words))
        self.words.add(words, ids, np.diff(np.flatnonzero(self.ends[ids]), prepend=-1))

    def _learn_chunks(self, chunks: list[str]):
        split = [[c.lower()] if c.isalpha() else _SPLIT.findall(c.lower()) for c in chunks]
        self.chunks.add(chunks, *self.words.of(split, self._learn_words))

    def block(self, texts: list[str | None]) -> list[np.ndarray]:
        for name in ("words", "chunks"):
            if getattr(self, name).bytes > self.most:
                setattr(self, name, _Store())
        plain = [not t or _plain(t) for t in texts]
        split = [t.split() if t and ok else [] for t, ok in zip(texts, plain)]
        ids, sizes = self.chunks.of(split, self._learn_chunks)
        return [i if ok else self._encode(t) for t, ok, i in zip(texts, plain, np.split(ids, np.cumsum(sizes)[:-1]))]


_TOKENS: dict[str, WordTokens] = {}


def word_tokens(path: str) -> WordTokens:
    """The tokens of a vocabulary file, one set of stores for a worker process."""
    if path not in _TOKENS:
        _TOKENS.clear()
        _TOKENS[path] = WordTokens(path)
    return _TOKENS[path]


_PIECES = "piece int, start long, length long, ids_crc32 long"


def tokenised_pieces(documents: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document."""

    def run(batches: Iterator[pa.RecordBatch]):
        tokens = word_tokens(path)
        end = np.array([end_id], np.uint32)
        for b, texts in column_lists(batches, "text"):
            row, rest = [], []
            for i, ids in enumerate(tokens.block(texts)):
                ids = np.concatenate([ids, end]).astype("<u4")
                for k, s in enumerate(range(0, len(ids), capacity)):
                    part = ids[s : s + capacity]
                    row.append(i)
                    rest.append((k, s, len(part), zlib.crc32(part.tobytes())))
            cols = list(zip(*rest)) or [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(row, pa.int64())), pa.array(cols[0], pa.int32()),
                 *(pa.array(c, pa.int64()) for c in cols[1:])], ["doc_id", "piece", "start", "length", "ids_crc32"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, {_PIECES}")


# -------------------------------------------------------------------- packing


def best_fit(counts: dict[int, int], capacity: int) -> list[list[int]]:
    """Best-fit decreasing over a multiset of lengths.  ``open_at`` keeps the
    open bins by space left and a bit mask finds the tightest that fits."""
    bins: list[list[int]] = []
    open_at: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = 0
    for size in sorted(counts, reverse=True):
        for _ in range(counts[size]):
            fits = mask >> size
            if fits:
                room = size + (fits & -fits).bit_length() - 1
                b = open_at[room].pop()
                if not open_at[room]:
                    mask &= ~(1 << room)
            else:
                room, b = capacity, len(bins)
                bins.append([])
            bins[b].append(size)
            if room > size:
                open_at[room - size].append(b)
                mask |= 1 << (room - size)
    return bins


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Sequences needed at least: for each cut a, pieces over capacity - a are
    alone, those over half share with none of their kind, and what is at least
    a long must fit beside them (Martello and Toth's L2)."""
    n = np.zeros(capacity + 2, np.int64)
    for size, k in counts.items():
        n[size] = k
    number, length = np.cumsum(n), np.cumsum(n * np.arange(capacity + 2))
    a = np.arange(capacity // 2 + 1)
    half, top = capacity // 2, capacity - a
    alone = number[capacity] - number[top]
    pairs, pairs_length = number[top] - number[half], length[top] - length[half]
    small = length[half] - np.where(a > 0, length[a - 1], 0)
    more = -(-(small - (pairs * capacity - pairs_length)) // capacity)
    return int((alone + pairs + np.maximum(0, more)).max())


def _fillings(left: dict[int, int], first: int, avail: int, room: int, spare: int, rounds: float = np.inf) -> Iterator[tuple[int, ...] | None]:
    """Fillings of ``room`` beside ``first`` from the lengths left (the bits of
    ``avail``) that waste at most ``spare``, without those in which one piece
    could be swapped for a larger length that is still free, or several for the
    one length that fills their space exactly (Martello and Toth's dominance).
    Enumerated depth first from the largest lengths and handed out while ``left``
    is as at the call: after each full sequence or ``_NODES`` pieces a round ends and what it found is sorted, least waste first;
    None if it found nothing.  Ends after ``rounds`` of them."""
    taken: list[int] = []
    used = {first: 1}
    space, nodes = room, 0
    found: list[tuple[int, ...]] = []
    below, fits = [avail & ((1 << (room + 1)) - 1)], [False]
    while below and rounds > 0:
        full = False
        if below[-1]:
            s = below[-1].bit_length() - 1
            below[-1] ^= 1 << s
            if left[s] <= used.get(s, 0):
                continue
            if s == space:
                below[-1] = 0  # it dominates whatever else fits into this space
            fits[-1] = True
            nodes += 1
            taken.append(s)
            used[s] = used.get(s, 0) + 1
            space -= s
            below.append(avail & ((1 << (min(s, space) + 1)) - 1))
            fits.append(False)
        else:
            if not fits[-1] and space <= spare:
                free = avail
                for t, k in used.items():
                    if k and left[t] <= k:
                        free &= ~(1 << t)
                if not space or not any(free >> (t + 1) & ((1 << space) - 1) for t in set(taken)):
                    found.append(tuple(taken))
                    full = not space
            below.pop()
            fits.pop()
            if taken:
                s = taken.pop()
                used[s] -= 1
                space += s
        if full or nodes >= _NODES or not below:
            yield from sorted(found, key=lambda f: (-sum(f), len(f))) or [None]
            found, nodes, rounds = [], 0, rounds - 1


def complete(counts: dict[int, int], capacity: int, incumbent: list[list[int]], steps: int) -> list[list[int]]:
    """Bin completion from an incumbent, up to ``steps`` placements, or rounds
    of the enumeration without a filling, beyond a first descent.  A search of
    the first round of each enumeration improves the incumbent; if it ends
    before the steps do, the whole tree is searched with those left."""
    steps += len(incumbent)
    best, steps = _search(counts, capacity, incumbent, steps, 1)
    return _search(counts, capacity, best, steps, np.inf)[0]


def _search(counts: dict[int, int], capacity: int, best: list[list[int]], steps: int, rounds: float) -> tuple[list[list[int]], int]:
    """Depth first over the fillings around the largest piece left; the best
    packing and the steps not used."""
    total = sum(s * n for s, n in counts.items())
    bound = lower_bound(counts, capacity)
    left, avail = dict(counts), sum(1 << s for s in counts)
    path: list[list[int]] = []
    stack: list[Iterator] = []
    waste = 0

    def choices():
        first = avail.bit_length() - 1
        spare = (len(best) - 1) * capacity - total - waste
        return (f if f is None else [first, *f] for f in _fillings(left, first, avail, capacity - first, spare, rounds))

    def place(b: list[int], n: int):
        nonlocal waste, avail
        waste += n * (capacity - sum(b))
        for s in b:
            left[s] -= n
            avail = avail | 1 << s if left[s] else avail & ~(1 << s)

    while len(best) > bound and steps > 0:
        if not path and not stack:
            stack.append(choices())
        b = next(stack[-1], ())
        if b == ():
            stack.pop()
            if not path:
                break
            place(path.pop(), -1)
            continue
        steps -= 1
        if b is None:
            continue
        if waste + capacity - sum(b) > (len(best) - 1) * capacity - total:
            continue
        path.append(b)
        place(b, 1)
        if avail:
            stack.append(choices())
        else:
            best = list(path)
            place(path.pop(), -1)
    return best, steps


def pack(lengths: list[int], capacity: int = CAPACITY, steps: int = SEARCH_STEPS) -> list[tuple[int, int]]:
    """(bin, offset) of each length; full-length pieces have a bin of their own."""
    counts: dict[int, int] = {}
    for n in lengths:
        counts[n] = counts.get(n, 0) + 1
    bins = complete(counts, capacity, best_fit(counts, capacity), steps)
    slots: dict[int, list[tuple[int, int]]] = {}
    for b, content in enumerate(bins):
        offset = 0
        for n in content:
            slots.setdefault(n, []).append((b, offset))
            offset += n
    return [slots[n].pop() for n in lengths]


def pack_pieces(pieces: DataFrame, groups: int, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to rows with ``length`` (at most capacity);
    each of ``groups`` hash groups is packed by one task."""
    keyed = pieces.withColumn("_group", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(groups)))

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "piece"], ascending=[False, True, True], kind="stable")
        placed = np.array(pack(rows["length"].tolist(), capacity), np.int64).reshape(-1, 2)
        rows["sequence_id"] = rows.pop("_group") * (1 << 32) + placed[:, 0]
        rows["offset"] = placed[:, 1]
        return rows

    kind = pieces.schema["doc_id"].dataType.simpleString()
    return keyed.groupBy("_group").applyInPandas(run, f"doc_id {kind}, {_PIECES}, sequence_id long, offset long")


def pack_documents(documents: DataFrame, path: str, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """Tokenise and pack whole documents.  The pieces, numbers only, are written
    to the shared folder, counted there and dealt to groups of about ``group``."""
    spark = documents.sparkSession
    folder = scratch(spark, "pieces")
    tokenised_pieces(documents, path, capacity).write.parquet(folder)
    pieces = spark.read.parquet(folder)
    return pack_pieces(pieces, -(-max(1, pieces.count()) // group), capacity)
