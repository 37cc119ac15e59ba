"""Toxicity: a convolutional text classifier trained in numpy.

A word's embedding is the sum of hashed table rows of the word, its first
three to six and its last three and four characters, so unseen forms of a
known stem have one; filters of width 1, 2 and 3 slide over the whole text, each filter keeps its maximum (ReLU, max pooling), and a
logistic layer scores the pooled values.  Training is Adagrad over all labelled documents
that are not held out: they are dealt into parts of about ``PART`` documents by the hash of
their id, one part trains a first model, and in each of ``ROUNDS`` rounds every part
trains on from the model so far and the parts' models are averaged, a table row over the
parts that have a word of it.  Scoring is one pass over the documents.  A decision
threshold is calibrated for each language on the fifth of the labelled documents that
training did not see; languages are no input of the score.

Null texts count as empty and get the score of a text without words; repeated
rows score alike.  Texts of any length are pooled piece by piece."""

from __future__ import annotations

import pickle
import re
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostrum.llm import sampling
from rostrum.llm.common import column_lists, held_out
from rostrum.session import stored

#: Documents that one task trains on.
PART = 4096
#: Rounds over all parts after the first part's own epochs; a round is one epoch.
ROUNDS = 2
BUCKETS = 1 << 18
DIMS = 8
WIDTHS = (1, 2, 3)
FILTERS = 8
EPOCHS = 6
RATE = 0.1
SEED = 5
#: Table rows that are averaged in one group.
SLICE = 512
#: Labelled documents up to which their labels are broadcast to the texts.
MOST_LABELS = 2_000_000
#: Scores are counted by this many steps when thresholds are calibrated.
STEPS = 10_000
#: Words scored at once; a longer text is cut with an overlap of the widest filter.
PIECE = 1 << 15
#: The score from which a document counts as toxic where no language threshold applies.
THRESHOLD = 0.7
_WORDS = re.compile(r"[^\W_]+")
_PAD = 0
_HEADS = (3, 4, 5, 6)
_TAILS = (3, 4)


def subwords(word: str) -> list[int]:
    """Table rows of a word (0 is padding)."""
    parts = [f"={word}", *(f"^{word[:n]}" for n in _HEADS), *(f"{word[-n:]}$" for n in _TAILS)]
    return [1 + zlib.crc32(p.encode("utf-8", "surrogatepass")) % (BUCKETS - 1) for p in parts]


def words_of(text: str | None) -> list[str]:
    return _WORDS.findall(text.lower()) if text else []


class WordRows(dict):
    """Word to a row of ``vectors``, its embedding; row 0 is padding.  Starts
    anew when it has grown large."""

    def __init__(self, table: np.ndarray, most: int = 300_000):
        super().__init__()
        self.table, self.most = table, most
        self.vectors = np.zeros((1 << 12, table.shape[1]), np.float32)

    def __missing__(self, word: str) -> int:
        row = len(self) + 1
        if row == len(self.vectors):
            self.vectors = np.vstack([self.vectors, np.zeros_like(self.vectors)])
        self.vectors[row] = self.table[subwords(word)].sum(0)
        self[word] = row
        return row

    def block(self, texts: list[str | None]) -> list[np.ndarray]:
        """Row ids of each text; valid until the next block."""
        if len(self) > self.most:
            self.clear()
        return [np.array([self[w] for w in words_of(t)], np.int32) for t in texts]


@dataclass
class Model:
    table: np.ndarray  # (BUCKETS, DIMS) float32; rows never trained are zero
    filters: list[np.ndarray]  # per width: (width, DIMS, FILTERS)
    shift: np.ndarray  # (widths * FILTERS,)
    out: np.ndarray
    bias: float
    thresholds: dict[str, float] = field(default_factory=dict)

    def maps(self, e: np.ndarray) -> np.ndarray:
        """Filter responses at every start position of the word vectors, without
        the last ``max(WIDTHS) - 1`` (padding or overlap) of them."""
        n = len(e) - max(WIDTHS) + 1
        return np.hstack([sum(e[k : k + n] @ w[k] for k in range(len(w))) for w in self.filters])

    def pooled(self, docs: list[np.ndarray], vectors: np.ndarray) -> np.ndarray:
        """Max of every filter over each whole text, (docs, filters); docs hold
        rows of ``vectors``."""
        out = np.full((len(docs), len(self.shift)), -np.inf, np.float32)
        pad, back = np.full(max(WIDTHS) - 1, _PAD, np.int32), max(WIDTHS) - 1
        parts, owner, size = [], [], 0

        def flush():
            if parts:
                starts = np.cumsum([0] + [len(p) for p in parts])
                bounds = np.ravel([(a, b - back) for a, b in zip(starts[:-1], starts[1:])])
                maps = self.maps(vectors[np.concatenate(parts)])
                if bounds[-1] >= len(maps):
                    bounds = bounds[:-1]
                np.maximum.at(out, owner, np.maximum.reduceat(maps, bounds, axis=0)[::2])
            parts.clear()
            owner.clear()

        for i, d in enumerate(docs):
            whole = np.concatenate([d if len(d) else np.zeros(1, np.int32), pad])
            for a in range(0, len(whole) - back, PIECE):
                parts.append(whole[a : a + PIECE + back])
                owner.append(i)
                size += len(parts[-1])
                if size >= PIECE:
                    flush()
                    size = 0
        flush()
        return np.maximum(out + self.shift, 0)

    def score(self, docs: list[np.ndarray], vectors: np.ndarray) -> np.ndarray:
        z = self.pooled(docs, vectors).astype(float) @ self.out + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


@dataclass
class State:
    """A model in training with Adagrad's sums; ``known`` are the table rows met so far."""

    table: np.ndarray
    g_table: np.ndarray
    known: np.ndarray
    small: list[np.ndarray]  # filters, shift, out, bias and their sums, see ``model``

    def model(self) -> Model:
        n = len(WIDTHS)
        filters, (shift, out, bias) = self.small[:n], self.small[n : n + 3]
        return Model(self.table, list(filters), shift, out, float(bias[0]))


def first_state(seed: int = SEED) -> State:
    rng = np.random.default_rng(seed)
    filters = [rng.normal(0, 0.3, (w, DIMS, FILTERS)).astype(np.float32) for w in WIDTHS]
    k = FILTERS * len(WIDTHS)
    small = [*filters, np.full(k, 0.05, np.float32), rng.normal(0, 0.3, k), np.zeros(1)]
    return State(np.zeros((BUCKETS, DIMS), np.float32), np.full((BUCKETS, DIMS), 0.1, np.float32), np.zeros(BUCKETS, bool),
                 [*small, *(np.full_like(x, 0.1) for x in small)])


def _first_rows(seed: int = SEED) -> np.ndarray:
    """Every table row as it begins, the same in all tasks."""
    return np.random.default_rng([seed, 1]).normal(0, 0.1, (BUCKETS, DIMS)).astype(np.float32)


def train(docs: list[np.ndarray], subs: np.ndarray, y: np.ndarray, state: State, epochs: int, seed: int) -> np.ndarray:
    """docs hold rows of ``subs``, the table rows of each word (row 0: padding).
    Adagrad over single documents; gradients reach only each filter's
    maximum, so a step costs one forward pass.  Changes ``state`` and returns the table
    rows that the documents have."""
    rng = np.random.default_rng(seed)
    seen = np.unique(subs[np.unique(np.concatenate([*docs, np.zeros(1, np.int32)]))])
    seen = seen[seen != _PAD]
    new = seen[~state.known[seen]]
    state.table[new] = _first_rows()[new]
    state.known[new] = True
    m, n = state.model(), len(state.small) // 2
    *g_filters, g_shift, g_out, g_bias = state.small[n:]
    g_table, k, bias = state.g_table, FILTERS * len(WIDTHS), state.small[n - 1]
    pad = np.full(max(WIDTHS) - 1, _PAD, np.int32)
    for _ in range(epochs):
        for i in rng.permutation(len(docs)):
            ids = np.concatenate([docs[i] if len(docs[i]) else np.zeros(1, np.int32), pad])
            maps = m.maps(m.table[subs[ids]].sum(1))
            at = maps.argmax(0)
            pool = np.maximum(maps[at, np.arange(k)] + m.shift, 0)
            z = float(np.clip(pool @ m.out + bias[0], -30, 30))
            err = 1 / (1 + np.exp(-z)) - y[i]
            if abs(err) < 1e-3:
                continue
            d_pool = np.where(pool > 0, err * m.out, 0)
            d_out, d_shift = err * pool, d_pool
            g_out += d_out**2
            g_shift += (d_shift**2).astype(np.float32)
            g_bias += err * err
            m.out -= RATE * d_out / np.sqrt(g_out)
            m.shift -= (RATE * d_shift / np.sqrt(g_shift)).astype(np.float32)
            bias -= RATE * err / np.sqrt(g_bias)
            rows, grads = [], []
            for j, f in enumerate(m.filters):
                d, pos = d_pool[j * FILTERS : (j + 1) * FILTERS], at[j * FILTERS : (j + 1) * FILTERS]
                step = np.zeros_like(f)
                for o in range(len(f)):
                    words = ids[pos + o]
                    step[o] = m.table[subs[words]].sum(1).T * d
                    rows.append(words)
                    grads.append((f[o] * d).T)
                g_filters[j] += step**2
                f -= (RATE * step / np.sqrt(g_filters[j])).astype(np.float32)
            hit = subs[np.concatenate(rows)]
            words, which = np.unique(hit, return_inverse=True)
            grad = np.zeros((len(words), DIMS), np.float32)
            np.add.at(grad, which.reshape(hit.shape), np.concatenate(grads).astype(np.float32)[:, None])
            grad[words == _PAD] = 0
            g_table[words] += grad**2
            m.table[words] -= RATE * grad / np.sqrt(g_table[words])
    return seen


def _indexed(texts: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
    """Texts as rows of the second value, the table rows of each of their words."""
    index: dict[str, int] = {}
    docs = [np.array([index.setdefault(w, len(index) + 1) for w in words_of(t)], np.int32) for t in texts]
    return docs, np.array([[_PAD] * (1 + len(_HEADS) + len(_TAILS)), *map(subwords, index)], np.int32)


def _round(parts: DataFrame, state: State, epochs: int, number: int) -> State:
    """Every part of (part, key, text, label) trains on from ``state``; the mean of their
    models.  The parts' models travel in slices of the table and are averaged by
    slice, so the driver receives one model."""
    shared = parts.sparkSession.sparkContext.broadcast(state)

    def one(key, rows):
        own = shared.value
        own = State(own.table.copy(), own.g_table.copy(), own.known.copy(), [x.copy() for x in own.small])
        part = key[0].as_py()
        order = sorted(zip(*(rows.column(c).to_pylist() for c in ("key", "text", "label"))))
        docs, subs = _indexed([t for _, t, _ in order])
        seen = train(docs, subs, np.array([y for *_, y in order], float), own, epochs, SEED + 1000 * number + part)
        out = [(-1, part, b"", pickle.dumps(own.small))]
        bounds = np.searchsorted(seen, np.arange(0, BUCKETS + SLICE, SLICE))
        for i, (a, z) in enumerate(zip(bounds[:-1], bounds[1:])):
            if z > a:
                at = seen[a:z]
                out.append((i, part, at.astype(np.int32).tobytes(), np.hstack([own.table[at], own.g_table[at]]).tobytes()))
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.int32(), pa.binary(), pa.binary()))],
                                    ["slice", "part", "at", "body"])

    def mean(key, rows):
        rows = rows.sort_by("part")
        ats, bodies = rows.column("at").to_pylist(), rows.column("body").to_pylist()
        if key[0].as_py() < 0:
            smalls = [pickle.loads(b) for b in bodies]
            at, body = b"", pickle.dumps([np.mean(x, axis=0).astype(x[0].dtype) for x in zip(*smalls)])
        else:
            first = key[0].as_py() * SLICE
            total, n = np.zeros((SLICE, 2 * DIMS)), np.zeros(SLICE)
            for a, b in zip(ats, bodies):
                i = np.frombuffer(a, np.int32) - first
                total[i] += np.frombuffer(b, np.float32).reshape(-1, 2 * DIMS)
                n[i] += 1
            i = np.flatnonzero(n)
            at, body = (i + first).astype(np.int32).tobytes(), (total[i] / n[i, None]).astype(np.float32).tobytes()
        return pa.table({"at": pa.array([at], pa.binary()), "body": pa.array([body], pa.binary())})

    models = parts.groupBy("part").applyInArrow(one, "slice int, part int, at binary, body binary")
    table, g_table, known, small = state.table.copy(), state.g_table.copy(), state.known.copy(), state.small
    for r in models.groupBy("slice").applyInArrow(mean, "at binary, body binary").collect():
        if not r["at"]:
            small = pickle.loads(r["body"])
            continue
        at, body = np.frombuffer(r["at"], np.int32), np.frombuffer(r["body"], np.float32).reshape(-1, 2 * DIMS)
        table[at], g_table[at], known[at] = body[:, :DIMS], body[:, DIMS:], True
    shared.unpersist()
    return State(table, g_table, known, small)


def _calibrated(s: np.ndarray, toxic: np.ndarray, clean: np.ndarray) -> float:
    """From ascending different scores with their counts of both labels: the cut with the
    fewest errors, in the middle of the widest such gap; the general threshold where a
    class is missing."""
    if not toxic.sum() or not clean.sum():
        return THRESHOLD
    errors = np.concatenate([[0], np.cumsum(toxic)]) + np.concatenate([np.cumsum(clean[::-1])[::-1], [0]])
    s = np.concatenate([[0], s, [1]])
    gaps = np.where(errors == errors.min(), np.diff(s), -1)
    i = int(gaps.argmax())
    return float((s[i] + s[i + 1]) / 2)


def thresholds(rows: DataFrame, model: Model) -> dict[str, float]:
    """The threshold of each language from all given (doc_id, lang, text, label) rows,
    whose scores are counted in steps of 1/``STEPS``."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        words = WordRows(shared.value.table)
        for b, langs, labels, texts in column_lists(batches, "lang", "label", "text"):
            s = np.round(shared.value.score(words.block(texts), words.vectors) * STEPS).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(s), pa.array(labels, pa.int32())], ["lang", "s", "label"])

    def cut(key, t):
        t = t.sort_by("s")
        at = _calibrated(*(t.column(c).to_numpy() for c in ("s", "toxic", "clean")))
        return pa.table({"lang": [key[0].as_py()], "threshold": [at]})

    scored = rows.select("lang", "label", "text").mapInArrow(run, "lang string, s int, label int")
    counts = scored.groupBy("lang", (F.col("s") / STEPS).alias("s")).agg(
        F.count_if(F.col("label") == 1).alias("toxic"), F.count_if(F.col("label") == 0).alias("clean"))
    found = counts.where("lang <> ''").groupBy("lang").applyInArrow(cut, "lang string, threshold double")
    return {r["lang"]: r["threshold"] for r in found.collect()}


def training_rows(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, key, text, lang, label, apart) of all labelled documents that are not held
    out; ``apart`` marks the fifth that calibrates.  A document labelled more than once
    counts with its largest label."""
    lab = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id"), 3, 1))
           .groupBy(F.col("doc_id").alias("_id")).agg(F.max("toxic").cast("int").alias("label")))
    if lab.count() <= MOST_LABELS:
        lab = F.broadcast(lab)
    rows = documents.select("doc_id", "text", "lang").join(lab, F.col("doc_id") == F.col("_id"))
    key = sampling.hash_share(F.col("doc_id"), 17)
    return rows.select("doc_id", key.alias("key"), F.coalesce("text", F.lit("")).alias("text"), "lang", "label", (key % 5 == 0).alias("apart"))


def fit(documents: DataFrame, labels: DataFrame) -> Model:
    """Train and calibrate on all labelled documents that are not held out.  Their texts
    are written once and meet by part; the driver has the models only."""
    rows = stored(training_rows(documents, labels), "toxicity-rows")
    n = {(r["apart"], r["label"]): r["n"] for r in rows.groupBy("apart", "label").agg(F.count("*").alias("n")).collect()}
    if len({y for _, y in n}) < 2:
        k = FILTERS * len(WIDTHS)
        share = (sum(c for (_, y), c in n.items() if y) + 0.5) / (sum(n.values()) + 1)
        return Model(np.zeros((BUCKETS, DIMS), np.float32), [np.zeros((w, DIMS, FILTERS), np.float32) for w in WIDTHS],
                     np.zeros(k, np.float32), np.zeros(k), float(np.log(share / (1 - share))))
    # too few rows to set a fifth apart: all of them train, and the general threshold holds
    apart = len({y for a, y in n if not a}) == 2
    own = rows.where("not apart") if apart else rows
    parts = max(1, round(sum(c for (a, _), c in n.items() if not (a and apart)) / PART))
    own = own.withColumn("part", (F.floor(F.col("key") / 5) % parts).cast("int")).select("part", "key", "text", "label")
    state = _round(own.where("part = 0"), first_state(), EPOCHS, 0)
    for i in range(ROUNDS):
        state = _round(own, state, 1, i + 1)
    model = state.model()
    model.thresholds = thresholds(rows.where("apart"), model) if apart else {}
    return model


def _scorer(shared, general: float = THRESHOLD):
    """Scores of texts, and which reach the threshold of their language
    (``general`` where it has none)."""
    words = WordRows(shared.value.table)

    def score(langs, texts):
        docs = words.block(texts)
        s = shared.value.score(docs, words.vectors)
        return s, s >= np.array([shared.value.thresholds.get(k, general) for k in langs])

    return score


def score_documents(documents: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, flagged) of every document; ``flagged`` uses the
    threshold of the row's language, ``THRESHOLD`` where it has none."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        score = _scorer(shared)
        for b, langs, texts in column_lists(batches, "lang", "text"):
            s, flagged = score(langs, texts)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s, pa.float64()), pa.array(flagged, pa.bool_())],
                                             ["doc_id", "score", "flagged"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "lang", "text").mapInArrow(run, f"doc_id {kind}, score double, flagged boolean")


def classify(documents: DataFrame, labels: DataFrame) -> DataFrame:
    out = score_documents(documents, fit(documents, labels))
    return out.select("doc_id", held_out(F.col("doc_id"), 3, 1).alias("held_out"), "score",
                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "flagged")


def keep_clean(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Documents that are not flagged, with their own columns: those that score
    below the threshold calibrated for their language, or below ``threshold``
    where it has none."""
    shared = documents.sparkSession.sparkContext.broadcast(fit(documents, labels))

    def keep(batches):
        score = _scorer(shared, threshold)
        for b, langs, texts in column_lists(batches, "lang", "text"):
            yield b.filter(pa.array(~score(langs, texts)[1], pa.bool_()))

    return documents.mapInArrow(keep, documents.schema)
