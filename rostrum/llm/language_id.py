"""Language identification with a string kernel.

The blended-spectrum presence kernel counts the character n-grams (n = 1 to 4)
that two texts share, normalised by both texts' numbers of n-grams.  Nyström
landmarks turn it into a finite feature map; one-versus-rest kernel ridge
regression learns a score per language in that map.  N-grams are hashed to
``BUCKETS`` presence bits, so the kernel of a block of texts against all
landmarks is one matrix product; landmark matrix, whitening and regression
weights multiply to a (BUCKETS, languages) matrix once on the driver.

Null, empty or letterless texts get ``und`` with score 0; without any language
to learn from, so does every text.  Texts are read whole, whatever their
length.  Repeated rows are scored alike; ties between languages go to the first
by code point.  Of many language values only the most frequent, as many as the
sample has room for, can be predicted.  An empty table gives no row, and columns
beside doc_id, text and lang are not looked at, whatever their names."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostrum.llm import sampling
from rostrum.llm.common import column_lists, held_out

BUCKETS_LOG2 = 16
BUCKETS = 1 << BUCKETS_LOG2
ORDERS = 4
#: Bounds of the training sample, shared evenly by the languages: documents, and landmarks among them.
SAMPLE = 2000
LANDMARKS = 256
#: Documents that the sample has room for in every language; so SAMPLE // LEAST languages, the most frequent ones, are learned.
LEAST = 8
SEED = 11
RIDGE = 0.1
_LETTERS = regex.compile(r"\p{L}+")
_BATCH = 64


def ngram_buckets(text: str | None) -> np.ndarray | None:
    """Hashed n-grams of the text's lower-cased letter runs, None without a letter."""
    runs = _LETTERS.findall(text.lower()) if text else []
    if not runs:
        return None
    c = np.frombuffer((" " + " ".join(runs) + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    out, h = [], np.zeros(len(c), np.uint32)
    for n in range(ORDERS):
        if len(c) <= n:
            break
        h = (h[: len(c) - n] + c[n:] + np.uint32(n + 1)) * np.uint32(0x9E3779B1)
        h ^= h >> np.uint32(15)
        out.append((h * np.uint32(0x85EBCA6B)) >> np.uint32(32 - BUCKETS_LOG2))
    return np.concatenate(out)


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # (BUCKETS, languages + 1): presence to score times root of size; last column ones
    bias: np.ndarray

    def scores(self, grams: list[np.ndarray]) -> np.ndarray:
        """Scores (texts, languages) by products of presence blocks."""
        out = np.zeros((len(grams), len(self.languages)))
        for s in range(0, len(grams), _BATCH):
            part = grams[s : s + _BATCH]
            x = np.zeros((len(part), BUCKETS), np.float32)
            for i, g in enumerate(part):
                x[i, g] = 1
            y = x @ self.weights
            out[s : s + len(part)] = y[:, :-1] / np.sqrt(y[:, -1:]) + self.bias
        return out


def _presence(batches):
    for _, labels, keys, texts in column_lists(batches, "lang", "key", "text"):
        bits, kept = [], []
        for i, text in enumerate(texts):
            g = ngram_buckets(text)
            if g is not None:
                row = np.zeros(BUCKETS, bool)
                row[g] = True
                bits.append(np.packbits(row).tobytes())
                kept.append(i)
        yield pa.RecordBatch.from_arrays(
            [pa.array([labels[i] for i in kept], pa.string()), pa.array([keys[i] for i in kept], pa.int64()),
             pa.array(bits, pa.binary())], ["lang", "key", "bits"])


def sample_rows(rows: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(lang, key, bits) of the training sample of (doc_id, text, lang) rows:
    of the ``sample // LEAST`` most frequent languages (ties by code point) that
    have a text with a letter, each the same number of rows, those of smallest
    hash of id and text (all, if fewer).  Rows alike in both count once."""
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    langs = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(max(1, sample // LEAST)).collect()
    keyed = rows.select("lang", "text", F.xxhash64(F.lit(SEED), "doc_id", "text").alias("key"))
    keyed = keyed.where(F.col("lang").isin([r["lang"] for r in langs]))
    chosen = sampling.least_keys(keyed.select(F.col("lang").alias("label"), "key"), max(1, sample // max(1, len(langs))))
    chosen = F.broadcast(chosen.select("label", F.col("key").alias("its")))
    rows = keyed.join(chosen, (F.col("lang") == F.col("label")) & (F.col("key") == F.col("its"))).select("lang", "key", "text")
    return rows.mapInArrow(_presence, "lang string, key long, bits binary").dropDuplicates(["lang", "key"])


def _dense(bits: list[bytes]) -> np.ndarray:
    """Presence rows of unit length."""
    x = np.unpackbits(np.frombuffer(b"".join(bits), np.uint8)).reshape(len(bits), BUCKETS).astype(np.float32)
    return x / np.sqrt(x.sum(1, keepdims=True))


def fit(rows: DataFrame, sample: int = SAMPLE, landmarks: int = LANDMARKS) -> Model:
    """Learn from (doc_id, text, lang) rows.  The driver gets the presence bits
    (8 kB each) of at most ``sample`` documents and unpacks a block at a time;
    the landmarks are those of smallest hash in each language."""
    got = sorted((r["lang"], r["key"], bytes(r["bits"])) for r in sample_rows(rows, sample).collect())
    got = [(lang, bits) for lang, _, bits in got]
    langs = sorted({k for k, _ in got}, key=lambda s: s.encode())
    if not langs:
        return Model([], np.zeros((BUCKETS, 1), np.float32), np.zeros(0))
    of = np.array([langs.index(k) for k, _ in got])
    each = max(1, landmarks // len(langs))
    mark = _dense([got[i][1] for k in range(len(langs)) for i in np.flatnonzero(of == k)[:each]])
    values, vectors = np.linalg.eigh((mark @ mark.T).astype(float))
    good = values > 1e-6 * values[-1]
    white = vectors[:, good] / np.sqrt(values[good])
    phi = np.vstack([_dense([b for _, b in got[i : i + 2 * _BATCH]]) @ mark.T for i in range(0, len(got), 2 * _BATCH)])
    phi = phi.astype(float) @ white
    y = np.where(of[:, None] == np.arange(len(langs)), 1.0, -1.0)
    # rows of rare languages weigh as much as those of frequent ones
    weight = (len(got) / len(langs) / np.bincount(of, minlength=len(langs)))[of][:, None]
    mean, base = (weight * phi).sum(0) / weight.sum(), (weight * y).sum(0) / weight.sum()
    centred = phi - mean
    w = np.linalg.solve(centred.T @ (weight * centred) + RIDGE * np.eye(phi.shape[1]), centred.T @ (weight * (y - base)))
    full = mark.T @ (white @ w).astype(np.float32)
    return Model(langs, np.hstack([full, np.ones((BUCKETS, 1), np.float32)]), base - mean @ w)


def _labels(m: Model, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """The predicted language and its confidence for each text."""
    grams = [ngram_buckets(t) for t in texts]
    known = [i for i, g in enumerate(grams) if g is not None and m.languages]
    pred, conf = ["und"] * len(grams), np.zeros(len(grams))
    if known:
        s = m.scores([grams[i] for i in known])
        e = np.exp(3 * (s - s.max(1, keepdims=True)))
        best = s.argmax(1)
        for i, k, p in zip(known, best, e.max(1) / e.sum(1)):
            pred[i], conf[i] = m.languages[k], p
    return pred, conf


def predict(documents: DataFrame, model: Model) -> DataFrame:
    """All columns of ``documents`` but the texts are left out: (doc_id,
    lang_pred, score).  The model is one broadcast of 1.3 MB for four languages."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def score(batches):
        m = shared.value
        for b, texts in column_lists(batches, "text"):
            pred, conf = _labels(m, texts)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(pred, pa.string()), pa.array(conf, pa.float64())],
                ["doc_id", "lang_pred", "score"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(score, f"doc_id {kind}, lang_pred string, score double")


def train_rows(documents: DataFrame) -> DataFrame:
    return documents.select("doc_id", "text", "lang").where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"), 3, 1))


def identify(documents: DataFrame) -> DataFrame:
    """Fit on the documents that are not held out, predict all of them."""
    out = predict(documents, fit(train_rows(documents)))
    return out.select("doc_id", held_out(F.col("doc_id"), 3, 1).alias("held_out"), "lang_pred", "score")


def keep_identified(documents: DataFrame) -> DataFrame:
    """Documents whose predicted language is not ``und``, with their own columns."""
    shared = documents.sparkSession.sparkContext.broadcast(fit(train_rows(documents)))

    def keep(batches):
        m = shared.value
        for b, texts in column_lists(batches, "text"):
            yield b.filter(pa.array([k != "und" for k in _labels(m, texts)[0]], pa.bool_()))

    return documents.mapInArrow(keep, documents.schema)
