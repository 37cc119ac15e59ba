"""Quality classifier: logistic regression on hashed word n-grams, trained with
follow-the-regularised-leader (FTRL-proximal) updates.

Tokens are letter runs as written and runs of other marks; their 1- and
2-grams are hashed to ``BUCKETS`` features, each the root of its share of the
text's n-grams (a token that repeats the one or two places before it is one
more gram, the same for all tokens), and a score is one sparse dot product through the logistic function.  Training is
on the driver over a bounded sample of labelled documents that are not held
out; L1 regularisation leaves most weights at zero.

Null texts count as empty: no feature, the score is the bias.  Repeated rows
score alike."""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostrum.llm import sampling
from rostrum.llm.common import column_lists, held_out

#: Rows of each label value in the training sample.
PER_CLASS = 3000
BUCKETS_LOG2 = 20
BUCKETS = 1 << BUCKETS_LOG2
EPOCHS = 4
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.05
THRESHOLD = 0.3
_TOKENS = re.compile(r"\w+|[^\w\s]+")


class Hashes(dict):
    """Token to 32-bit hash; forgets when it has grown large."""

    def __missing__(self, token: str) -> int:
        if len(self) > 500_000:
            self.clear()
        v = self[token] = zlib.crc32(token.encode("utf-8", "surrogatepass"))
        return v

    def features(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Distinct buckets of the text's 1- and 2-grams and the root of each one's share."""
        tokens = _TOKENS.findall(text) if text else ()
        h = np.array([self[t] for t in tokens], np.uint32)
        pairs = (h[:-1] * np.uint32(0x9E3779B1) ^ h[1:]) * np.uint32(0x85EBCA6B)
        again = [np.full(int((h[k:] == h[:-k]).sum()), k << 12, np.uint32) for k in (1, 2)]
        grams = np.concatenate([h * np.uint32(0xC2B2AE35), pairs, *again]) >> np.uint32(32 - BUCKETS_LOG2)
        at, n = np.unique(grams, return_counts=True)
        return at.astype(np.int32), np.sqrt(n / max(1, len(grams))).astype(np.float32)


@dataclass
class Model:
    weights: np.ndarray
    bias: float

    def score(self, features: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Sparse dot products of a block of documents."""
        z = np.full(len(features), self.bias)
        full = [i for i, (at, _) in enumerate(features) if len(at)]
        if full:
            starts = np.cumsum([0] + [len(features[i][0]) for i in full[:-1]])
            products = self.weights[np.concatenate([features[i][0] for i in full])] \
                * np.concatenate([features[i][1] for i in full])
            z[full] += np.add.reduceat(products, starts, dtype=float)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def train(docs: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, seed: int = 7) -> Model:
    """FTRL-proximal, one document at a time; the last entry of each state
    array is the bias, which is not regularised."""
    z, n = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)
    rng = np.random.default_rng(seed)

    def weights(at):
        w = -(z[at] - np.sign(z[at]) * L1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2)
        return np.where(np.abs(z[at]) <= L1, 0.0, w)

    def bias():
        return -z[-1] / ((BETA + np.sqrt(n[-1])) / ALPHA)

    for _ in range(EPOCHS):
        for i in rng.permutation(len(docs)):
            f, x = docs[i]
            w, b = weights(f), bias()
            p = 1 / (1 + np.exp(-np.clip(w @ x + b, -30, 30)))
            for at, g, old in ((f, (p - y[i]) * x, w), (BUCKETS, p - y[i], b)):
                sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
                z[at] += g - sigma * old
                n[at] += g * g
    return Model(weights(slice(0, BUCKETS)).astype(np.float32), float(bias()))


def fit(documents: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    """Train on a bounded sample of the labelled documents that are not held
    out; the driver receives their texts."""
    sample = sampling.labelled(documents, labels, "quality", ~held_out(F.col("doc_id"), 5, 0), per_class)
    rows = sample.select(F.col("doc_id").cast("string").alias("doc_id"), "label", "text").collect()
    rows = sorted(rows, key=lambda r: (zlib.crc32(r["doc_id"].encode()), r["doc_id"], r["text"]))
    y = np.array([r["label"] for r in rows], float)
    if len(set(y)) < 2:
        share = (y.sum() + 0.5) / (len(y) + 1)
        return Model(np.zeros(BUCKETS, np.float32), float(np.log(share / (1 - share))))
    hashes = Hashes()
    return train([hashes.features(r["text"]) for r in rows], y)


def score_documents(documents: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every document."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        hashes = Hashes()
        for b, texts in column_lists(batches, "text"):
            s = shared.value.score([hashes.features(t) for t in texts])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s, pa.float64())], ["doc_id", "score"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")


def classify(documents: DataFrame, labels: DataFrame) -> DataFrame:
    out = score_documents(documents, fit(documents, labels))
    return out.select("doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score",
                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
