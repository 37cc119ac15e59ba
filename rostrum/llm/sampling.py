"""Bounded, reproducible samples of labelled documents for classifiers.

Rows are chosen by the hash of their id, never by position: a row is in the
sample if its hash lies below the share of its class that the bound allows,
so every class gives about ``per_class`` rows (all of them where it has fewer)
and a rerun draws the same ones."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_SPACE = 1 << 31


def hash_share(key: Column, seed: int) -> Column:
    """A uniform long in [0, 2^31) from the key."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), key), 33)


def by_class(rows: DataFrame, key: str, label: str, per_class: int, seed: int = 11) -> DataFrame:
    """About ``per_class`` rows of each value of ``label`` (not null).  One
    counting job; the class table it broadcasts has a row per class."""
    rows = rows.where(F.col(label).isNotNull())
    counts = rows.groupBy(F.col(label).alias("_class")).agg(F.count("*").alias("_n")).collect()
    if not counts:
        return rows.limit(0)
    table = rows.sparkSession.createDataFrame(
        [(r["_class"], min(_SPACE, _SPACE * per_class // r["_n"])) for r in counts],
        schema=f"_class {rows.schema[label].dataType.simpleString()}, _share long")
    share = hash_share(F.col(key), seed)
    return (rows.join(F.broadcast(table), F.col(label) == F.col("_class"))
            .where(share < F.col("_share")).drop("_class", "_share"))


def least_keys(rows: DataFrame, per_class: int) -> DataFrame:
    """Of (label, key long) rows without nulls the ``per_class`` smallest
    different keys of each label (all, if fewer).  A task hands on at most that
    many for each label it meets, so the labels must be few."""

    def least(batches):
        best: dict[str, np.ndarray] = {}
        for b in batches:
            labels = b.column(0).dictionary_encode()
            of, keys = labels.indices.to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False)
            for i, label in enumerate(labels.dictionary.to_pylist()):
                mine = np.concatenate([best.get(label, keys[:0]), keys[of == i]])
                best[label] = np.unique(mine)[:per_class]
        for label, keys in best.items():
            yield pa.RecordBatch.from_arrays([pa.array([label] * len(keys), pa.string()), pa.array(keys, pa.int64())],
                                             ["label", "key"])

    found = rows.mapInArrow(least, "label string, key long").distinct()
    place = F.row_number().over(Window.partitionBy("label").orderBy("key"))
    return found.withColumn("_place", place).where(F.col("_place") <= per_class).drop("_place")


def labelled(documents: DataFrame, labels: DataFrame, label: str, train: Column, per_class: int) -> DataFrame:
    """(doc_id, text, lang, label) of a bounded sample of the labelled documents for
    which ``train`` holds.  Only the sampled labels, at most about twice
    ``per_class`` rows, are broadcast: texts do not shuffle.  A document
    labelled more than once counts with its largest label."""
    lab = (labels.where(F.col("doc_id").isNotNull() & train)
           .groupBy("doc_id").agg(F.max(label).cast("int").alias("_y")))
    lab = by_class(lab, "doc_id", "_y", per_class).withColumnRenamed("doc_id", "_id")
    return (documents.select("doc_id", "text", "lang").join(F.broadcast(lab), F.col("doc_id") == F.col("_id"))
            .select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "lang", F.col("_y").alias("label")))
