"""Readers and writers (inventory A5-A11).

All sinks write through Spark's distributed writers into a directory (one
file per task); nothing is gathered on the driver.  Result tables are small
(top-k lists, concept tables) but the writers do not rely on that.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rostrum.functions import text as tx
from rostrum.operators import impact
from rostrum.operators.lexicon import read_lexicon  # noqa: F401  (A5, re-exported)

BOM = "﻿"
POLARITY_FILES = {"positive": "top_positive_words_by_party", "negative": "top_negative_words_by_party"}


def read_result_csv(spark: SparkSession, path: str) -> DataFrame:
    """A result CSV with a header; a UTF-8 byte-order mark in front of the
    first column name is dropped."""
    df = spark.read.option("header", True).option("encoding", "UTF-8").csv(path)
    return df.toDF(*[c.lstrip(BOM) for c in df.columns])


def polarity_data(spark: SparkSession, root: str, data_type: str) -> DataFrame:
    """The positive or negative top-words table by key; any other key is
    an error (the reference answers 404)."""
    if data_type not in POLARITY_FILES:
        raise KeyError(f"invalid data type {data_type!r}")
    return read_result_csv(spark, f"{root}/{POLARITY_FILES[data_type]}")


def save(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Iterable[str] = ()) -> None:
    """Persist an intermediate (tokens, postings, vocabulary, vectors,
    lexicon) as Parquet."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def save_postings(post: DataFrame, path: str, partitions: int | None = None) -> None:
    """A7 for the search index: postings range-partitioned and sorted by (term,
    tier, id), so a later ``term IN (...)`` filter skips row groups by their min/max
    statistics instead of reading the whole index, and a frequent term spreads
    over several files."""
    n = [partitions] if partitions else []
    order = ["term", "tier", "id"]
    impact.with_tiers(post).repartitionByRange(*n, *order).sortWithinPartitions(*order).write.mode("overwrite").parquet(path)


def load(spark: SparkSession, path: str) -> DataFrame:
    """Reload a persisted intermediate."""
    return spark.read.parquet(path)


@dataclass
class SearchIndex:
    """A stored TF-IDF index, accepted by the searches in place of a model."""

    weights: DataFrame
    vocab: DataFrame
    blocks: DataFrame
    documents: DataFrame
    n_docs: int
    max_features: int | None


def save_index(model, path: str, partitions: int | None = None) -> None:
    """The weights by document and in impact blocks, the table of blocks, the
    vocabulary and the corpus size of a fitted model.  Documents are written first, where
    the model has them together; the blocks are read from there."""
    spark = model.weights.sparkSession
    save(impact.document_table(model.weights), f"{path}/documents")
    rows = load(spark, f"{path}/documents").select("id", F.inline_outer(F.arrays_zip("terms", "weights")))
    save_postings(rows.select(F.col("terms").alias("term"), "id", F.col("weights").alias("weight")), f"{path}/weights", partitions)
    save(impact.block_table(load(spark, f"{path}/weights")), f"{path}/blocks")
    save(model.vocab, f"{path}/vocabulary")
    size = model.docs.agg(F.count("*").alias("n_docs"))
    save(size.withColumn("max_features", F.lit(model.max_features).cast("int")), f"{path}/corpus")


def load_index(spark: SparkSession, path: str) -> SearchIndex:
    """The index that ``save_index`` wrote."""
    size = load(spark, f"{path}/corpus").first()
    return SearchIndex(load(spark, f"{path}/weights"), load(spark, f"{path}/vocabulary"), load(spark, f"{path}/blocks"),
                       load(spark, f"{path}/documents"),
                       size["n_docs"], size["max_features"])


def union_chunks(spark: SparkSession, paths: list[str]) -> DataFrame:
    """All chunk files as one table, read in one call; columns are matched
    by name, missing ones null.  Corrupt files are skipped and listed by
    ``skipped_chunks``.  No path gives a table without columns or rows."""
    if not paths:
        return spark.createDataFrame([], "struct<>")
    return spark.read.option("ignoreCorruptFiles", "true").option("mergeSchema", "true").parquet(*paths)


def skipped_chunks(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path) of every chunk file that gave ``union_chunks`` no row, being
    corrupt or empty (the reference logs such chunks).  The listing does not
    read the files' contents."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(list(paths)).select("path")
    read = union_chunks(spark, paths).select(F.col("_metadata.file_path").alias("path")).distinct()
    bare = F.regexp_replace("path", "^file:/+", "/")  # the two sources write local paths differently
    return listed.withColumn("path", bare).join(read.withColumn("path", bare), "path", "left_anti")


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header line (the reference's byte-order mark is not
    written; readers here ignore it either way)."""
    df.write.mode(mode).option("header", True).csv(path)


def write_report(lines: DataFrame, path: str, group: str, order: str = "line_no") -> None:
    """A10: a text report from (group, line_no, line) rows, in group then line
    order.  A range-partitioned sort keeps the order across output files."""
    lines.orderBy(group, order).select("line").write.mode("overwrite").text(path)


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """A text report as lines."""
    return spark.read.text(path).withColumnRenamed("value", "line")


def filter_report_lines(lines: DataFrame, drop: str = "Speech ID:") -> DataFrame:
    """Lines without ``drop``, stripped of surrounding whitespace."""
    return lines.filter(~F.col("line").contains(drop)).withColumn("line", tx.py_strip("line"))
