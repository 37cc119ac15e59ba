"""Corpus pipeline: raw documents to packed training sequences.

Each stage takes the documents that its predecessor kept and calls one
operator of ``rostrum.llm``: documents without a recognisable language go,
toxic documents go, one document of each group of near duplicates stays, the
sources are mixed to their targets (copies and a cut document are rows of
their own), and the mix is packed into sequences.  All stages but the last
return the columns of ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rostrum.llm import language_id, mixing, packing, simhash, toxicity
from rostrum.llm.common import prepare, scratch, table, tokenizer_path


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return language_id.keep_identified(docs)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return simhash.keep_first(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("language_id", identify_language),
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Learned models and tokenizers are not expressible in SQL; tests/llm compares run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written as Parquet
    in the shared checkpoint folder and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    base = scratch(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
