"""Session preparation, table reading and small expressions of this package."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rostrum.session import ensure_checkpoint_dir, ship_code

#: Rows of one Arrow batch handed to Python: bounds a worker's memory by this many texts.
ARROW_ROWS = 500
ARROW_BYTES = 32 << 20

#: A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def prepare(spark: SparkSession) -> SparkSession:
    """Ship the package to executors, take the shared checkpoint folder from
    the session, bound the Arrow batches."""
    ship_code(spark)
    ensure_checkpoint_dir(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name in the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """True where crc32 of the id's decimal text leaves ``remainder``; a null
    id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus == remainder


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def column_lists(batches: Iterator, *names: str) -> Iterator[tuple]:
    """Each Arrow batch with the named columns as Python lists."""
    for b in batches:
        yield (b, *(b.column(b.schema.get_field_index(n)).to_pylist() for n in names))


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Where the public vocabulary file is, the same place on every machine."""
    import public_tokenizers

    return str(public_tokenizers.path(name))
