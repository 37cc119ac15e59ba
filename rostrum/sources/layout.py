"""Input layout helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame

#: Session setting: partitions that a test table is spread over; unset, scans stay as they are.
INPUT_PARTITIONS = "spark.rostrum.inputPartitions"


def spread(df: DataFrame, key: str = "id") -> DataFrame:
    """Hash-spread a table by ``key`` when the session asks for it.  For the
    single-row-group files of the tests, which one task would read alone; a
    real table arrives in many splits and the setting stays unset."""
    n = int(df.sparkSession.conf.get(INPUT_PARTITIONS, "0"))
    return df.repartition(n, key) if n else df
