"""Running sums over a global order without a global task.

Rows are range-partitioned by the order columns and sorted there; the layout
is written once (``checkpoint``), so the partition number of a row stays what
it is; each partition sums its rows, the partition totals (a row for each
partition, or for each partition and group) are summed up in order, and a
row's running sum is its partition's offset plus a window inside it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rostrum.llm.common import shuffle_partitions


def running(rows: DataFrame, order: list[Column], sums: dict[str, str], group: str | None = None) -> DataFrame:
    """Add for each (new column, value column) of ``sums`` the sum of the value
    over the rows before this one in the order, within ``group`` if one is
    named (it must then be the first order column).  Rows that tie in the
    whole order get their sums in any order.  DataFrame functions only."""
    n = shuffle_partitions(rows.sparkSession)
    laid = rows.repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id()).checkpoint()
    keys = ["_part"] if group is None else ["_part", group]
    totals = laid.groupBy(*keys).agg(*(F.sum(v).alias(f"_t_{k}") for k, v in sums.items()))
    over = (Window.partitionBy(group) if group else Window.partitionBy(F.lit(0))).orderBy("_part")
    over = over.rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_part", *([F.col(group).alias("_group")] if group else []),
                            *(F.coalesce(F.sum(f"_t_{k}").over(over), F.lit(0)).alias(f"_o_{k}") for k in sums))
    same = F.col("_part") == F.col("_at")
    if group is not None:
        same = same & F.col(group).eqNullSafe(F.col("_group"))
    inner = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = laid.select("*", *(F.coalesce(F.sum(v).over(inner), F.lit(0)).alias(k) for k, v in sums.items()))
    out = out.join(offsets.withColumnRenamed("_part", "_at"), same)
    return out.select(*rows.columns, *((F.col(k) + F.col(f"_o_{k}")).alias(k) for k in sums))
