"""Dense surrogate keys without a single-partition sort."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martloom.sources.staging import stage

_ROW_BITS = 33  # row position bits of monotonically_increasing_id


def with_dense_key(df: DataFrame, key: str, order_by: list[str], key_type: str = "int") -> DataFrame:
    """Number rows 1..N in ``order_by`` order (nulls first), as a global ``row_number`` would.

    Rows are range-partitioned and sorted locally, their (partition, position) pair is stored with
    them, and the key is that position plus the row count of all earlier partitions. The stored copy
    matters: range bounds come from a sample, so a recompute could place rows differently. Rows
    should be distinct in ``order_by``; equal values would share one range partition.
    """
    placed = stage(
        df.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .withColumn("_at", F.monotonically_increasing_id()),
        key,
    ).withColumn("_part", F.shiftright("_at", _ROW_BITS))
    before = F.sum("_rows").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    # One row per range partition: bounded by the shuffle partition count, not by the data.
    starts = (
        placed.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    )
    position = F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    numbered = (F.col("_before") + position + 1).cast(key_type).alias(key)
    return placed.join(F.broadcast(starts), "_part").select(numbered, *df.columns)
