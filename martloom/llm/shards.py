"""Shards as leaves of a k-d tree over document metadata, split at weighted medians."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.sources.staging import stage

SHARDS = 24
OVERHEAD = 8
_AT_BITS = 33  # row position bits of monotonically_increasing_id


def _running(df: DataFrame, node: str, order: list[Column], weight: Column, label: str) -> DataFrame:
    """Add ``_before``, the weight of earlier rows of the same node, and ``_total``, the node's weight.

    Rows are range-partitioned and sorted locally; a partition's sums per node and those of the
    partitions before it make the rest. No node is gathered in one task, whatever it weighs.
    """
    placed = stage(
        df.repartitionByRange(F.col(node), *order)
        .sortWithinPartitions(F.col(node), *order)
        .withColumn("_at", F.monotonically_increasing_id()),
        label,
    ).withColumn("_part", F.shiftright("_at", _AT_BITS))
    # One row per range partition and node in it: bounded by the number of partitions plus nodes.
    sums = placed.groupBy("_part", node).agg(F.sum(weight).alias("_sum"))
    earlier = Window.partitionBy(node).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        "_part",
        node,
        F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_start"),
        F.sum("_sum").over(Window.partitionBy(node)).alias("_total"),
    )
    local = Window.partitionBy("_part", node).orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    within = F.coalesce(F.sum(weight).over(local), F.lit(0))
    return (
        placed.withColumn("_within", within)
        .join(F.broadcast(starts), ["_part", node])
        .withColumn("_before", F.col("_start") + F.col("_within"))
        .drop("_start", "_within", "_at", "_part")
    )


def kd_shards(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    dimensions: tuple[str, ...] = ("n_chars", "lang", "source"),
    shards: int = SHARDS,
) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot``: one row per input row, shards of nearly equal bytes.

    A node that is to become k shards is split at the weighted median (for odd k, the quantile) of its widest
    dimension, ties by id and checksum, until k is 1. Text dimensions count by the rank of their value's
    hash range: a value is placed by its hash. Width is the range in the node over the range in all data. Weights are
    bytes, so a leaf is off by at most about one document per level. ``slot`` numbers a shard's rows from 0.

    Null texts have no bytes, null metadata come first. Rows that repeat id and text count each on their own;
    which of them gets which slot is open. An empty table gives no rows. A text is never cut, so a very long one
    makes its shard that much larger. Equal texts have equal checksums; they may lie in different shards.
    """
    text = F.col(text_col)
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + OVERHEAD
    kinds = {f.name: f.dataType.typeName() for f in docs.schema.fields}

    def coordinate(name: str) -> Column:
        value = F.col(name)
        if kinds[name] in ("string", "boolean", "binary"):
            # Hash range halved twice over, so that its width fits a double exactly.
            value = F.when(value.isNotNull(), F.shiftright(F.xxhash64(value), 12))
        return F.coalesce(value.cast("double"), F.lit(float("-inf")))

    axes = [f"_x{i}" for i in range(len(dimensions))]
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        size.alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        *(coordinate(d).alias(a) for d, a in zip(dimensions, axes)),
        F.lit(0).alias("_node"),
        F.lit(shards).alias("_k"),
    )
    tree = stage(rows, "shards-rows")

    def spans(df: DataFrame) -> list[Column]:
        finite = lambda a: F.when(F.col(a) > float("-inf"), F.col(a))
        return [F.coalesce(F.max(finite(a)) - F.min(finite(a)), F.lit(0.0)).alias(a) for a in axes]

    whole = tree.agg(*spans(tree)).first()
    while (widest := tree.where("_k > 1").groupBy("_node").agg(*spans(tree)).limit(shards).collect()):
        # One row per node, at most ``shards`` of them.
        axis = F.lit(0)
        for node in widest:
            widths = [(node[a] / whole[a] if whole[a] else 0.0) for a in axes]
            axis = F.when(F.col("_node") == node["_node"], widths.index(max(widths))).otherwise(axis)
        at = F.element_at(F.array(*axes), axis + 1)
        splitting = tree.where("_k > 1").withColumn("_c", at)
        order = [F.col("_c"), F.col("doc_id"), F.col("text_crc32")]
        left_k = F.ceil(F.col("_k") / 2).cast("int")
        middle = F.col("_before") + F.col("size") / 2
        left = middle * F.col("_k") < F.col("_total") * left_k
        split = (
            _running(splitting, "_node", order, F.col("size"), "shards-split")
            .withColumn("_left", left)
            .withColumns(
                {
                    # A node is named by its first shard.
                    "_node": F.when(F.col("_left"), F.col("_node")).otherwise(F.col("_node") + left_k),
                    "_k": F.when(F.col("_left"), left_k).otherwise(F.col("_k") - left_k),
                }
            )
            .select(*tree.columns)
        )
        tree = stage(split.unionByName(tree.where("_k = 1")), "shards-level")
    numbered = _running(tree, "_node", [F.col("doc_id"), F.col("text_crc32")], F.lit(1).cast("long"), "shards-slots")
    return numbered.select("doc_id", "size", "text_crc32", F.col("_node").alias("shard"), F.col("_before").alias("slot"))
