"""Exact deduplication by progressive refinement: length, then prefix hash, then full hash.

Only columns functions and joins; a text is hashed in full only where its length and the hash of its
first characters both recur.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.sources.staging import stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PREFIX_CHARS = 64


def normalised(text: Column) -> Column:
    """Lower-cases A-Z and nothing else; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def refine(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    prefix_chars: int = PREFIX_CHARS,
    hash_all: bool = False,
) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Of equal texts (equal but for the case of A-Z) the row with the largest id stays. ``text_sha256`` is the
    hash of the normalised text; it is null for rows that refinement settled without reading them in
    full, unless ``hash_all``: then it is taken in the scan, and no text goes through a join.

    Null text is an empty text. A null id loses against any other; a group of null ids alone keeps
    them all, as do rows that repeat both id and text, since nothing tells them apart (``group_size``
    counts every row). An empty table gives no rows. Other columns are never looked at.
    """
    whole = F.sha2(normalised(F.col(text_col)), 256)
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (whole if hash_all else F.col(text_col)).alias("content"),
        F.coalesce(F.octet_length(text_col), F.lit(0)).alias("size"),
        F.xxhash64(normalised(F.substring(text_col, 1, prefix_chars))).alias("prefix"),
    )
    # Levels one and two on narrow rows. A size groups few rows per value after the partial count; pairs
    # that survive are stored, so that the next join is planned by their true size.
    slim = rows.groupBy("size", "prefix").agg(F.count(F.lit(1)).alias("n"))
    sizes = slim.groupBy("size").agg(F.sum("n").alias("of_size"))
    pairs = stage(
        slim.where("n > 1").join(sizes.where("of_size > 1"), "size", "left_semi").select("size", "prefix"),
        "refine-pairs",
    ).withColumn("again", F.lit(True))
    whole = F.col("content") if hash_all else F.when(F.col("again"), F.sha2(normalised(F.col("content")), 256))
    hashed = stage(
        rows.join(pairs, ["size", "prefix"], "left").select(
            "doc_id",
            F.coalesce("again", F.lit(False)).alias("again"),
            whole.alias("text_sha256"),
        ),
        "refine-hashed",
    )
    # Level three. Counting combines on the map side, so a huge group sends one row per task; stored
    # groups leave the join below free to be split where one hash holds many rows.
    groups = stage(
        hashed.where("again")
        .groupBy("text_sha256")
        .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")),
        "refine-groups",
    )
    same = F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept")
    result = ["doc_id", "keep_id", "group_size", same, "text_sha256"]
    alone = hashed.where(~F.col("again")).withColumns({"keep_id": F.col("doc_id"), "group_size": F.lit(1).cast("long")})
    return hashed.where("again").join(groups, "text_sha256").select(*result).unionByName(alone.select(*result))
