"""Tables stored by buckets of transactions, of which a load replaces only those that it touches."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.sources.files import data_files, remove
from martloom.sources.staging import PACKED

SPAN = 1 << 20
HASHED = 1024
BUCKET = "bucket"
SLOT = "slot"
SLOTS = 4
SLOT_ROWS = 1 << 15


def bucket_of(column: str, span: int = SPAN) -> Column:
    """Bucket of a transaction id: whole numbers by ranges of ``span`` ids, other texts by their hash.

    Ids that are given out in ascending order put a day's transactions into few buckets, and a correction
    of old ones touches theirs. A bucket of numbers never holds more than ``span`` transactions. Leading
    zeros do not matter, so texts that are one number later share a bucket.
    """
    number = f"try_cast(`{column}` AS bigint)"
    return F.expr(
        f"CASE WHEN {number} IS NOT NULL THEN concat('n', {number} DIV {span}) "
        f"ELSE concat('h', pmod(xxhash64(`{column}`), {HASHED})) END"
    ).alias(BUCKET)


def replace_buckets(df: DataFrame, path: str, touched: Iterable[str], *within: str, dealt: bool = False) -> None:
    """Write ``df``, which holds whole buckets, over the ``touched`` ones; no other file changes.

    ``within`` names columns that divide a bucket further. Folders of touched buckets that get no row this
    time are removed. Rows are dealt out by bucket, large ones to several tasks, unless they are ``dealt`` so
    already: read from files of one bucket each, or partitioned by it. A run that breaks off can be
    repeated: the same buckets are replaced again.
    """
    spark = df.sparkSession
    looked = {place: data_files(spark, place) for place in (f"{path}/{BUCKET}={b}" for b in touched)}
    before = {folder: names for found in looked.values() for folder, names in found.items()}
    (
        (df if dealt else df.hint("rebalance", BUCKET, *within))
        .write.partitionBy(BUCKET, *within)
        .option("partitionOverwriteMode", "dynamic")
        .mode("overwrite")
        .parquet(path, compression=PACKED)
    )
    # One look per touched bucket that held files: at most as many as the load has buckets.
    after = {folder: names for place, found in looked.items() if found for folder, names in data_files(spark, place).items()}
    for folder, names in before.items():
        if after.get(folder) == names:
            remove(spark, folder)


def by_bucket(rows: DataFrame, touched: Iterable[str] = (), slots: int = SLOTS) -> DataFrame:
    """Rows dealt out by bucket and ``slot``, a part of the transactions of each; groups of both need no shuffle.

    Where the ``touched`` buckets are named there are as many partitions as parts, so that a task sorts and gathers
    about one of them however many buckets there are: Spark's own merging of partitions goes by packed bytes, and
    rows that pack well would spill. Buckets of hashes are dealt out whole, as there may be many small ones.
    """
    slot = F.pmod(F.xxhash64(F.col("Transaction_ID").cast("string")), F.lit(slots)).alias(SLOT)
    parts = sum(slots if name.startswith("n") else 1 for name in touched)
    return rows.select("*", slot).repartition(*([parts] if parts else []), BUCKET, SLOT)


def slots_for(most: int) -> int:
    """Parts to deal a bucket out in whose rows are ``most``: small ones stay whole, and so does their file."""
    return max(1, min(SLOTS, -(-most // SLOT_ROWS)))


def write_batch_buckets(rows: DataFrame, path: str, batch_date: str) -> None:
    """Replace one batch's folder by ``rows``, dealt out by bucket; one without rows clears what it held before."""
    (
        rows.write.partitionBy(BUCKET)
        .option("partitionOverwriteMode", "static")
        .mode("overwrite")
        .parquet(f"{path}/batch_date={batch_date}", compression=PACKED)
    )
