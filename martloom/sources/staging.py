"""Intermediate tables in the cluster's shared folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

PACKED = "zstd"  # how Parquet tables are packed, whatever the session's default is
_LOCAL: dict[str, str] = {}
_STAGED: dict[str, list[str]] = {}


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder; a temporary one only where driver and executors are one process."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError("Set spark.checkpoint.dir to a folder that every executor can reach")
    application = spark.sparkContext.applicationId
    if application not in _LOCAL:
        _LOCAL[application] = tempfile.mkdtemp(prefix="martloom-")
    return _LOCAL[application]


def new_folder(spark: SparkSession, label: str) -> str:
    application = spark.sparkContext.applicationId
    path = f"{shared_folder(spark)}/martloom/{application}/{label}-{uuid.uuid4().hex}"
    _STAGED.setdefault(application, []).append(path)
    return path


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage at a stored result that survives lost executors, fixes the outcome of
    anything a recompute could order differently, and gives the optimizer true sizes to plan with.
    """
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path, compression=PACKED)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _remove(spark: SparkSession, paths: list[str]) -> None:
    context = spark.sparkContext
    for path in paths:
        place = context._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)


def release(spark: SparkSession) -> None:
    """Remove every intermediate table of this application; results that still read one must be stored first."""
    _remove(spark, _STAGED.pop(spark.sparkContext.applicationId, []))


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove at the end what was staged inside, so use it around work whose results are stored or collected.

    One thread at a time: tables that another thread stages meanwhile would go too.
    """
    known = _STAGED.setdefault(spark.sparkContext.applicationId, [])
    before = set(known)
    try:
        yield
    finally:
        mine = [p for p in known if p not in before]
        known[:] = [p for p in known if p in before]
        _remove(spark, mine)
