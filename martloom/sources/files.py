"""Folders of stored tables, reached through the session's own file system, wherever that is."""

from __future__ import annotations

import re

from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str):
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(context._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _place(spark, path)
    return system.exists(place)


def remove(spark: SparkSession, path: str) -> None:
    system, place = _place(spark, path)
    system.delete(place, True)


def _matching(spark: SparkSession, system, pattern: str) -> list[str]:
    """Paths that match: listed by the file system in one call, whereas walking it takes several calls a file."""
    jvm = spark.sparkContext._jvm
    found = system.globStatus(jvm.org.apache.hadoop.fs.Path(pattern))
    return [place.toString() for place in jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(found)] if found else []


def data_files(spark: SparkSession, path: str) -> dict[str, set[str]]:
    """Names of data files by folder, in ``path`` and the partition folders below; nothing where there is no such folder."""
    system, _ = _place(spark, path)
    found: dict[str, set[str]] = {}
    level = re.sub(r"([\\{}\[\]*?])", r"\\\1", path)
    while True:
        for file in _matching(spark, system, f"{level}/part-*"):
            folder, _, name = file.rpartition("/")
            found.setdefault(folder, set()).add(name)
        level += "/*=*"
        if not system.globStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(level)):
            return found
