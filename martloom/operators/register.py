"""Registers of dimension members: a member keeps the key that it got when it first came."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.operators.keys import with_dense_key
from martloom.sources.files import exists
from martloom.sources.staging import stage


def unknown_members(members: DataFrame, register: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct ``members`` that the register lacks; null is a value as any other."""
    known = register.select([F.col(c).alias(f"_{c}") for c in columns])
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in columns])
    return members.select(columns).distinct().join(known, same, "left_anti")


def enrol(members: DataFrame, register: DataFrame | None, key: str, columns: list[str]) -> DataFrame:
    """New members with keys above all that were given out, dense and in the order of their attributes."""
    if register is None:
        return with_dense_key(members.select(columns).distinct(), key, columns)
    highest = register.agg(F.max(key)).first()[0] or 0  # one number
    numbered = with_dense_key(unknown_members(members, register, columns), key, columns, "long")
    return numbered.withColumn(key, (F.col(key) + F.lit(highest)).cast("int"))


def grow(members: DataFrame, path: str, key: str, columns: list[str]) -> DataFrame:
    """Append what is new in ``members`` to the register stored at ``path``; returns the register.

    Keys never change and members never leave, so facts of other days stay right. A run that breaks off
    while appending can be repeated: members that got in are known by then.
    """
    spark = members.sparkSession
    register = spark.read.parquet(path) if exists(spark, path) else None
    new = stage(enrol(members, register, key, columns), "enrolled")
    if register is None or not new.isEmpty():
        new.write.mode("append").parquet(path)
    return spark.read.parquet(path)
