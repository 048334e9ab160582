"""Warehouse checks. Each is one pass, or a join after the fact is reduced to its keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom import schemas
from martloom.functions.numbers import exact, mean_money, ratio

def _rows() -> Column:
    return F.count(F.lit(1))


def _stack(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def missing_values(sales: DataFrame, products: DataFrame) -> DataFrame:
    no_measure = F.count_if(F.col("Total_Cost").isNull() | F.col("Total_Items").isNull())
    no_name = F.count_if(F.col("Product_Name").isNull())
    return _stack(
        [
            sales.agg(no_measure.alias("MissingCount")).withColumn("TableName", F.lit("FactSales")),
            products.agg(no_name.alias("MissingCount")).withColumn("TableName", F.lit("DimProduct")),
        ]
    ).select("TableName", "MissingCount")


def null_percentages(sales: DataFrame) -> DataFrame:
    shown = {"Customer_Key": "PctNull_Customer", "Store_Key": "PctNull_Store", "Promotion_Key": "PctNull_Promotion"}
    return sales.agg(
        *[ratio(F.count_if(F.col(k).isNull()), _rows(), 100.0).alias(name) for k, name in shown.items()]
    )


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(_rows().alias("Occurrences")).filter("Occurrences > 1")


def orphans(sales: DataFrame, dim: DataFrame, key: str, name: str) -> DataFrame:
    """Sales whose key, null included, has no dimension member; counted per key, then matched."""
    per_key = sales.groupBy(key).agg(_rows().alias("n"))
    lost = per_key.join(dim.select(key), key, "left_anti")
    return lost.agg(F.coalesce(F.sum("n"), F.lit(0)).alias(name))


def cost_outliers(sales: DataFrame, deviations: float = 3.0) -> DataFrame:
    """Sales costing more than the mean plus three sample standard deviations."""
    bound = sales.agg(
        (F.avg("Total_Cost") + F.lit(deviations) * F.stddev_samp("Total_Cost")).alias("bound")
    ).scalar()
    return sales.filter(F.col("Total_Cost") > bound)


def purchases_per_product_key(bridge: DataFrame) -> DataFrame:
    counts = bridge.groupBy("Product_Key").agg(F.count("Transaction_ID").alias("TimesPurchased"))
    return counts.orderBy(F.desc("TimesPurchased"), "Product_Key")


def members_by(dim: DataFrame, columns: list[str], name: str) -> DataFrame:
    return dim.groupBy(*columns).agg(_rows().alias(name))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return _stack(
        [t.agg(_rows().alias("RowsCount")).withColumn("TableName", F.lit(n)) for n, t in tables.items()]
    ).select("TableName", "RowsCount")


def null_keys(sales: DataFrame) -> DataFrame:
    shown = {"Customer_Key": "Null_Customer_Keys", "Store_Key": "Null_Store_Keys", "Date_Key": "Null_Date_Keys"}
    return sales.agg(*[F.count_if(F.col(k).isNull()).alias(name) for k, name in shown.items()])


def value_ranges(sales: DataFrame) -> DataFrame:
    cost, items = F.col("Total_Cost"), F.col("Total_Items")
    return sales.agg(
        F.min(cost).alias("Min_Cost"),
        F.max(cost).alias("Max_Cost"),
        mean_money(F.sum(exact(cost)), F.count(cost)).alias("Avg_Cost"),
        F.min(items).alias("Min_Items"),
        F.max(items).alias("Max_Items"),
        ratio(F.sum(items), F.count(items)).alias("Avg_Items"),
    )


def surplus_keys(dims: dict[str, DataFrame]) -> DataFrame:
    """Rows beyond one per key, for every dimension; null keys count as surplus."""
    parts = []
    for name, dim in dims.items():
        key = schemas.required(name)[0]
        surplus = (_rows() - F.countDistinct(key)).alias("Duplicates")
        parts.append(dim.agg(surplus).withColumn("TableName", F.lit(name)))
    return _stack(parts).select("TableName", "Duplicates")
