"""Star schema from silver: five dimensions, the sales fact and the product bridge."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.functions.dates import date_key
from martloom.operators.keys import with_dense_key

# Names of the dimensions, of their columns and keys.
ATTRIBUTES = {
    "DimCustomer": ["Customer_Name", "Customer_Category"],
    "DimStore": ["City", "Store_Type"],
    "DimPromotion": ["Promotion", "Discount_Applied"],
}
KEYS = {
    "DimCustomer": "Customer_Key",
    "DimStore": "Store_Key",
    "DimPromotion": "Promotion_Key",
    "DimProduct": "Product_Key",
    "DimDate": "Date_Key",
}
_CALENDAR = ["Day", "Month", "Month_Name", "Quarter", "Year"]


def dimension(silver: DataFrame, name: str) -> DataFrame:
    """Customer, store or promotion dimension: distinct attributes, null being a member of its own."""
    columns = ATTRIBUTES[name]
    return with_dense_key(silver.select(columns).distinct(), KEYS[name], columns)


def product_dimension(silver: DataFrame) -> DataFrame:
    names = silver.select(F.explode("Product_Array").alias("Product_Name")).distinct()
    return with_dense_key(names, "Product_Key", ["Product_Name"])


def timestamp_dimension(silver: DataFrame) -> DataFrame:
    """Date dimension at the grain of the source timestamp, season included in the grain."""
    columns = ["Full_Date", *_CALENDAR, "Season"]
    moments = silver.withColumn("Full_Date", F.col("Date")).select(columns).distinct()
    numbered = with_dense_key(moments, "Date_Key", ["Full_Date", "Season"])
    return numbered.select("Date_Key", *columns)


def calendar_dimension(silver: DataFrame, carried: tuple[str, ...] = ()) -> DataFrame:
    """Date dimension at day grain under a YYYYMMDD key; one row per day (and ``carried`` value) whatever its seasons."""
    day = F.to_date("Date").alias("Full_Date")
    return (
        silver.groupBy(day, *carried)
        .agg(*[F.max(c).alias(c) for c in [*_CALENDAR, "Season"]])
        .select(date_key(F.col("Full_Date")).alias("Date_Key"), "Full_Date", *_CALENDAR, "Season", *carried)
    )


def merged_calendar(parts: DataFrame) -> DataFrame:
    """The date dimension from ``calendar_dimension`` of parts of the transactions."""
    days = parts.groupBy("Date_Key", "Full_Date").agg(*[F.max(c).alias(c) for c in [*_CALENDAR, "Season"]])
    return days.select("Date_Key", "Full_Date", *_CALENDAR, "Season")


def look_up(
    df: DataFrame, dim: DataFrame, columns: dict[str, str], key: str, null_safe: bool = False
) -> DataFrame:
    """Left-join ``key`` from ``dim``; ``columns`` maps columns of ``df`` to those of ``dim``.

    Plain equality finds no key where an attribute is null; ``null_safe`` matches null with null.
    No broadcast is forced: Spark broadcasts by measured size and otherwise shuffles, splitting hot
    attribute values at run time.
    """
    keyed = dim.select(key, *[F.col(d).alias(f"_{d}") for d in columns.values()])
    tests = [
        df[s].eqNullSafe(keyed[f"_{d}"]) if null_safe else df[s] == keyed[f"_{d}"]
        for s, d in columns.items()
    ]
    joined = df.join(keyed, reduce(and_, tests), "left")
    return joined.drop(*[f"_{d}" for d in columns.values()])


def sales_fact(
    silver: DataFrame,
    dims: dict[str, DataFrame],
    null_safe: bool = False,
    by_timestamp: bool = False,
    carried: tuple[str, ...] = (),
) -> DataFrame:
    """Transaction-grain fact with four keys and two measures, and the ``carried`` columns.

    The day-grain key is computed from the date itself. ``by_timestamp`` looks it up in a
    timestamp-grain dimension instead; a moment listed under two seasons then doubles its sales.
    """
    needed = ["Transaction_ID", "Date", "Total_Items", "Total_Cost", *sum(ATTRIBUTES.values(), []), *carried]
    keyed = silver.select(needed)
    for name, columns in ATTRIBUTES.items():
        keyed = look_up(keyed, dims[name], {c: c for c in columns}, KEYS[name], null_safe)
    if by_timestamp:
        keyed = look_up(keyed, dims["DimDate"], {"Date": "Full_Date"}, "Date_Key")
    else:
        keyed = keyed.withColumn("Date_Key", date_key(F.col("Date")))
    return keyed.select(
        "Transaction_ID",
        "Date_Key",
        "Customer_Key",
        "Store_Key",
        "Promotion_Key",
        "Total_Items",
        "Total_Cost",
        *carried,
    )


def product_bridge(silver: DataFrame, products: DataFrame, carried: tuple[str, ...] = ()) -> DataFrame:
    """One row per product mention in a basket; a repeated product stays repeated."""
    mentions = silver.select("Transaction_ID", *carried, F.explode("Product_Array").alias("Product_Name"))
    keyed = look_up(mentions, products, {"Product_Name": "Product_Name"}, "Product_Key")
    return keyed.select("Transaction_ID", "Product_Key", *carried)


def dimension_builders(silver: DataFrame, by_timestamp: bool = False) -> dict[str, Callable[[], DataFrame]]:
    """The five dimensions, each built when called: numbering a dimension runs jobs of its own.

    ``silver`` should be a stored table, as every dimension reads it (its own columns only).
    """
    by_attributes = {name: partial(dimension, silver, name) for name in ATTRIBUTES}
    dates = timestamp_dimension if by_timestamp else calendar_dimension
    return {
        **by_attributes,
        "DimProduct": partial(product_dimension, silver),
        "DimDate": partial(dates, silver),
    }


def dimensions(silver: DataFrame, by_timestamp: bool = False) -> dict[str, DataFrame]:
    return {name: build() for name, build in dimension_builders(silver, by_timestamp).items()}
