"""Tables kept beside the warehouse, each a fold of its facts by buckets of transactions.

A load replaces the buckets that it touches, so late, corrected and withdrawn transactions are never
subtracted from anything: what a bucket holds always follows from the facts stored in it.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from martloom import schemas
from martloom.operators.buckets import BUCKET, SLOT, by_bucket, replace_buckets
from martloom.plans.sizes import broadcast_by_size
from martloom.plans.star import figures, sums
from martloom.sources.writers import write_each


def day_sums(sales: DataFrame, customers: DataFrame) -> DataFrame:
    """Additive figures per day, store, promotion and customer category.

    The category is kept as the smallest key among its customers, which registers never change, so dimensions
    are met by their keys as in the fact.
    """
    first = customers.groupBy("Customer_Category").agg(F.min("Customer_Key").alias("first"))
    same = first["Customer_Category"].eqNullSafe(customers["Customer_Category"])
    keyed = customers.join(first, same).select("Customer_Key", "first")
    keys = ["Date_Key", "Store_Key", "Promotion_Key", BUCKET]
    if broadcast_by_size(customers):  # a join's own size is guessed too large, and this one is no larger
        looked_up = sales.join(F.broadcast(keyed), "Customer_Key", "left").drop("Customer_Key")
        return (
            looked_up.withColumnRenamed("first", "Customer_Key")
            .repartition(BUCKET)
            .groupBy("Customer_Key", *keys)
            .agg(*sums(figures()))
        )
    # Days, stores and promotions of one customer first: a customer with very many sales is few rows in the join.
    per_customer = sales.groupBy("Customer_Key", *keys).agg(*sums(figures()))
    summed = [F.sum(n).alias(n) for n in figures()]
    return (
        per_customer.join(keyed, "Customer_Key", "left")
        .repartition(BUCKET)
        .groupBy(F.col("first").alias("Customer_Key"), *keys)
        .agg(*summed)
    )


def customer_parts(sales: DataFrame, calendar: DataFrame) -> DataFrame:
    """Per customer first and last day, dated sales, distinct transactions and additive figures.

    Copies of a transaction share its bucket, so distinct ones add up over buckets.
    """
    days = calendar.select("Date_Key", "Full_Date")
    return (
        sales.join(days, "Date_Key", "left")
        .repartition(BUCKET)
        .groupBy(BUCKET, "Customer_Key")
        .agg(
            F.min("Full_Date").alias("first_day"),
            F.max("Full_Date").alias("last_day"),
            F.count("Full_Date").alias("dated"),
            F.count_distinct("Transaction_ID").alias("orders"),
            *sums(figures()),
        )
    )


def baskets(
    sales: DataFrame, bridge: DataFrame, carried: tuple[str, ...] = (), touched: Iterable[str] = ()
) -> DataFrame:
    """One row per transaction: its sales, and its products with the number of their lines.

    Equal sales and equal lines are counted before they are gathered, so an array is no longer than there are
    products, whatever a transaction holds. Sales without lines and lines without a sale keep their row.
    ``touched`` names the buckets that the rows are of, see :func:`by_bucket`.
    """
    key = ["Transaction_ID", *carried]
    sale = F.struct("Date_Key", "Customer_Key", "Total_Cost")
    line = F.struct("Product_Key")

    def side(rows: DataFrame, name: str, cell: Column, other: str, nothing: str) -> DataFrame:
        # What has no id belongs to nothing on the other side.
        apart = F.when(F.col("Transaction_ID").isNull(), F.lit(name)).alias("apart")
        return rows.select(*key, apart, cell.alias(name), F.lit(None).cast(nothing).alias(other))

    kinds = [rows.select(cell.alias("c")).schema["c"].dataType.simpleString() for rows, cell in ((sales, sale), (bridge, line))]
    both = side(sales, "sale", sale, "line", kinds[1]).unionByName(side(bridge, "line", line, "sale", kinds[0]))
    within = []
    if BUCKET in carried:
        # A bucket has no more transactions than its span, and the lines of one come from one cell: neither is
        # ever so many that one task must not read them, so both sides are dealt out once and together.
        both, within = by_bucket(both, touched), [SLOT]
    counted = both.groupBy(*key, *within, "apart", "sale", "line").agg(F.count(F.lit(1)).alias("n"))
    sold = F.when(F.col("sale").isNotNull(), F.struct("sale.Date_Key", "sale.Customer_Key", "sale.Total_Cost", "n"))
    listed = F.when(F.col("line").isNotNull(), F.struct("line.Product_Key", "n"))
    gathered = counted.groupBy(*key, *within, "apart").agg(
        F.array_sort(F.collect_list(sold)).alias("Sales"), F.array_sort(F.collect_list(listed)).alias("Lines")
    )
    return gathered.select(*key, "Sales", "Lines")


def replace(spark: SparkSession, root: str, buckets: list[str]) -> None:
    """Fold the given buckets of the stored facts again."""

    def fact(name: str) -> DataFrame:
        declared = schemas.stored(name).add(BUCKET, "string")
        rows = spark.read.schema(declared).parquet(f"{root}/{name}")
        return rows.select(*declared.names).filter(F.col(BUCKET).isin(buckets))

    sales, bridge = fact("FactSales"), fact("FactProductBridge")
    tables = {
        "DailySums": day_sums(sales, spark.read.parquet(f"{root}/DimCustomer")),
        "CustomerParts": customer_parts(sales, spark.read.parquet(f"{root}/DimDate")),
        "Baskets": baskets(sales, bridge, (BUCKET,), buckets),
    }

    def write(name: str, rows: DataFrame) -> None:
        typed = rows.to(StructType.fromDDL(schemas.KEPT[name]))
        replace_buckets(typed, f"{root}/{name}", buckets, dealt=True)

    write_each(tables, write)
