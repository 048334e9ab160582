"""Customer loyalty measures."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martloom.functions.numbers import mean_money, money, ratio
from martloom.plans.star import Star, sales_by

# Label and highest order count of each retention band; the last one is open.
# The label of the last band says 10+, although ten orders still fall in the band before it.
RETENTION_BANDS = (
    ("1 (New)", 1),
    ("2-3 (Occasional)", 3),
    ("4-6 (Regular)", 6),
    ("7-10 (Loyal)", 10),
    ("10+ (VIP)", None),
)


def _band(orders):
    label = None
    for name, top in RETENTION_BANDS:
        if top is None:
            return label.otherwise(F.lit(name))
        label = F.when(orders <= top, name) if label is None else label.when(orders <= top, name)
    return label


def retention(star: Star) -> DataFrame:
    """Customers per band of order count, with their share, from fewest to most orders."""
    if star.CustomerParts is not None:
        per_customer = star.CustomerParts.groupBy("Customer_Key").agg(F.sum("orders").alias("orders"))
    else:
        per_customer = star.FactSales.groupBy("Customer_Key").agg(F.countDistinct("Transaction_ID").alias("orders"))
    bands = per_customer.groupBy(_band(F.col("orders")).alias("Customer_Segment")).agg(
        F.count("Customer_Key").alias("Num_Customers"), F.min("orders").alias("fewest")
    )
    # At most five rows reach this window.
    everyone = F.sum("Num_Customers").over(Window.partitionBy())
    return (
        bands.withColumn("Pct_Of_Total", ratio(F.col("Num_Customers"), everyone, 100.0))
        .orderBy("fewest")
        .select("Customer_Segment", "Num_Customers", "Pct_Of_Total")
    )


def _order_spans(star: Star) -> DataFrame:
    """First day, last day and number of dated orders of each customer."""
    if star.CustomerParts is not None:
        dated = star.CustomerParts.filter("dated > 0").groupBy("Customer_Key")
        return dated.agg(F.datediff(F.max("last_day"), F.min("first_day")).alias("days"), F.sum("dated").alias("orders"))
    dated = star.FactSales.select("Customer_Key", "Date_Key").join(
        star.DimDate.select("Date_Key", "Full_Date"), "Date_Key"
    )
    return dated.groupBy("Customer_Key").agg(
        F.datediff(F.max("Full_Date"), F.min("Full_Date")).alias("days"),
        F.count("Full_Date").alias("orders"),
    )


def days_between_orders(star: Star) -> DataFrame:
    """Repeat customers and the average gap between their consecutive orders.

    The gaps of one customer add up to the span from first to last order, so no per-customer ordering
    is needed and a customer with very many orders is no burden.
    """
    repeat = _order_spans(star).filter("orders > 1")
    gaps = ratio(F.sum("days"), F.sum(F.col("orders") - 1))
    return repeat.agg(
        F.count("Customer_Key").alias("Customers_With_Multiple_Orders"),
        gaps.alias("Avg_Days_Between_Orders"),
    )


def average_lifespan(star: Star) -> DataFrame:
    """Average days from first to last order."""
    return _order_spans(star).agg(
        F.first(F.lit("Avg Customer Lifespan (Days)")).alias("Metric"),
        ratio(F.sum("days"), F.count("days")).alias("Value"),
    )


def segments_by_season(star: Star) -> DataFrame:
    seasons = sales_by(star, "Season", "Customer_Category").select(
        "Season",
        "Customer_Category",
        F.col("sales").alias("Transactions"),
        money(F.col("amount")).alias("Revenue"),
        mean_money(F.col("amount"), F.col("costed")).alias("Avg_Order_Value"),
    )
    return seasons.orderBy("Season", F.desc("Revenue"), "Customer_Category")
