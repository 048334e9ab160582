"""Reporting views. Dimension members without sales keep a row: counts 0, sums and averages null."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions.numbers import mean_money, money, ratio
from martloom.plans.star import Star, figures, sales_per_key, summed_again, sums

def _revenue() -> Column:
    return money(F.col("amount"))


def _count(name: str):
    return F.coalesce(F.col(name), F.lit(0))


def sales_overview(star: Star) -> DataFrame:
    """Sales with date, customer and store spelled out (inner joins)."""
    return (
        star.FactSales.join(star.DimDate.select("Date_Key", "Full_Date"), "Date_Key")
        .join(star.DimCustomer.select("Customer_Key", "Customer_Name"), "Customer_Key")
        .join(star.DimStore.select("Store_Key", "City", "Store_Type"), "Store_Key")
        .select(
            "Transaction_ID",
            "Full_Date",
            "Customer_Name",
            "City",
            "Store_Type",
            "Total_Items",
            "Total_Cost",
        )
    )


def customer_analysis(star: Star) -> DataFrame:
    if star.CustomerParts is not None:
        sales = star.CustomerParts.groupBy("Customer_Key").agg(*sums(summed_again()), F.sum("orders").alias("ids"))
    else:
        sales = star.FactSales.groupBy("Customer_Key").agg(
            *sums(figures()), F.countDistinct("Transaction_ID").alias("ids")
        )
    return star.DimCustomer.join(sales, "Customer_Key", "left").select(
        "Customer_Key",
        "Customer_Name",
        "Customer_Category",
        _count("ids").alias("Total_Transactions"),
        _revenue().alias("Lifetime_Value"),
        mean_money(F.col("amount"), F.col("costed")).alias("Average_Order_Value"),
    )


def product_performance(star: Star) -> DataFrame:
    if star.Baskets is not None:
        sold = star.Baskets.select(F.explode_outer("Sales").alias("sale"), "Lines")
        lines = sold.select("sale", F.explode("Lines").alias("line")).select(
            F.col("line.Product_Key").alias("Product_Key"),
            F.col("sale.Customer_Key").alias("Customer_Key"),
            (F.col("line.n") * F.coalesce("sale.n", F.lit(1))).alias("lines"),
        )
        mentions = F.sum("lines")
    else:
        buyers = star.FactSales.select("Transaction_ID", "Customer_Key")
        lines = star.FactProductBridge.join(buyers, "Transaction_ID", "left")
        mentions = F.count("Transaction_ID")
    bought = lines.groupBy("Product_Key").agg(
        mentions.alias("mentions"), F.countDistinct("Customer_Key").alias("buyers")
    )
    return star.DimProduct.join(bought, "Product_Key", "left").select(
        "Product_Key",
        "Product_Name",
        _count("mentions").alias("Total_Times_Purchased"),
        _count("buyers").alias("Unique_Customers_Bought"),
    )


def promotion_analysis(star: Star) -> DataFrame:
    used = sales_per_key(star, "Promotion_Key")
    return star.DimPromotion.join(used, "Promotion_Key", "left").select(
        "Promotion_Key",
        "Promotion",
        "Discount_Applied",
        _count("sales").alias("Times_Used"),
        _revenue().alias("Generated_Revenue"),
    )


def store_performance(star: Star) -> DataFrame:
    sold = sales_per_key(star, "Store_Key")
    return star.DimStore.join(sold, "Store_Key", "left").select(
        "Store_Key",
        "City",
        "Store_Type",
        _revenue().alias("Total_Revenue"),
        _count("sales").alias("Transaction_Count"),
        ratio(F.col("items"), F.col("counted")).alias("Avg_Basket_Size"),
    )


def time_analysis(star: Star) -> DataFrame:
    """Revenue and transactions per day, joined on the key and grouped by the shown columns."""
    columns = ["Full_Date", "Year", "Quarter", "Month_Name", "Season"]
    daily = star.DimDate.join(sales_per_key(star, "Date_Key"), "Date_Key", "left")
    return (
        daily.groupBy(*columns)
        .agg(F.sum("amount").alias("amount"), F.sum("sales").alias("sales"))
        .select(
            *columns, _revenue().alias("Daily_Revenue"), _count("sales").alias("Daily_Transactions")
        )
    )


VIEWS: dict[str, Callable[[Star], DataFrame]] = {
    "vw_SalesOverview": sales_overview,
    "vw_CustomerAnalysis": customer_analysis,
    "vw_ProductPerformance": product_performance,
    "vw_PromotionAnalysis": promotion_analysis,
    "vw_StorePerformance": store_performance,
    "vw_TimeAnalysis": time_analysis,
}


def register_views(star: Star) -> None:
    """Tables and the six reporting views as temporary views of the session."""
    star.register()
    for name, build in VIEWS.items():
        build(star).createOrReplaceTempView(name)
