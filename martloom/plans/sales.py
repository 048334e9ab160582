"""Revenue, promotion, store and product reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.functions.numbers import display, mean_money, money, ratio
from martloom.operators.gold import KEYS
from martloom.plans.star import Star, figures, roll_up, sales_by, sums
from martloom.schemas import MONTH

def _revenue() -> Column:
    return money(F.col("amount"))


def _ranked(df: DataFrame, by: str, *names: str, ascending: bool = False) -> DataFrame:
    """Order by a figure, then by names so that equal figures keep a fixed order."""
    first = F.asc(by) if ascending else F.desc(by)
    return df.orderBy(first, *names)


# --- single figures ----------------------------------------------------------------------------


def total_revenue(star: Star) -> DataFrame:
    return star.FactSales.agg(*sums(figures())).select(_revenue().alias("Total_Revenue"))


def total_transactions(star: Star) -> DataFrame:
    return star.FactSales.agg(F.countDistinct("Transaction_ID").alias("Total_Transactions"))


def average_order_value(star: Star) -> DataFrame:
    return star.FactSales.agg(*sums(figures())).select(
        mean_money(F.col("amount"), F.col("costed")).alias("Average_Order_Value")
    )


def average_basket_size(star: Star) -> DataFrame:
    return star.FactSales.agg(*sums(figures())).select(
        ratio(F.col("items"), F.col("counted")).alias("Avg_Basket_Size")
    )


def headline_texts(star: Star) -> DataFrame:
    """The four headline figures as display text, one row each."""
    totals = star.FactSales.agg(*sums(figures()), F.countDistinct("Transaction_ID").alias("ids"))
    rows = {
        "Total Revenue": display(_revenue(), 0),
        "Total Transactions": display(F.col("ids"), 0),
        "Average Order Value": display(mean_money(F.col("amount"), F.col("costed")), 2),
        "Avg Basket Size": display(ratio(F.col("items"), F.col("counted")), 2),
    }
    pairs = [F.struct(F.lit(n).alias("Metric"), v.alias("Value")) for n, v in rows.items()]
    return totals.select(F.inline(F.array(*pairs)))


# --- revenue by attribute ----------------------------------------------------------------------


def revenue_by(star: Star, *attributes: str) -> DataFrame:
    return sales_by(star, *attributes).select(*attributes, _revenue().alias("Revenue"))


def revenue_by_period(star: Star, *attributes: str) -> DataFrame:
    """Revenue in calendar order."""
    return revenue_by(star, *attributes).orderBy(*attributes)


def revenue_by_month(star: Star) -> DataFrame:
    """Ordered by month number, which is not shown."""
    months = revenue_by(star, "Year", "Month", "Month_Name").orderBy("Year", "Month")
    return months.select("Year", "Month_Name", "Revenue")


def revenue_in(star: Star, period: Column, *attributes: str) -> DataFrame:
    """Revenue within a period, a condition on columns of DimDate, in the order of the attributes.

    Of a fact that is stored by month only months with a day of the period are read: the days meet the fact
    by month as well, so Spark prunes folders as soon as it knows the days.
    """
    days = star.DimDate.filter(period).select("Date_Key")
    if star.SalesByMonth is None:
        sold = star.FactSales.join(days, "Date_Key", "left_semi")
    else:
        by_month = days.withColumn(MONTH, F.expr("Date_Key DIV 100").cast("int"))
        sold = star.SalesByMonth.join(by_month, [MONTH, "Date_Key"], "left_semi")
    grouped = roll_up(star, sold, attributes, figures())
    return grouped.select(*attributes, _revenue().alias("Revenue")).orderBy(*attributes)


def revenue_ranking(star: Star, attribute: str) -> DataFrame:
    return _ranked(revenue_by(star, attribute), "Revenue", attribute)


def top_customers(star: Star, n: int = 10) -> DataFrame:
    spent = revenue_by(star, "Customer_Name").withColumnRenamed("Revenue", "Total_Spent")
    return _ranked(spent, "Total_Spent", "Customer_Name").limit(n)


def segment_contribution(star: Star) -> DataFrame:
    """Share of each customer category in the revenue of all of them."""
    by_segment = sales_by(star, "Customer_Category").select("Customer_Category", "amount")
    whole = by_segment.agg(money(F.sum("amount"))).scalar()
    return by_segment.select(
        "Customer_Category",
        _revenue().alias("Revenue"),
        ratio(_revenue(), whole, 100.0).alias("Contribution_Pct"),
    )


def top_cities(star: Star, n: int = 5) -> DataFrame:
    cities = sales_by(star, "City").select(
        "City", _revenue().alias("Revenue"), F.col("sales").alias("Transactions")
    )
    return _ranked(cities, "Revenue", "City").limit(n)


def top_store_types(star: Star, n: int = 5) -> DataFrame:
    types = sales_by(star, "Store_Type").select(
        "Store_Type", mean_money(F.col("amount"), F.col("costed")).alias("Avg_Transaction_Value")
    )
    return _ranked(types, "Avg_Transaction_Value", "Store_Type").limit(n)


def items_per_promotion(star: Star) -> DataFrame:
    promotions = sales_by(star, "Promotion").select(
        "Promotion", ratio(F.col("items"), F.col("counted")).alias("Avg_Items_Sold")
    )
    return _ranked(promotions, "Avg_Items_Sold", "Promotion")


def discount_impact(star: Star) -> DataFrame:
    return sales_by(star, "Discount_Applied").select(
        "Discount_Applied", _revenue().alias("Total_Revenue"), F.col("sales").alias("Trans_Count")
    )


def month_over_month(star: Star) -> DataFrame:
    """Growth against the previous month that has sales; null for the first one or a zero base."""
    # One row per month of the calendar, so the unpartitioned window stays tiny.
    months = Window.orderBy("Year", "Month")
    previous = F.lag("amount").over(months)
    return (
        sales_by(star, "Year", "Month")
        .withColumn("before", previous)
        .select(
            "Year",
            "Month",
            _revenue().alias("Revenue"),
            money(F.col("before")).alias("Prev_Month_Revenue"),
            ratio(money(F.col("amount") - F.col("before")), money(F.col("before")), 100.0).alias(
                "MoM_Growth_Pct"
            ),
        )
    )


def customer_value(star: Star) -> DataFrame:
    """Transactions and lifetime revenue per customer."""
    customers = sales_by(star, "Customer_Name", "Customer_Category").select(
        "Customer_Name",
        "Customer_Category",
        F.col("sales").alias("Total_Transactions"),
        _revenue().alias("Total_LTV"),
    )
    return _ranked(customers, "Total_LTV", "Customer_Name", "Customer_Category")


# --- products ----------------------------------------------------------------------------------


def product_counts(star: Star) -> DataFrame:
    """Bridge rows per product name."""
    mentions = {"Times_Sold": F.count("Transaction_ID")}
    return roll_up(star, star.FactProductBridge, ["Product_Name"], mentions)


def best_sellers(star: Star, n: int = 10) -> DataFrame:
    return _ranked(product_counts(star), "Times_Sold", "Product_Name").limit(n)


def slow_sellers(star: Star, n: int = 10) -> DataFrame:
    return _ranked(product_counts(star), "Times_Sold", "Product_Name", ascending=True).limit(n)


def _lines_by(star: Star, key: str) -> DataFrame:
    """Lines per key of their sale and product from kept baskets: a sale and its lines are one row there."""
    sold = star.Baskets.select(F.explode("Sales").alias("sale"), "Lines")
    lines = sold.select(F.col(f"sale.{key}").alias(key), F.col("sale.n").alias("times"), F.explode("Lines").alias("line"))
    return lines.groupBy(key, F.col("line.Product_Key").alias("Product_Key")).agg(
        F.sum(F.col("times") * F.col("line.n")).alias("lines")
    )


def _purchases(star: Star, dim: str, attribute: str, name: str) -> DataFrame:
    """Bridge rows per product name and attribute of their sale."""
    if star.Baskets is None:
        return roll_up(star, _mentions_with(star, dim, attribute), ["Product_Name"], {name: F.count("Transaction_ID")}, [attribute])
    lines = _lines_by(star, KEYS[dim])
    return roll_up(star, lines, ["Product_Name", attribute], {name: F.sum("lines")})


def _mentions_with(star: Star, dim: str, attribute: str) -> DataFrame:
    """Bridge rows with an attribute of their sale, looked up before the sale meets its bridge rows.

    Stored with buckets the join by transaction needs no shuffle; otherwise a basket with very many
    rows is split at run time.
    """
    key = KEYS[dim]
    described = getattr(star, dim).select(key, attribute)
    sale = star.FactSales.select("Transaction_ID", key).join(described, key)
    return star.FactProductBridge.join(sale.select("Transaction_ID", attribute), "Transaction_ID")


def products_by_category(star: Star) -> DataFrame:
    """Purchases per product and customer category."""
    counted = _purchases(star, "DimCustomer", "Customer_Category", "Purchases")
    return counted.select("Customer_Category", "Product_Name", "Purchases")


def products_by_season(star: Star) -> DataFrame:
    """Units per season and product."""
    units = _purchases(star, "DimDate", "Season", "Units_Sold").select("Season", "Product_Name", "Units_Sold")
    return units.orderBy("Season", F.desc("Units_Sold"), "Product_Name")


def product_revenue(star: Star) -> DataFrame:
    """Revenue per product, each sale split evenly over the rows of its basket.

    Bridge rows are first counted per transaction and product, so a transaction holding a large part
    of all rows enters the joins with no more rows than there are products.
    """
    if star.Baskets is not None:
        return _ranked(_basket_revenue(star), "Estimated_Revenue", "Product_Name")
    # The explicit filter keeps both uses of `lines` alike, so Spark shuffles it once.
    keyed = star.FactProductBridge.filter("Transaction_ID IS NOT NULL AND Product_Key IS NOT NULL")
    lines = keyed.groupBy("Transaction_ID", "Product_Key").agg(F.count(F.lit(1)).alias("n"))
    sizes = lines.groupBy("Transaction_ID").agg(F.sum("n").alias("size"))
    shares = (
        star.FactSales.select("Transaction_ID", "Total_Cost")
        .join(sizes, "Transaction_ID")
        .select("Transaction_ID", _share(F.col("Total_Cost"), F.col("size")).alias("share"))
    )
    mentions = lines.join(shares, "Transaction_ID")
    return _ranked(_earned(star, mentions, F.col("n")), "Estimated_Revenue", "Product_Name")


def _share(cost: Column, size: Column) -> Column:
    """Ten decimals hold a share exactly enough that row order cannot show in the sum."""
    return F.try_divide(cost, size.cast("double")).try_cast("decimal(28,10)")


def _earned(star: Star, mentions: DataFrame, lines: Column) -> DataFrame:
    earned = {"earned": F.sum(F.col("share") * lines.cast("decimal(10,0)"))}
    return roll_up(star, mentions, ["Product_Name"], earned).select(
        "Product_Name", F.round(F.col("earned").cast("double"), 2).alias("Estimated_Revenue")
    )


def _basket_revenue(star: Star) -> DataFrame:
    """The same from kept baskets: no row meets another by transaction."""
    known = F.filter("Lines", lambda line: line["Product_Key"].isNotNull())
    size = F.aggregate("Lines", F.lit(0).cast("long"), lambda total, line: total + line["n"])
    sold = (
        star.Baskets.withColumn("Lines", known)
        .withColumn("size", size)
        .select(F.explode("Sales").alias("sale"), "Lines", "size")
        .select(_share(F.col("sale.Total_Cost"), F.col("size")).alias("share"), "sale.n", F.explode("Lines").alias("line"))
    )
    mentions = sold.select("share", F.col("line.Product_Key").alias("Product_Key"), (F.col("n") * F.col("line.n")).alias("lines"))
    return _earned(star, mentions, F.col("lines"))
