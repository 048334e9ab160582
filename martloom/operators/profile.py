"""Column profiles of the silver table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.functions.numbers import exact, mean_money, money
from martloom.sources.staging import stage

# The columns profiled by distinct values.
CATEGORICAL = ("Customer_Category", "City", "Store_Type", "Payment_Method", "Season", "Promotion")
QUARTILES = (0.25, 0.5, 0.75)

def _rows() -> Column:
    return F.count(F.lit(1))


def _stacked(df: DataFrame, columns: tuple[str, ...] | list[str], name: str, value: Column) -> DataFrame:
    """One aggregate row turned into one row per column."""
    pairs = [F.struct(F.lit(c).alias(name), F.col(c).alias("value")) for c in columns]
    return df.select(F.inline(F.array(*pairs))).select(name, value)


def shape(df: DataFrame) -> DataFrame:
    return df.agg(_rows().alias("row_count")).withColumn("column_count", F.lit(len(df.columns)))


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, sample deviation, minimum and maximum per numeric column, as numbers."""

    def stats(c: str) -> Column:
        x = F.col(c).cast("double")
        return F.struct(
            F.lit(c).alias("column_name"),
            F.count(c).alias("value_count"),
            F.round(F.avg(x), 4).alias("mean_value"),
            F.round(F.stddev_samp(x), 4).alias("stddev_value"),
            F.min(x).alias("min_value"),
            F.max(x).alias("max_value"),
        )

    return df.agg(F.array(*[stats(c) for c in columns]).alias("s")).select(F.inline("s"))


def exact_quantiles(df: DataFrame, columns: list[str], shares: tuple[float, ...] = QUARTILES) -> DataFrame:
    """Smallest value of each column reached by each share of its rows, exact at any size.

    Equal values are first counted together, so a value held by a third of all rows is one row. The
    counted values are range-partitioned; per-partition totals tell which partition holds a wanted
    rank, and only those partitions are walked through.
    """
    cells = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("value")) for c in columns]
    counted = (
        df.select(F.inline(F.array(*cells)))
        .filter("value IS NOT NULL")
        .groupBy("column_name", "value")
        .agg(_rows().alias("n"))
    )
    placed = stage(
        counted.repartitionByRange("column_name", "value").withColumn("part", F.spark_partition_id()),
        "quantiles",
    )
    own = Window.partitionBy("column_name")
    upto = own.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # Per column one row per range partition: bounded by the shuffle partition count.
    parts = (
        placed.groupBy("column_name", "part")
        .agg(F.sum("n").alias("held"))
        .withColumn("before", F.coalesce(F.sum("held").over(upto), F.lit(0)))
        .withColumn("total", F.sum("held").over(own))
    )
    rank = F.greatest(F.ceil(F.col("share") * F.col("total")), F.lit(1))
    wanted = (
        parts.select("*", F.explode(F.array(*[F.lit(float(s)) for s in shares])).alias("share"))
        .withColumn("rank", rank)
        .filter("rank > before AND rank <= before + held")
        .select("column_name", "part", "share", (F.col("rank") - F.col("before")).alias("local_rank"))
    )
    running = F.sum("n").over(
        Window.partitionBy("column_name", "part")
        .orderBy("value")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    place = ["column_name", "part"]
    walked = placed.join(F.broadcast(wanted.select(place).distinct()), place, "left_semi")
    hits = walked.withColumn("upto", running).join(F.broadcast(wanted), place)
    return hits.filter("local_rank > upto - n AND local_rank <= upto").select("column_name", "share", "value")


def summary(df: DataFrame, columns: list[str], exact: bool = True) -> DataFrame:
    """Describe figures plus quartiles; ``exact=False`` takes them from a one-pass sketch."""
    names = {s: f"p{int(s * 100)}" for s in QUARTILES}
    if exact:
        picked = [F.max(F.when(F.col("share") == s, F.col("value"))).alias(n) for s, n in names.items()]
        quartiles = exact_quantiles(df, columns).groupBy("column_name").agg(*picked)
    else:
        sketches = [
            F.struct(
                F.lit(c).alias("column_name"),
                *[F.percentile_approx(F.col(c).cast("double"), s).alias(n) for s, n in names.items()],
            )
            for c in columns
        ]
        quartiles = df.agg(F.array(*sketches).alias("s")).select(F.inline("s"))
    return describe(df, columns).join(quartiles, "column_name", "left")


def null_counts(df: DataFrame) -> DataFrame:
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return _stacked(counted, df.columns, "column_name", F.col("value").alias("null_count"))


def distinct_counts(
    df: DataFrame, columns: tuple[str, ...] = CATEGORICAL, approximate: bool = False
) -> DataFrame:
    """Distinct values per column, null counting as one."""

    def distinct(c: str) -> Column:
        values = F.approx_count_distinct(c) if approximate else F.countDistinct(c)
        return (values + F.max(F.col(c).isNull().cast("int"))).cast("bigint").alias(c)

    counted = df.agg(*[distinct(c) for c in columns])
    return _stacked(counted, columns, "column_name", F.col("value").alias("distinct_count"))


def value_distribution(df: DataFrame, columns: tuple[str, ...] = CATEGORICAL, top: int = 10) -> DataFrame:
    """The most frequent values of each column, null being one of them."""
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("column_value")) for c in columns]
    counted = (
        df.select(F.inline(F.array(*pairs))).groupBy("column_name", "column_value").agg(_rows().alias("value_count"))
    )
    place = F.row_number().over(
        Window.partitionBy("column_name").orderBy(F.desc("value_count"), F.asc_nulls_first("column_value"))
    )
    # Spark cuts each partition to `top` rows per column before the shuffle of this ranking.
    return counted.withColumn("place", place).filter(F.col("place") <= top)


def date_range(df: DataFrame) -> DataFrame:
    return df.agg(F.min("Date").alias("earliest_date"), F.max("Date").alias("latest_date"))


def basket_sizes(df: DataFrame) -> DataFrame:
    return describe(df.select(F.size("Product_Array").alias("num_products")), ["num_products"])


def _products(df: DataFrame) -> DataFrame:
    return df.select(F.explode("Product_Array").alias("Product_Name"))


def top_products(df: DataFrame, n: int = 20) -> DataFrame:
    counted = _products(df).groupBy("Product_Name").agg(_rows().alias("times_listed"))
    return counted.orderBy(F.desc("times_listed"), "Product_Name").limit(n)


def distinct_products(df: DataFrame) -> DataFrame:
    return _products(df).agg(F.countDistinct("Product_Name").alias("distinct_products"))


def _sales_stats(df: DataFrame, column: str) -> DataFrame:
    total, counted = F.sum(exact(F.col("Total_Cost"))), F.count("Total_Cost")
    return df.groupBy(column).agg(
        _rows().alias("sale_count"),
        mean_money(total, counted).alias("average_cost"),
        money(total).alias("total_cost"),
    )


def season_summary(df: DataFrame) -> DataFrame:
    return _sales_stats(df, "Season").orderBy(F.desc("total_cost"), "Season")


def city_summary(df: DataFrame, n: int = 10) -> DataFrame:
    cities = _sales_stats(df, "City").drop("total_cost")
    return cities.orderBy(F.desc("sale_count"), "City").limit(n)


def extreme_costs(df: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` dearest and ``n`` cheapest sales."""
    sales = df.select("Transaction_ID", "Total_Cost", "Total_Items")
    dearest = sales.orderBy(F.desc("Total_Cost"), "Transaction_ID").limit(n)
    cheapest = sales.orderBy("Total_Cost", "Transaction_ID").limit(n)
    return dearest.withColumn("extreme", F.lit("highest")).unionByName(
        cheapest.withColumn("extreme", F.lit("lowest"))
    )
