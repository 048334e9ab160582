"""One registered query per operator, each over the whole of the given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harness.tables import BATCH_DATE, LATER_DATE, Tables, tables
from martloom import schemas
from martloom.operators import gold, profile, quality, silver, sketches, warehouse
from martloom.operators.keys import with_dense_key
from martloom.plans import baskets, customers, daily, sales, views
from martloom.plans.star import Star
from martloom.sources import readers, writers
from martloom.sources.staging import new_folder

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}
EARLIER = "2026-07-06"


def query(name: str):
    def keep(build: Callable[[Tables], DataFrame]):
        _QUERIES[name] = build
        return build

    return keep


# --- sources and sinks -------------------------------------------------------------------------

query("s1_csv_scan")(lambda t: readers.read_csv(t.spark, t.landing["csv"]))
@query("s2_format_dispatch")
def _(t: Tables) -> DataFrame:
    read = [readers.read_any(t.spark, path).withColumn("format", F.lit(fmt)) for fmt, path in t.landing.items()]
    return reduce(DataFrame.unionByName, read)


query("s3_batch_load")(lambda t: readers.load_daily_batch(t.spark, [t.landing["csv"], t.landing["json"]]))


@query("s4_bronze_audit")
def _(t: Tables) -> DataFrame:
    audited = readers.with_audit(t.raw(), BATCH_DATE)
    stamped = F.col("ingestion_timestamp").isNotNull().alias("has_ingestion_timestamp")
    return audited.select(*schemas.RAW_COLUMNS, "source_batch_date", stamped)


@query("s5_layer_write_csv")
def _(t: Tables) -> DataFrame:
    path = new_folder(t.spark, "s5") + ".csv"
    writers.write_layer(t.raw(), path, "csv")
    return readers.read_any(t.spark, path)


@query("s6_bronze_partition_write")
def _(t: Tables) -> DataFrame:
    """Three batches; the second is written twice and the third, written empty the second time, is gone."""
    root = new_folder(t.spark, "s6")
    for day, whole in ((EARLIER, True), (BATCH_DATE, True), (LATER_DATE, True), (BATCH_DATE, True), (LATER_DATE, False)):
        rows = t.raw() if whole else t.raw().filter("false")
        writers.write_bronze(readers.with_audit(rows, day), root, day)
    stored = t.spark.read.parquet(root).drop("ingestion_timestamp")
    return stored.withColumn("batch_date", F.col("batch_date").cast("string"))


@query("s7_array_flatten")
def _(t: Tables) -> DataFrame:
    """The whole silver table to CSV and back, its array as text."""
    path = new_folder(t.spark, "s7") + ".csv"
    flat = writers.flatten_arrays(t.silver.drop("ingestion_timestamp"))
    writers.write_layer(flat, path, "csv")
    return readers.read_csv(t.spark, path, flat.schema)


for _name in schemas.TABLES:
    query(f"s8_gold_write_{_name}")(lambda t, n=_name: t.spark.read.parquet(f"{t.gold_copy}/{n}"))


query("s9_staging_scan_typed")(lambda t: t.staged("FactSales", typed=True))
query("s9_staging_scan_text")(
    lambda t: warehouse.drop_header_rows(t.staged("FactSales", typed=False), "Transaction_ID")
)


for _name in schemas.TABLES:
    query(f"s10_warehouse_{_name}")(lambda t, n=_name: t.spark.read.parquet(f"{t.warehouse_typed[0]}/{n}"))
    query(f"s10_warehouse_text_{_name}")(lambda t, n=_name: t.spark.read.parquet(f"{t.warehouse_text[0]}/{n}"))


def _reasons(rejects: DataFrame) -> DataFrame:
    return rejects.groupBy("TableName", "reason").agg(F.count(F.lit(1)).alias("RowsCount"))


query("s10_warehouse_rejects")(lambda t: _reasons(t.warehouse_typed[1]))
query("s10_warehouse_text_rejects")(lambda t: _reasons(t.warehouse_text[1]))

# --- the daily load over two batches ------------------------------------------------------------

query("d1_daily_fact")(lambda t: t.lake_star.FactSales)
query("d1_daily_bridge")(lambda t: t.lake_star.FactProductBridge)


@query("d2_current_transactions")
def _(t: Tables) -> DataFrame:
    return _as_text(daily.current_rows(t.spark, t.lake).drop("bucket"))


@query("d3_silver_rejects")
def _(t: Tables) -> DataFrame:
    stored = t.spark.read.parquet(t.lake.rejects)
    return stored.select("Transaction_ID", "source_batch_date", F.concat_ws(",", "faults").alias("faults"))


for _name in ("DimCustomer", "DimProduct", "DimPromotion", "DimStore"):
    query(f"k1_register_{_name}")(lambda t, n=_name: t.spark.read.parquet(f"{t.lake.gold}/{n}"))
query("g3_daily_calendar")(lambda t: t.lake_star.DimDate)


@query("s10_one_month")
def _(t: Tables) -> DataFrame:
    """Days of one month, from the one folder of the fact that holds them."""
    return sales.revenue_in(t.lake_star, (F.col("Year") == 1995) & (F.col("Month") == 3), "Full_Date", "Season")


@query("p2_sketched_describe")
def _(t: Tables) -> DataFrame:
    found = sketches.summary(daily.profile_parts(t.spark, t.lake))
    return found.select("column_name", "value_count", F.round("mean_value", 2).alias("mean_value"), "min_value", "max_value")


query("p5_sketched_distinct_counts")(lambda t: sketches.distinct_counts(daily.profile_parts(t.spark, t.lake)))
query("p6_sketched_value_distribution")(lambda t: sketches.value_distribution(daily.profile_parts(t.spark, t.lake)))


# --- silver ------------------------------------------------------------------------------------


def _as_text(silver_rows: DataFrame) -> DataFrame:
    """All columns but the load time; arrays are compared as text."""
    return writers.flatten_arrays(silver_rows.drop("ingestion_timestamp"), "|")


def _raw_part(t: Tables, *columns: str) -> DataFrame:
    return t.bronze.select("Transaction_ID", *columns)


query("t1_trim")(lambda t: silver.trim_all(t.bronze.select(*schemas.RAW_COLUMNS)))
query("t2_title_case")(
    lambda t: silver.title_case(silver.trim_all(_raw_part(t, *schemas.CATEGORY_COLUMNS)))
)
query("t3_placeholder_null")(
    lambda t: silver.clean_text(_raw_part(t, *schemas.CATEGORY_COLUMNS))
)


@query("t4_multi_format_timestamp")
def _(t: Tables) -> DataFrame:
    return silver.cast_types(t.bronze).select("Transaction_ID", "Date")


@query("t5_numeric_casts")
def _(t: Tables) -> DataFrame:
    return silver.cast_types(t.bronze).select("Transaction_ID", "Total_Items", "Total_Cost")


@query("t6_boolean_flag")
def _(t: Tables) -> DataFrame:
    return silver.cast_types(t.bronze).select("Transaction_ID", "Discount_Applied")


@query("t7_date_parts")
def _(t: Tables) -> DataFrame:
    parts = silver.add_date_parts(silver.cast_types(t.bronze))
    return parts.select("Transaction_ID", "Year", "Month", "Day", "Quarter", "Month_Name")


@query("t8_basket_array")
def _(t: Tables) -> DataFrame:
    named = silver.add_products(_raw_part(t, "Product"))
    # Arrays are compared as text.
    return named.select("Transaction_ID", F.concat_ws("|", "Product_Array").alias("products"))


@query("t9_row_validation")
def _(t: Tables) -> DataFrame:
    return _as_text(silver.valid_rows(silver.shape(t.bronze)))


@query("t9_rejected_rows")
def _(t: Tables) -> DataFrame:
    rejects = silver.rejected_rows(silver.shape(t.bronze))
    return rejects.select("Transaction_ID", F.concat_ws(",", "faults").alias("faults"))


query("t10_rejection_counts")(lambda t: silver.rejection_counts(silver.shape(t.bronze)))


@query("t11_latest_per_transaction")
def _(t: Tables) -> DataFrame:
    return _as_text(silver.refine(t.bronze))


query("t12_date_diagnostic")(lambda t: silver.date_diagnostic(t.bronze))

# --- keys, dimensions, fact, bridge ------------------------------------------------------------


@query("k1_dense_key")
def _(t: Tables) -> DataFrame:
    names = t.given("customer").select("c_mktsegment", "c_name")
    return with_dense_key(names, "row_key", ["c_mktsegment", "c_name"])


query("g1_dim_customer")(lambda t: gold.dimension(t.silver, "DimCustomer"))
query("g2_dim_product")(lambda t: gold.product_dimension(t.silver))
query("g3_dim_date_timestamp")(lambda t: gold.timestamp_dimension(t.silver))
query("g3_dim_date_calendar")(lambda t: gold.calendar_dimension(t.silver))
query("g4_dim_store")(lambda t: gold.dimension(t.silver, "DimStore"))
query("g5_dim_promotion")(lambda t: gold.dimension(t.silver, "DimPromotion"))
query("g6_fact_sales")(lambda t: gold.sales_fact(t.silver, t.gold))
query("g6_fact_sales_null_safe")(lambda t: gold.sales_fact(t.silver, t.gold, null_safe=True))
query("g6_fact_sales_timestamp")(lambda t: gold.sales_fact(t.silver, t.gold, by_timestamp=True))
query("g7_product_bridge")(lambda t: gold.product_bridge(t.silver, t.gold["DimProduct"]))

# --- warehouse loads ---------------------------------------------------------------------------

_LOADS = {
    "l1_load_customer": ("DimCustomer", warehouse.load_customers, warehouse.load_customers_text),
    "l3_load_product": ("DimProduct", warehouse.load_products, warehouse.load_products_text),
    "l4_load_promotion": ("DimPromotion", warehouse.load_promotions, warehouse.load_promotions_text),
    "l5_load_store": ("DimStore", warehouse.load_stores, warehouse.load_stores_text),
    "l7_load_bridge": ("FactProductBridge", warehouse.load_bridge, warehouse.load_bridge_text),
}
for _name, (_table, _typed, _text) in _LOADS.items():
    query(_name)(lambda t, table=_table, load=_typed: load(t.staged(table, typed=True)))
    query(_name + "_text")(lambda t, table=_table, load=_text: load(t.staged(table, typed=False)))

query("l2_load_date")(lambda t: warehouse.load_calendar(t.staged("DimDate", typed=True)))
query("l2_load_date_text")(lambda t: warehouse.load_dates_text(t.staged("DimDate", typed=False)))
query("l3_load_product_cleaned")(
    lambda t: warehouse.load_products_cleaned(t.staged("DimProduct", typed=True))
)
query("l4_unknown_promotion")(
    lambda t: warehouse.with_unknown_promotion(
        warehouse.load_promotions(t.staged("DimPromotion", typed=True))
    )
)
query("l6_load_sales")(
    lambda t: warehouse.load_sales(t.staged("FactSales", True), t.staged("DimDate", True))
)
query("l6_rejected_sales")(
    lambda t: warehouse.rejected_sales(t.staged("FactSales", True), t.staged("DimDate", True))
)
query("l6_load_sales_text")(lambda t: warehouse.load_sales_text(t.staged("FactSales", typed=False)))
query("l8_header_rows")(
    lambda t: warehouse.drop_header_rows(t.staged("DimCustomer", typed=False), "Customer_Name")
)

# --- quality (null checks on the dirty batch's fact, faults on the spoiled star, the rest on the clean one) ---

query("q1_missing_values")(lambda t: quality.missing_values(t.spoiled["FactSales"], t.spoiled["DimProduct"]))
query("q2_null_percentages")(lambda t: quality.null_percentages(t.text_sales))
query("q3_duplicate_keys")(lambda t: quality.duplicate_keys(t.spoiled["DimProduct"], "Product_Key"))
query("q4_orphan_customers")(
    lambda t: quality.orphans(t.text_sales, t.gold["DimCustomer"], "Customer_Key", "Orphaned_Customers")
)
query("q5_invalid_dates")(
    lambda t: quality.orphans(t.spoiled["FactSales"], t.spoiled["DimDate"], "Date_Key", "InvalidDates")
)
query("q6_cost_outliers")(lambda t: quality.cost_outliers(t.star.FactSales))
query("q7_product_purchases")(lambda t: quality.purchases_per_product_key(t.star.FactProductBridge))
query("q8_customers_by_category")(
    lambda t: quality.members_by(t.star.DimCustomer, ["Customer_Category"], "NumCustomers")
)
query("q9_stores_by_city")(lambda t: quality.members_by(t.star.DimStore, ["City"], "NumStores"))
query("q10_promotion_usage")(
    lambda t: quality.members_by(t.star.DimPromotion, ["Promotion", "Discount_Applied"], "UsageCount")
)
query("q11_row_counts")(
    lambda t: quality.row_counts({n: getattr(t.star, n) for n in schemas.TABLES})
)
query("q12_null_keys")(lambda t: quality.null_keys(t.text_sales))
query("q13_value_ranges")(lambda t: quality.value_ranges(t.star.FactSales))
query("q14_surplus_keys")(
    lambda t: quality.surplus_keys({n: f for n, f in t.spoiled.items() if n.startswith("Dim")})
)

# --- profiles ----------------------------------------------------------------------------------

_NUMBERS = ["Total_Items", "Total_Cost"]
query("p1_shape")(lambda t: profile.shape(t.silver))
query("p2_describe")(lambda t: profile.describe(t.silver, _NUMBERS))
query("p3_quartiles")(lambda t: profile.summary(t.silver, _NUMBERS))
query("p4_null_counts")(lambda t: profile.null_counts(t.silver))
query("p5_distinct_counts")(lambda t: profile.distinct_counts(t.silver))
query("p6_value_distribution")(lambda t: profile.value_distribution(t.silver))
query("p7_date_range")(lambda t: profile.date_range(t.silver))
query("p8_basket_sizes")(lambda t: profile.basket_sizes(t.silver))
query("p9_top_products")(lambda t: profile.top_products(t.silver))
query("p10_distinct_products")(lambda t: profile.distinct_products(t.silver))
query("p11_season_summary")(lambda t: profile.season_summary(t.silver))
query("p12_city_summary")(lambda t: profile.city_summary(t.silver))
query("p13_extreme_costs")(lambda t: profile.extreme_costs(t.silver))

# --- reports -----------------------------------------------------------------------------------

def report(name: str):
    """A report on the given star, and the same on the lake from the tables that the daily load keeps."""

    def keep(build: Callable[[Star], DataFrame]):
        query(name)(lambda t: build(t.star))
        query(f"{name}_kept")(lambda t: build(t.lake_star))

    return keep


query("e1_total_revenue")(lambda t: sales.total_revenue(t.star))
query("e2_total_transactions")(lambda t: sales.total_transactions(t.star))
query("e3_average_order_value")(lambda t: sales.average_order_value(t.star))
query("e4_average_basket_size")(lambda t: sales.average_basket_size(t.star))
report("e5_revenue_by_year")(lambda s: sales.revenue_by_period(s, "Year"))
report("e6_revenue_by_quarter")(lambda s: sales.revenue_by_period(s, "Year", "Quarter"))
report("e7_revenue_by_month")(lambda s: sales.revenue_by_month(s))
report("e8_revenue_by_season")(lambda s: sales.revenue_ranking(s, "Season"))
report("e9_revenue_by_category")(lambda s: sales.revenue_ranking(s, "Customer_Category"))
report("e10_top_customers")(lambda s: sales.top_customers(s))
report("e11_segment_contribution")(lambda s: sales.segment_contribution(s))
report("e12_revenue_by_city")(lambda s: sales.revenue_ranking(s, "City"))
report("e13_revenue_by_store_type")(lambda s: sales.revenue_ranking(s, "Store_Type"))
report("e14_top_cities")(lambda s: sales.top_cities(s))
report("e15_top_store_types")(lambda s: sales.top_store_types(s))
report("e16_revenue_by_promotion")(lambda s: sales.revenue_ranking(s, "Promotion"))
report("e17_items_per_promotion")(lambda s: sales.items_per_promotion(s))
report("e18_discount_impact")(lambda s: sales.discount_impact(s))
query("e19_best_sellers")(lambda t: sales.best_sellers(t.star))
query("e20_slow_sellers")(lambda t: sales.slow_sellers(t.star))
report("e21_products_by_category")(lambda s: sales.products_by_category(s))
report("e22_product_revenue")(lambda s: sales.product_revenue(s))
report("e23_products_by_season")(lambda s: sales.products_by_season(s))
report("e24_month_over_month")(lambda s: sales.month_over_month(s))
report("e25_customer_value")(lambda s: sales.customer_value(s))
query("f8_headline_texts")(lambda t: sales.headline_texts(t.star))

report("a1_retention")(lambda s: customers.retention(s))
report("a2_days_between_orders")(lambda s: customers.days_between_orders(s))
report("a3_average_lifespan")(lambda s: customers.average_lifespan(s))
report("a4_product_pairs")(lambda s: baskets.product_pairs(s))
report("a5_segments_by_season")(lambda s: customers.segments_by_season(s))

query("w1_sales_overview")(lambda t: views.sales_overview(t.star))
report("w2_customer_analysis")(lambda s: views.customer_analysis(s))
report("w3_product_performance")(lambda s: views.product_performance(s))
report("w4_promotion_analysis")(lambda s: views.promotion_analysis(s))
report("w5_store_performance")(lambda s: views.store_performance(s))
report("w6_time_analysis")(lambda s: views.time_analysis(s))


def _bind(build: Callable[[Tables], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(tables(spark, sf_dir))


def queries() -> dict[str, Query]:
    return {name: _bind(build) for name, build in _QUERIES.items()}
