import os

import pytest
from helpers import rows
from pyspark.sql import functions as F

from harness.tables import tables
from martloom import schemas
from martloom.operators import buckets
from martloom.plans import baskets, customers, daily, sales, views
from martloom.plans.star import Star
from martloom.sources import files, writers

GIVEN = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    paths = [tables(spark, GIVEN).landing["csv"]]
    root = str(tmp_path_factory.mktemp("lake"))
    star, counts = daily.run_daily(spark, root, paths, "2024-01-01")
    return root, paths, star, counts


def test_layers_add_up(spark, loaded):
    root, _, star, counts = loaded
    layers = daily.Layers(root)
    assert counts["read"] - counts["dropped"] >= counts["Silver"] == counts["FactSales"]
    rejected = spark.read.parquet(f"{layers.warehouse}_rejects").filter("TableName = 'FactSales'").count()
    assert counts["dropped"] == spark.read.parquet(layers.rejects).count() > 0
    assert star.FactSales.count() + rejected == counts["FactSales"]
    keys = rows(star.DimCustomer.agg(F.min("Customer_Key"), F.max("Customer_Key"), F.count("*")))
    assert keys == [(1, counts["DimCustomer"], counts["DimCustomer"])]
    spread = star.FactProductBridge.join(star.FactSales, "Transaction_ID", "left_semi").select("Transaction_ID").distinct()
    assert spread.count() == star.FactSales.count()


def test_second_run_changes_nothing(spark, loaded):
    root, paths, star, counts = loaded
    before = sorted(rows(sales.customer_value(star)), key=str)
    again, counts_again = daily.run_daily(spark, root, paths, "2024-01-01")
    assert counts_again == counts
    assert sorted(rows(sales.customer_value(again)), key=str) == before


def test_bucketed_tables_join_without_a_shuffle(spark, loaded, tmp_path):
    star = Star.stored(spark, daily.Layers(loaded[0]).warehouse)
    spark.sql("CREATE DATABASE IF NOT EXISTS bucketed")
    facts = {n: getattr(star, n) for n in ("FactSales", "FactProductBridge")}
    writers.write_warehouse(facts, str(tmp_path), buckets=4, database="bucketed")
    sale, line = spark.table("bucketed.FactSales"), spark.table("bucketed.FactProductBridge")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = line.join(sale.select("Transaction_ID", "Customer_Key"), "Transaction_ID")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        rest = {n: getattr(star, n) for n in ("DimCustomer", "DimDate", "DimProduct", "DimPromotion", "DimStore")}
        stored = Star(FactSales=sale, FactProductBridge=line, **rest)
        assert sorted(rows(views.product_performance(stored))) == sorted(rows(views.product_performance(star)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP DATABASE bucketed CASCADE")


def test_unknown_promotion_member_keeps_all_sales(spark, loaded, tmp_path):
    root = loaded[0]
    layers = daily.Layers(root)
    writers.write_layer(spark.read.parquet(layers.current), f"{tmp_path}/silver/current")
    other = daily.Layers(str(tmp_path))
    daily.model(spark, other, null_safe=False)
    star = daily.store(spark, other, unknown_promotion=True)
    total = rows(sales.total_revenue(star))[0][0]
    by_promotion = rows(sales.revenue_ranking(star, "Promotion").agg(F.sum("Revenue")))[0][0]
    assert by_promotion == pytest.approx(total)
    assert star.FactSales.filter("Promotion_Key = -1").count() > 0


def write_files(spark, tmp_path, raw_row, name, *cells):
    path = f"{tmp_path}/{name}.csv"
    writers.write_layer(spark.createDataFrame([raw_row(**c) for c in cells], schemas.RAW), path, "csv")
    return [path]


def test_a_moment_under_two_seasons_counts_its_sales_once(spark, tmp_path, raw_row):
    paths = write_files(spark, tmp_path, raw_row, "a", {}, {"Transaction_ID": "2", "Season": "winter"})
    star, counts = daily.run_daily(spark, f"{tmp_path}/day", paths, "2024-01-01")
    assert counts["FactSales"] == counts["Silver"] == 2
    assert rows(sales.total_revenue(star)) == [(25.0,)]
    doubled, _ = daily.run_daily(spark, f"{tmp_path}/moment", paths, "2024-01-01", by_timestamp=True)
    assert doubled.FactSales.count() == 4


def test_batches_add_up_and_are_replaced_one_by_one(spark, tmp_path, raw_row):
    root, layers = f"{tmp_path}/lake", daily.Layers(f"{tmp_path}/lake")
    first = write_files(spark, tmp_path, raw_row, "a", {}, {"Transaction_ID": "2"}, {"Transaction_ID": "8", "Total_Cost": "1e300"})
    second = write_files(spark, tmp_path, raw_row, "b", {"City": "rome"}, {"Transaction_ID": "3", "Total_Cost": "0.004"})
    spark.createDataFrame([], schemas.RAW).write.json(f"{tmp_path}/none.json")

    def cities(paths, day):
        daily.run_daily(spark, root, paths, day)
        return sorted(rows(spark.read.parquet(layers.current).select("Transaction_ID", "City")))

    assert cities(first, "2024-01-01") == [("1", "Oslo"), ("2", "Oslo")]
    assert cities(second, "2024-01-02") == [("1", "Rome"), ("2", "Oslo"), ("3", "Oslo")]
    assert cities(first, "2024-01-01") == [("1", "Rome"), ("2", "Oslo"), ("3", "Oslo")]
    assert rows(sales.total_revenue(Star.stored(spark, layers.warehouse))) == [(25.004,)]
    faults = spark.read.parquet(layers.rejects).selectExpr("Transaction_ID", "faults[0]")
    assert rows(faults) == [("8", "cost_out_of_range")]
    assert cities([f"{tmp_path}/none.json"], "2024-01-02") == [("1", "Oslo"), ("2", "Oslo")]


def stored_files(spark, path):
    return {f"{folder.split(':', 1)[-1]}/{n}" for folder, names in files.data_files(spark, path).items() for n in names}


def times(paths):
    return {p: os.stat(p).st_mtime_ns for p in paths}


SPREAD = [{"Transaction_ID": str(n), "Customer_Name": f"member {n % 3}"} for n in (1, 2, 15, 27, 38)]


def test_a_batch_rewrites_no_bucket_that_it_does_not_touch(spark, tmp_path, raw_row):
    root, layers = f"{tmp_path}/lake", daily.Layers(f"{tmp_path}/lake", 10)
    first = write_files(spark, tmp_path, raw_row, "a", *SPREAD)
    second = write_files(spark, tmp_path, raw_row, "b", {"Transaction_ID": "15", "City": "rome"}, {"Transaction_ID": "41"})
    daily.run_daily(spark, root, first, "2024-01-01", span=10)
    tables = [layers.current, f"{layers.gold}/FactSales", f"{layers.gold}/FactProductBridge"]
    tables += [f"{layers.warehouse}/{n}" for n in ("FactSales", "FactProductBridge", "DailySums", "CustomerParts", "Baskets")]
    before = {t: times(stored_files(spark, t)) for t in tables}
    star, _ = daily.run_daily(spark, root, second, "2024-01-02", span=10)
    for t in tables:
        after = times(stored_files(spark, t))
        untouched = {p for p in before[t] if "bucket=n1/" not in p and "bucket=n4/" not in p}
        assert untouched and all(after[p] == before[t][p] for p in untouched), t
        assert not {p for p in before[t] if "bucket=n1/" in p} & set(after), t
        assert {p.split("bucket=")[1].split("/")[0] for p in after} == {"n0", "n1", "n2", "n3", "n4"}, t
    assert star.FactSales.count() == 6
    cities = rows(star.FactSales.join(star.DimStore, "Store_Key").orderBy("Transaction_ID").select("Transaction_ID", "City"))
    assert cities == [(1, "Oslo"), (2, "Oslo"), (15, "Rome"), (27, "Oslo"), (38, "Oslo"), (41, "Oslo")]


def test_only_touched_buckets_are_read(spark, tmp_path, raw_row):
    layers = daily.Layers(f"{tmp_path}/lake", 10)
    daily.run_daily(spark, layers.root, write_files(spark, tmp_path, raw_row, "a", *SPREAD), "2024-01-01", span=10)
    some = daily.silver_rows(spark, layers).filter(F.col("bucket").isin(["n1"]))
    assert "PartitionFilters: [isnotnull(bucket" in some._jdf.queryExecution().executedPlan().toString()
    read = rows(some.select(F.input_file_name()).distinct())
    assert [p.split("bucket=")[1].split("/")[0] for (p,) in read] == ["n1"]


def test_an_emptied_batch_withdraws_its_rows_from_every_table(spark, tmp_path, raw_row):
    layers = daily.Layers(f"{tmp_path}/lake", 10)
    load = lambda paths, day: daily.run_daily(spark, layers.root, paths, day, span=10)[0]
    load(write_files(spark, tmp_path, raw_row, "a", *SPREAD), "2024-01-01")
    load(write_files(spark, tmp_path, raw_row, "b", {"Transaction_ID": "15", "Date": "2024-07-01"}, {"Transaction_ID": "99"}), "2024-01-02")
    spark.createDataFrame([], schemas.RAW).write.json(f"{tmp_path}/none.json")
    star = load([f"{tmp_path}/none.json"], "2024-01-02")
    assert sorted(r[0] for r in rows(star.FactSales.select("Transaction_ID"))) == [1, 2, 15, 27, 38]
    assert rows(star.DimDate.select("Date_Key")) == [(20240305,)]
    assert star.FactProductBridge.count() == 10 and star.Baskets.count() == 5
    assert rows(star.DailySums.agg(F.sum("sales"))) == rows(star.CustomerParts.agg(F.sum("orders"))) == [(5,)]
    gone = load([f"{tmp_path}/none.json"], "2024-01-01")
    assert gone.FactSales.count() == gone.FactProductBridge.count() == gone.Baskets.count() == gone.DimDate.count() == 0
    assert rows(sales.total_revenue(gone)) == [(None,)]


def test_a_lake_may_begin_with_an_empty_batch(spark, tmp_path):
    spark.createDataFrame([], schemas.RAW).write.json(f"{tmp_path}/none.json")
    star, counts = daily.run_daily(spark, f"{tmp_path}/lake", [f"{tmp_path}/none.json"], "2024-01-01")
    assert counts["FactSales"] == counts["DimCustomer"] == counts["Silver"] == 0
    assert star.FactSales.count() == star.DimDate.count() == 0


def test_keys_stay_when_a_smaller_member_comes(spark, tmp_path, raw_row):
    layers = daily.Layers(f"{tmp_path}/lake")
    load = lambda name, day, *cells: daily.run_daily(spark, layers.root, write_files(spark, tmp_path, raw_row, name, *cells), day)[0]
    first = load("a", "2024-01-01", {"Customer_Name": "mia"}, {"Transaction_ID": "2", "Customer_Name": "noa", "Customer_Category": "NA"})
    before = rows(first.DimCustomer.orderBy("Customer_Key"))
    facts = rows(first.FactSales.orderBy("Transaction_ID"))
    assert [r[:2] for r in before] == [(1, "Mia"), (2, "Noa")]
    cells = [{"Transaction_ID": str(n), "Customer_Name": c, "Customer_Category": k} for n, c, k in (
        (3, "abe", "student"), (4, "noa", "NA"), (5, "zoe", "student"), (6, "NULL", "student"), (7, "noa", "student"))]
    second = load("b", "2024-01-02", *cells, {"Transaction_ID": "8", "Product": "['apple']"})
    after = rows(second.DimCustomer.orderBy("Customer_Key"))
    assert after[:2] == before and [r[:2] for r in after[2:]] == [(3, None), (4, "Abe"), (5, "Ann Lee"), (6, "Noa"), (7, "Zoe")]
    assert rows(second.FactSales.filter("Transaction_ID < 3").orderBy("Transaction_ID")) == facts
    products = dict(rows(second.DimProduct.select("Product_Name", "Product_Key")))
    assert products == {"bread": 1, "milk": 2, "apple": 3}
    third = load("b", "2024-01-02", *cells)
    assert rows(third.DimCustomer.orderBy("Customer_Key")) == after


def test_a_load_that_broke_off_is_made_up_for(spark, tmp_path, raw_row):
    layers = daily.Layers(f"{tmp_path}/lake", 10)
    daily.run_daily(spark, layers.root, write_files(spark, tmp_path, raw_row, "a", *SPREAD), "2024-01-01", span=10)
    # The next batch gets as far as silver, and its folder is replaced once more before anything else happens.
    for name, cells in (("b", {"Transaction_ID": "15", "Total_Cost": "99"}), ("c", {"Transaction_ID": "2", "Total_Cost": "50"})):
        daily.ingest(spark, layers, write_files(spark, tmp_path, raw_row, name, cells), "2024-01-02")
        daily.refine(spark, layers, "2024-01-02")
    assert daily.pending_buckets(spark, layers) == ["n0", "n1"]
    paths = write_files(spark, tmp_path, raw_row, "d", {"Transaction_ID": "27", "Total_Cost": "10"})
    star, _ = daily.run_daily(spark, layers.root, paths, "2024-01-03", span=10)
    costs = dict(rows(star.FactSales.select("Transaction_ID", "Total_Cost")))
    assert costs == {1: 12.5, 2: 50.0, 15: 12.5, 27: 10.0, 38: 12.5}
    assert daily.pending_buckets(spark, layers) == []


def test_a_lake_keeps_the_settings_that_it_was_begun_with(spark, tmp_path, raw_row):
    paths = write_files(spark, tmp_path, raw_row, "a", {})
    daily.run_daily(spark, f"{tmp_path}/lake", paths, "2024-01-01", span=10)
    with pytest.raises(ValueError, match="was begun with"):
        daily.run_daily(spark, f"{tmp_path}/lake", paths, "2024-01-01", span=20)


def test_ids_that_are_no_numbers_have_buckets_too(spark):
    ids = spark.createDataFrame([("7",), ("007",), ("-3",), ("12",), ("a-1",), ("99999999999999999999",)], "id string")
    found = dict(rows(ids.select("id", buckets.bucket_of("id", 10))))
    assert [found[i] for i in ("7", "007", "-3", "12")] == ["n0", "n0", "n0", "n1"]
    assert found["a-1"].startswith("h") and found["99999999999999999999"].startswith("h")


def test_the_second_batch_equals_a_load_of_everything_at_once(spark, tmp_path, raw_row):
    cells = [
        {"Transaction_ID": str(n), "Date": f"2024-0{n % 4 + 1}-1{n % 7} 10:00:00", "Total_Cost": str(n * 1.5), "City": "oslo" if n % 3 else "rome",
         "Customer_Name": f"c{n % 5}", "Customer_Category": "student" if n % 2 else "NA", "Product": f"['p{n % 4}', 'p{n % 6}']",
         "Promotion": "bogo" if n % 4 else "-"}
        for n in range(40)
    ]
    corrected = [{**c, "Total_Cost": "7.25", "Date": "2024-05-01"} for c in cells[5:9]]
    load = lambda lake, name, day, part: daily.run_daily(spark, f"{tmp_path}/{lake}", write_files(spark, tmp_path, raw_row, name, *part), day, span=10)[0]
    load("two", "a", "2024-01-01", cells)
    two = load("two", "b", "2024-01-02", corrected)
    one = load("one", "c", "2024-01-01", [*[c for c in cells if c not in cells[5:9]], *corrected])
    spoken = lambda star: sorted(rows(views.sales_overview(star)), key=str)
    assert spoken(two) == spoken(one)
    for report in EVERY_REPORT:
        assert sorted(rows(report(two)), key=str) == sorted(rows(report(two.bare())), key=str)


EVERY_REPORT = [
    lambda s: sales.revenue_by_period(s, "Year"),
    lambda s: sales.revenue_by_period(s, "Year", "Quarter"),
    sales.revenue_by_month,
    lambda s: sales.revenue_ranking(s, "Season"),
    lambda s: sales.revenue_ranking(s, "Customer_Category"),
    sales.top_customers,
    sales.segment_contribution,
    lambda s: sales.revenue_ranking(s, "City"),
    sales.top_cities,
    sales.top_store_types,
    lambda s: sales.revenue_ranking(s, "Promotion"),
    sales.items_per_promotion,
    sales.discount_impact,
    sales.products_by_category,
    sales.product_revenue,
    sales.products_by_season,
    sales.month_over_month,
    sales.customer_value,
    customers.retention,
    customers.days_between_orders,
    customers.average_lifespan,
    customers.segments_by_season,
    baskets.product_pairs,
    views.customer_analysis,
    views.product_performance,
    views.promotion_analysis,
    views.store_performance,
    views.time_analysis,
]
