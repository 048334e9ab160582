"""Plan shapes that must hold at any size, and hot keys."""

from contextlib import contextmanager
from dataclasses import replace
from pathlib import Path

import pytest
from helpers import make_star, rows
from pyspark.sql import functions as F

from harness.tables import tables
from martloom.operators import gold, silver
from martloom.operators.keys import with_dense_key
from martloom.plans import baskets, customers, sales, views
from martloom.sources.staging import scratch, shared_folder, stage

GIVEN = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@contextmanager
def settings(spark, **values):
    names = {k.replace("__", "."): v for k, v in values.items()}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name in names:
            spark.conf.unset(name)


@pytest.fixture(scope="module")
def given(spark):
    return tables(spark, GIVEN)


def test_reports_read_only_their_columns(given):
    text = plan(sales.revenue_ranking(given.star, "City"))
    assert "ReadSchema: struct<Store_Key:int,Total_Cost:double>" in text
    assert "ReadSchema: struct<Store_Key:int,City:string>" in text


def test_facts_are_reduced_before_they_meet_a_dimension(spark, given):
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        text = plan(sales.revenue_ranking(given.star, "Customer_Category"))
    join = text.index("SortMergeJoin")
    assert "HashAggregate(keys=[Customer_Key" in text[join:]
    assert "partial_sum(try_cast(Total_Cost" in text[join:]


def test_dense_keys_avoid_the_single_partition_sort(spark):
    keyed = with_dense_key(spark.range(1000), "k", ["id"])
    scan_side = plan(keyed).split("BroadcastExchange")[0]
    assert "SinglePartition" not in scan_side and "Window" not in scan_side


def test_dedupe_combines_before_the_shuffle(spark, given):
    text = plan(silver.latest_per_transaction(given.bronze))
    assert "partial_max_by" in text and "Window" not in text


def test_no_dimension_is_broadcast_by_force(spark, given):
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
    ):
        for df in (
            gold.sales_fact(given.silver, given.gold),
            views.sales_overview(given.star),
            sales.products_by_category(given.star),
        ):
            assert "BroadcastHashJoin" not in plan(df)
            assert df.count() > 0


@pytest.fixture(scope="module")
def hot_star(spark):
    """A third of all bridge rows belong to one transaction."""
    lines = spark.range(600_000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("Transaction_ID"),
        (F.col("id") % 50).cast("int").alias("Product_Key"),
    )
    facts = lines.select("Transaction_ID").distinct().select(
        "Transaction_ID",
        F.lit(20240101).alias("Date_Key"),
        (F.col("Transaction_ID") % 5).cast("int").alias("Customer_Key"),
        F.lit(1).alias("Store_Key"),
        F.lit(1).alias("Promotion_Key"),
        F.lit(1).alias("Total_Items"),
        F.lit(1.5).alias("Total_Cost"),
    )
    customers = [(i, f"n{i}", f"c{i}") for i in range(5)]
    base = make_star(spark, customers=customers, products=[(p, f"p{p}") for p in range(50)])
    return replace(base, FactSales=stage(facts, "facts"), FactProductBridge=stage(lines, "lines"))


SHUFFLE_JOINS = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "100KB",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "100KB",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "1.5",
}


@pytest.mark.parametrize("report", [sales.products_by_category, views.product_performance])
def test_rows_of_one_basket_are_split_over_tasks(spark, hot_star, report):
    count = {"products_by_category": "Purchases", "product_performance": "Total_Times_Purchased"}[report.__name__]
    with settings(spark, **SHUFFLE_JOINS):
        df = report(hot_star)
        found = rows(df)
        assert "skew=true" in plan(df)
    assert sum(r[df.columns.index(count)] for r in found) == 600_000


def test_product_revenue_counts_a_hot_basket_before_joining(spark, hot_star):
    with settings(spark, **SHUFFLE_JOINS):
        df = sales.product_revenue(hot_star)
        found = rows(df)
        text = plan(df)
    assert "keys=[Transaction_ID" in text and "partial_count(1)" in text
    everything = rows(hot_star.FactSales.agg(F.sum("Total_Cost")))[0][0]
    assert sum(r[1] for r in found) == pytest.approx(everything)


def test_hot_basket_pairs_are_whole(spark, hot_star):
    found = rows(baskets.product_pairs(hot_star, n=5000))
    assert len(found) == 50 * 49 // 2 and {r[2] for r in found} == {1}


def test_pairs_of_one_wide_basket_form_in_many_tasks(spark):
    basket = spark.range(1).select(F.lit(1).alias("Transaction_ID"), F.sequence(F.lit(1), F.lit(5000)).alias("items"))
    with settings(spark, spark__sql__shuffle__partitions="20", spark__sql__adaptive__enabled="false"):
        pairs = baskets.pair_counts(basket).withColumn("part", F.spark_partition_id())
        assert "rangepartitioning" not in plan(pairs)
        i = F.explode(F.sequence(F.lit(0), F.lit(78))).alias("i")
        blocks = spark.range(1).select(i).select("i", F.explode(F.sequence("i", F.lit(78))).alias("j"))
        dealt = blocks.select(F.lit(1).alias("Transaction_ID"), "i", "j").repartition("Transaction_ID", "i", "j")
        sizes = [r[1] for r in rows(dealt.groupBy(F.spark_partition_id()).count())]
        assert len(sizes) == 20 and max(sizes) <= 2 * sum(sizes) / len(sizes)
        assert rows(pairs.agg(F.count("*"), F.max("n"))) == [(5000 * 4999 // 2, 1)]


def test_both_join_plans_give_equal_rows(spark, given):
    reports = [
        lambda s, name=name: sales.revenue_ranking(s, name)
        for name in ("Season", "Customer_Category", "City", "Store_Type", "Promotion")
    ]
    reports += [sales.items_per_promotion, sales.discount_impact, sales.month_over_month, sales.customer_value]
    reports += [sales.best_sellers, sales.products_by_category, sales.products_by_season, sales.product_revenue]
    for report in reports:
        small = rows(report(given.star))
        with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
            assert sorted(rows(report(given.star)), key=str) == sorted(small, key=str)


def test_finished_work_leaves_no_staged_table(spark, given):
    folder = Path(shared_folder(spark).removeprefix("file:")) / "martloom" / spark.sparkContext.applicationId
    before = set(folder.iterdir())
    with scratch(spark):
        assert baskets.product_pairs(given.star).count() == 10
        assert set(folder.iterdir()) != before
    assert set(folder.iterdir()) == before


def test_hot_transaction_id_is_deduplicated_whole(spark, bronze_of):
    one = bronze_of({"Transaction_ID": "hot"}).drop("Transaction_ID")
    many = spark.range(50_000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("Transaction_ID")
    )
    bronze = many.join(F.broadcast(one)).select("Transaction_ID", *one.columns)
    kept = silver.latest_per_transaction(bronze)
    assert rows(kept.agg(F.count("*"), F.countDistinct("Transaction_ID"))) == [(33_334, 33_334)]


def test_basket_sets_combine_before_the_shuffle(given):
    spellings = baskets.product_spellings(given.star)
    assert "partial_collect_set" in plan(baskets.basket_items(given.star, spellings))


def test_a_month_reads_one_folder_of_the_fact(spark, given):
    march = sales.revenue_in(given.lake_star, (F.col("Year") == 1995) & (F.col("Month") == 3), "Day")
    text = plan(march)
    assert "PartitionFilters: [isnotnull(Month_Key" in text and "dynamicpruning" in text.lower()
    found = rows(march)
    # What ran, with its figures, tells how many folders were read.
    metrics = march._jdf.queryExecution().executedPlan()
    scans, todo = [], [metrics]
    while todo:
        node = todo.pop()
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            node = node.executedPlan()
        if "QueryStage" in node.nodeName():
            node = node.plan()
        if node.nodeName().startswith("Scan") and node.metrics().contains("numPartitions"):
            scans.append(node.metrics().apply("numPartitions").value())
        todo += [node.children().apply(i) for i in range(node.children().size())]
    assert scans == [1]
    assert found == rows(sales.revenue_in(given.lake_star.bare(), (F.col("Year") == 1995) & (F.col("Month") == 3), "Day"))
    stored = given.lake_star.SalesByMonth.select("Month_Key").distinct().count()
    assert stored > 50


def test_kept_reports_do_not_scan_the_fact_nor_meet_it_by_transaction(spark, given):
    star = given.lake_star
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        reports = (sales.products_by_category(star), sales.product_revenue(star), sales.products_by_season(star),
                                   views.product_performance(star), sales.customer_value(star), customers.retention(star),
                                   sales.month_over_month(star), sales.discount_impact(star), views.time_analysis(star))
        texts = [plan(r) for r in reports]
    assert not [line for text in texts for line in text.split("\n") if "Join [Transaction_ID" in line]
    read = [" ".join(r.inputFiles()) for r in reports]
    assert not [r for r in read if "/FactSales/" in r or "/FactProductBridge/" in r]
    assert "/Baskets/" in read[0] and "/CustomerParts/" in read[4] and "/DailySums/" in read[6]
