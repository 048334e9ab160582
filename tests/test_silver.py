from datetime import datetime

import pytest
from helpers import rows
from pyspark.sql import functions as F
from pyspark.sql import Observation

from martloom.operators import silver
from martloom.sources.staging import stage


def test_refine_cleans_types_and_keeps_one_row(bronze_of):
    clean = silver.refine(bronze_of({"Customer_Name": "  ANN lee ", "Promotion": "n/a"}))
    row = clean.collect()[0]
    assert (row.Customer_Name, row.Promotion, row.Date) == ("Ann Lee", None, datetime(2024, 3, 5, 10, 11, 12))
    assert (row.Year, row.Month, row.Day, row.Quarter, row.Month_Name) == (2024, 3, 5, 1, "March")
    assert row.Product_Array == ["milk", "bread"]
    assert dict(clean.dtypes)["Total_Cost"] == "double"


@pytest.mark.parametrize(
    ("cells", "fault"),
    [
        ({"Transaction_ID": None}, "no_transaction_id"),
        ({"Date": "31/31/2020 00:00:00"}, "no_date"),
        ({"Total_Items": "0"}, "bad_items"),
        ({"Total_Items": "x"}, "bad_items"),
        ({"Total_Cost": "-0.01"}, "bad_cost"),
        ({"Total_Cost": "NaN"}, "bad_cost"),
        ({"Total_Cost": "abc"}, "bad_cost"),
        ({"Total_Cost": "1e300"}, "cost_out_of_range"),
        ({"Product": "[]"}, "no_products"),
        ({"Product": None}, "no_products"),
    ],
)
def test_each_rule_rejects(bronze_of, cells, fault):
    shaped = silver.shape(bronze_of(cells))
    assert silver.valid_rows(shaped).count() == 0
    assert rows(silver.rejected_rows(shaped).select("faults")) == [([fault],)]


def test_zero_cost_is_valid(bronze_of):
    assert silver.refine(bronze_of({"Total_Cost": "0"})).count() == 1


def test_rejection_counts_and_observed_counts_agree(bronze_of):
    bronze = bronze_of({}, {"Total_Cost": "x", "Product": ""}, {"Date": "no"})
    counts = silver.rejection_counts(silver.shape(bronze)).collect()[0]
    assert (counts.total_rows, counts.valid_rows, counts.dropped_rows) == (3, 1, 2)
    assert (counts.bad_cost, counts.no_products, counts.no_date, counts.bad_items) == (1, 1, 1, 0)
    seen = Observation()
    silver.refine(bronze, counts=seen).collect()
    assert seen.get == {"read": 3, "dropped": 2}


def test_latest_copy_wins_whatever_the_row_order(spark, bronze_of):
    bronze = bronze_of({"City": "old"}, {"City": "new"}, {"Transaction_ID": "2"}).withColumn(
        "ingestion_timestamp",
        F.when(F.col("City") == "new", F.timestamp_seconds(F.lit(200))).otherwise(F.timestamp_seconds(F.lit(100))),
    )
    for partitions in (1, 3):
        kept = silver.latest_per_transaction(bronze.repartition(partitions))
        assert sorted(rows(kept.select("Transaction_ID", "City"))) == [("1", "new"), ("2", "oslo")]


def test_a_later_batch_wins_even_if_an_old_one_is_loaded_again(bronze_of):
    bronze = bronze_of({"City": "old"}, {"City": "new"})
    day = F.when(F.col("City") == "new", "2024-03-07").otherwise("2024-03-06")
    loaded = F.timestamp_seconds(F.when(F.col("City") == "new", 100).otherwise(900))
    bronze = bronze.withColumns({"source_batch_date": day, "ingestion_timestamp": loaded})
    assert rows(silver.latest_per_transaction(bronze).select("City")) == [("new",)]


def test_ties_are_settled_by_content(bronze_of):
    bronze = bronze_of({"City": "a"}, {"City": "b"}, {"City": "c"}).withColumn(
        "ingestion_timestamp", F.timestamp_seconds(F.lit(1))
    )
    found = {rows(silver.latest_per_transaction(bronze.repartition(n)).select("City"))[0] for n in (1, 2, 3, 5)}
    assert len(found) == 1


def test_date_diagnostic_counts_every_format(bronze_of):
    bronze = bronze_of({"Date": "2024-01-02"}, {"Date": "03-04-2024"}, {"Date": "?"}, {"Date": None})
    found = {f: n for f, n in rows(silver.date_diagnostic(bronze)) if n}
    assert found == {"MM-dd-yyyy": 1, "dd-MM-yyyy": 1, "unreadable": 2, "yyyy-MM-dd": 1}


def test_a_shaped_row_is_shuffled_without_what_follows_from_it(spark, bronze_of):
    cells = [{"Transaction_ID": t, "Product": p, "Date": d} for t, p, d in (
        ("1", "['a']", "2024-01-01"), ("1", "['b', 'c']", "2024-02-01"), ("1", "['d']", "2024-01-01"), ("2", "['a']", "2023-05-06"), (None, "['z']", "2024-01-01"))]
    shaped = stage(silver.shape(bronze_of(*cells)), "shaped")
    found = silver.latest_of_shaped(shaped)
    assert found.dtypes == silver.latest_per_transaction(shaped).dtypes
    # Ties of age are settled as by the whole row.
    assert sorted(map(str, rows(found))) == sorted(map(str, rows(silver.latest_per_transaction(shaped))))
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    try:
        plan = silver.refine(bronze_of({}))._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")
    gathered = next(line for line in plan.splitlines() if "Aggregate [" in line)
    assert "Total_Cost" in gathered and not any(c in gathered for c in silver.DERIVED if c != "Year" and c != "Day" and c != "Month")
