"""Mergeable profiles against the exact ones, within the stated errors."""

import pytest
from helpers import rows
from pyspark.sql import functions as F

from martloom.operators import profile, sketches

NUMBERS, CATEGORIES = ("Total_Items", "Total_Cost"), ("City", "Promotion")


@pytest.fixture(scope="module")
def table(spark):
    x = F.col("id")
    return spark.range(60_000, numPartitions=4).select(
        (x % 37).cast("int").alias("Total_Items"),
        F.when(x % 11 > 0, F.pow(x % 20_011, F.lit(2.0)) / 7).alias("Total_Cost"),
        F.when(x % 5 > 0, F.concat(F.lit("c"), (x * x % 41).cast("string"))).alias("City"),
        F.concat(F.lit("p"), (x % 9_001).cast("string")).alias("Promotion"),
        (x * x % 13).alias("part"),
    )


@pytest.fixture(scope="module")
def parts(spark, table, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("profiles")) + "/parts"
    sketches.sketched(table, "part", NUMBERS, CATEGORIES).write.parquet(path)
    return spark.read.parquet(path).drop("part")


def test_merged_summary(table, parts):
    found = {r["column_name"]: r for r in sketches.summary(parts, NUMBERS).collect()}
    exact = {r["column_name"]: r for r in profile.summary(table, list(NUMBERS)).collect()}
    for c in NUMBERS:
        for figure in ("value_count", "min_value", "max_value"):
            assert found[c][figure] == exact[c][figure]
        assert found[c]["mean_value"] == pytest.approx(exact[c]["mean_value"], rel=1e-9, abs=1e-4)
        assert found[c]["stddev_value"] == pytest.approx(exact[c]["stddev_value"], rel=1e-7, abs=1e-4)
        for share, name in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75")):
            value = float(found[c][name])
            low, high, n = table.agg(F.count_if(F.col(c) < value), F.count_if(F.col(c) <= value), F.count(c)).first()
            assert low / n - 0.01 <= share <= high / n + 0.01


def test_merged_distinct_counts(table, parts):
    found, exact = (dict(rows(f)) for f in (sketches.distinct_counts(parts, CATEGORIES), profile.distinct_counts(table, CATEGORIES)))
    assert found["City"] == exact["City"]  # few values are counted exactly
    assert abs(found["Promotion"] - exact["Promotion"]) <= 0.05 * exact["Promotion"]


def test_merged_frequent_values(table, parts):
    found = sorted(rows(sketches.value_distribution(parts, ("City",))), key=str)
    assert found == sorted(rows(profile.value_distribution(table, ("City",))), key=str)


def test_no_parts(parts):
    none = parts.limit(0)
    assert rows(sketches.distinct_counts(none, CATEGORIES)) == [("City", 0), ("Promotion", 0)]
    assert rows(sketches.value_distribution(none, CATEGORIES)) == []
    assert [r[2:] for r in rows(sketches.summary(none, NUMBERS))] == [(None,) * 7] * 2


def test_a_profile_reads_sketches_only(parts):
    plan = sketches.summary(parts, NUMBERS)._jdf.queryExecution().executedPlan().toString()
    assert "City" not in plan.split("ReadSchema")[1].split("\n")[0]
