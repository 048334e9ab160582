from helpers import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from martloom.operators import gold, silver
from martloom.operators.keys import with_dense_key


def test_dense_key_equals_global_row_number(spark):
    df = spark.range(5000).select(
        F.when(F.col("id") % 7 != 0, F.concat(F.lit("n"), F.col("id") % 31)).alias("a"), (-F.col("id")).alias("b")
    )
    keyed = with_dense_key(df, "k", ["a", "b"])
    expected = F.row_number().over(Window.orderBy("a", "b"))
    assert keyed.withColumn("e", expected).filter("k <> e").count() == 0
    assert rows(keyed.agg(F.min("k"), F.max("k"), F.countDistinct("k"))) == [(1, 5000, 5000)]


def test_dense_key_of_nothing(spark):
    assert with_dense_key(spark.range(0), "k", ["id"]).count() == 0


def _stored(silver_df):
    return gold.dimensions(silver_df)


def test_null_attribute_loses_its_key_unless_null_safe(bronze_of):
    clean = silver.refine(bronze_of({"Promotion": "NA"}, {"Transaction_ID": "2"})).cache()
    dims = _stored(clean)
    keys = lambda safe: dict(
        rows(gold.sales_fact(clean, dims, null_safe=safe).select("Transaction_ID", "Promotion_Key"))
    )
    assert keys(False) == {"1": None, "2": 2}
    assert keys(True) == {"1": 1, "2": 2}


def test_two_seasons_on_a_moment_fan_out_only_at_timestamp_grain(bronze_of):
    clean = silver.refine(bronze_of({}, {"Transaction_ID": "2", "Season": "summer"})).cache()
    by_day = gold.dimensions(clean)
    assert by_day["DimDate"].count() == 1
    assert gold.sales_fact(clean, by_day).count() == 2
    by_moment = gold.dimensions(clean, by_timestamp=True)
    assert by_moment["DimDate"].count() == 2
    assert gold.sales_fact(clean, by_moment, by_timestamp=True).count() == 4


def test_repeated_product_gives_repeated_bridge_rows(bronze_of):
    clean = silver.refine(bronze_of({"Product": "['tea', 'tea', 'oil']"})).cache()
    products = gold.product_dimension(clean)
    assert rows(products.orderBy("Product_Key")) == [(1, "oil"), (2, "tea")]
    assert sorted(rows(gold.product_bridge(clean, products))) == [("1", 1), ("1", 2), ("1", 2)]


def test_fact_holds_every_silver_row(bronze_of):
    clean = silver.refine(bronze_of(*[{"Transaction_ID": str(i), "City": f"c{i % 3}"} for i in range(30)])).cache()
    fact = gold.sales_fact(clean, gold.dimensions(clean))
    assert fact.count() == clean.count() == 30
    assert fact.filter("Store_Key IS NULL OR Customer_Key IS NULL OR Date_Key <> 20240305").count() == 0
