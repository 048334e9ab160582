from dataclasses import replace
from datetime import date, timedelta
from itertools import combinations

import pytest
from helpers import make_star, rows
from pyspark.sql import functions as F

from martloom.operators import profile, quality
from martloom.plans import baskets, customers, kept, sales, views
from martloom.sources.staging import stage


def day(key):
    d = date(key // 10000, key // 100 % 100, key % 100)
    return (key, d, d.day, d.month, d.strftime("%B"), (d.month + 2) // 3, d.year, "Any")


def sale(i, cost, customer=1, when=20240101, items=1, store=1, promotion=1):
    return (i, when, customer, store, promotion, items, cost)


def test_growth_over_a_zero_month_is_null(spark):
    star = make_star(
        spark,
        sales=[sale(1, 0.0), sale(2, 50.0, when=20240201), sale(3, 75.0, when=20240301)],
        dates=[day(20240101), day(20240201), day(20240301)],
    )
    growth = [r[-1] for r in rows(sales.month_over_month(star).orderBy("Year", "Month"))]
    assert growth == [None, None, 50.0]


def test_retention_bands(spark):
    counts = [1, 2, 3, 4, 6, 7, 10, 11]
    facts, n = [], 0
    for customer, orders in enumerate(counts):
        for _ in range(orders):
            n += 1
            facts.append(sale(n, 1.0, customer=customer))
    assert rows(customers.retention(make_star(spark, sales=facts))) == [
        ("1 (New)", 1, 12.5),
        ("2-3 (Occasional)", 2, 25.0),
        ("4-6 (Regular)", 2, 25.0),
        ("7-10 (Loyal)", 2, 25.0),
        ("10+ (VIP)", 1, 12.5),
    ]


def test_gaps_equal_those_of_ordered_orders(spark):
    days = [20240101, 20240101, 20240111, 20240131]
    facts = [sale(i, 1.0, customer=1, when=d) for i, d in enumerate(days)] + [sale(9, 1.0, customer=2)]
    star = make_star(spark, sales=facts, dates=[day(d) for d in sorted(set(days))])
    assert rows(customers.days_between_orders(star)) == [(1, 10.0)]
    assert rows(customers.average_lifespan(star)) == [("Avg Customer Lifespan (Days)", 15.0)]


def test_unmatched_promotion_is_left_out_of_reports(spark):
    star = make_star(
        spark,
        sales=[sale(1, 10.0, promotion=-1), sale(2, 5.0, promotion=1)],
        promotions=[(1, "Bogo", True), (2, "No Promotion", False)],
    )
    assert rows(sales.revenue_ranking(star, "Promotion")) == [("Bogo", 5.0)]
    assert sorted(rows(views.promotion_analysis(star))) == [
        (1, "Bogo", True, 1, 5.0), (2, "No Promotion", False, 0, None),
    ]


def test_equal_revenue_is_ordered_by_name_and_numerically(spark):
    names = ["d", "c", "b", "a"]
    star = make_star(
        spark,
        sales=[sale(1, 900.0, customer=1), sale(2, 1000.0, customer=2), sale(3, 900.0, customer=3)],
        customers=[(i + 1, n, "x") for i, n in enumerate(names)],
    )
    assert rows(sales.top_customers(star, 2)) == [("c", 1000.0), ("b", 900.0)]


def test_product_revenue_adds_up_to_sales_with_products(spark):
    facts = [sale(i, 10.0 + i / 7) for i in range(40)]
    bridge = [(i, p) for i in range(35) for p in range(1 + i % 5)] + [(3, 0)]
    star = make_star(spark, sales=facts, bridge=bridge, products=[(p, f"p{p % 3}") for p in range(5)])
    total = rows(sales.product_revenue(star).agg(F.sum("Estimated_Revenue")))[0][0]
    assert total == pytest.approx(sum(10.0 + i / 7 for i in range(35)), abs=0.05)


def test_shares_add_up_to_one_hundred(spark):
    star = make_star(
        spark,
        sales=[sale(i, float(i), customer=i % 7) for i in range(100)],
        customers=[(i, f"n{i}", f"c{i % 3}") for i in range(7)],
    )
    total = rows(sales.segment_contribution(star).agg(F.sum("Contribution_Pct")))[0][0]
    assert total == pytest.approx(100.0)


def brute_pairs(lines, names, total):
    bought = {}
    for t, p in lines:
        bought.setdefault(t, set()).add(names[p])
    single, pair = {}, {}
    for items in bought.values():
        for x in items:
            single[x] = single.get(x, 0) + 1
        for x, y in combinations(sorted(items), 2):
            pair[x, y] = pair.get((x, y), 0) + 1
    return {
        (x, y): (n, (n / single[x]) / (single[y] / total)) for (x, y), n in pair.items()
    }


@pytest.mark.parametrize("block", [1, 3, 64])
def test_pairs_match_brute_force_in_blocks_of_any_size(spark, block):
    names = {p: f"name{p % 9}" for p in range(12)}
    lines = [(t, (t * 7 + k * k) % 12) for t in range(60) for k in range(t % 8)] + [(0, p) for p in range(12)]
    lines += [(None, 1), (None, 2)]  # a missing id is no basket
    spelled = [(p, f"['{n.title()}' ") if p < 9 else (p, n) for p, n in names.items()]
    star = make_star(spark, sales=[sale(t, 1.0) for t in range(60)], bridge=lines, products=spelled)
    expected = brute_pairs(lines[:-2], names, 60)
    found = {r[:2]: r[2:] for r in rows(baskets.product_pairs(star, n=1000, block=block))}
    assert {k: v[0] for k, v in found.items()} == {k: v[0] for k, v in expected.items()}
    for pair, (_, lift) in expected.items():
        assert found[pair][-1] == pytest.approx(lift, abs=0.0051)


@pytest.mark.parametrize("shares", [(), (1 / 16,), (1 / 8, 1 / 2), (1.0,)])
def test_top_pairs_by_bounds_equal_all_pairs_counted(spark, shares):
    names = {p: f"name{p:02}" for p in range(30)}
    lines = [(t, (t * t + k * k * 3) % (5 + t % 26)) for t in range(90) for k in range(t % 6)]
    star = make_star(spark, sales=[sale(t, 1.0) for t in range(95)], bridge=lines, products=list(names.items()))
    counted = rows(baskets._best(baskets._scored(*baskets_scored(star)), 10))
    assert rows(baskets.product_pairs(star, shares=shares)) == counted


def baskets_scored(star):
    """All pairs, products and sales, as the ranking by brute force takes them."""
    spellings = baskets.product_spellings(star)
    whole = baskets.basket_items(star, spellings)
    sold = whole.select(F.explode("items").alias("item")).groupBy("item").agg(F.count(F.lit(1)).alias("sold"))
    product = sold.join(spellings.filter("Product_Key = item").select("item", "Product_Name"), "item")
    return baskets.pair_counts(whole), product, F.lit(star.FactSales.select("Transaction_ID").distinct().count())


def test_pairs_of_kept_baskets_form_without_a_shuffle_of_baskets(spark):
    lines = [(t, (t * t + k * k * 3) % (5 + t % 26)) for t in range(90) for k in range(t % 9)] + [(7, 99), (8, None)]
    facts = [sale(t, 1.0) for t in range(95)]
    star = make_star(spark, sales=facts, bridge=lines, products=[(p, f"name{p:02}") for p in range(30)])
    whole = replace(star, Baskets=kept.baskets(star.FactSales, star.FactProductBridge))
    spellings = baskets.product_spellings(star)
    listed = baskets.listed_items(replace(whole, Baskets=stage(whole.Baskets, "kept")), spellings)
    assert sorted(map(repr, rows(listed.filter("size(items) > 0").select("Transaction_ID")))) == sorted(
        map(repr, rows(star.FactProductBridge.filter("Product_Key IS NOT NULL").select("Transaction_ID").distinct()))
    )
    assert "Exchange" not in listed._jdf.queryExecution().executedPlan().toString()
    for block in (3, 64):  # baskets of up to eight items, cut and whole
        assert rows(baskets.product_pairs(whole, block=block)) == rows(baskets.product_pairs(star, block=block))
    # Two spellings of one product: keys are looked up.
    spelled = make_star(spark, sales=facts, bridge=lines, products=[(p, f"name{p % 9}") for p in range(30)])
    assert baskets.listed_items(replace(spelled, Baskets=whole.Baskets), baskets.product_spellings(spelled)) is None
    assert rows(baskets.product_pairs(replace(spelled, Baskets=whole.Baskets))) == rows(baskets.product_pairs(spelled))


def test_too_few_rare_products_form_no_pairs_of_their_own(spark, monkeypatch):
    lines = [(t, p) for t in range(40) for p in range(8)] + [(50, 8), (50, 9)]
    star = make_star(spark, sales=[sale(t, 1.0) for t in range(60)], bridge=lines, products=[(p, f"n{p}") for p in range(10)])
    formed, count = [], baskets.pair_counts
    monkeypatch.setattr(baskets, "pair_counts", lambda *args: formed.append(args) or count(*args))
    best = rows(baskets.product_pairs(star, shares=(1 / 320,)))
    assert len(formed) == 1 and len(best) == 10 and best[0][:2] == ("n8", "n9")


def test_pairs_of_frequent_products_are_not_formed_where_rare_ones_beat_them(spark, monkeypatch):
    names = [(p, f"name{p:02}") for p in range(40)]
    lines = [(t, p) for t in range(60) for p in range(4)] + [(100 + k, 10 + 2 * k + i) for k in range(12) for i in (0, 1)]
    star = make_star(spark, sales=[sale(t, 1.0) for t in [*range(60), *range(100, 112)]], bridge=lines, products=names)
    formed, count = [], baskets.pair_counts

    def counting(*args):
        formed.append(count(*args).agg(F.sum("n")).first()[0])
        return count(*args)

    monkeypatch.setattr(baskets, "pair_counts", counting)
    best = rows(baskets.product_pairs(star))
    assert formed == [12] and len(best) == 10 and {r[-1] for r in best} == {72.0}
    # Twelve such pairs exist, so twenty are not found among rare products.
    assert len(rows(baskets.product_pairs(star, n=20))) == 18 and formed[1:] == [12, 12 + 6 * 60]


def test_view_names_are_queryable(spark):
    star = make_star(spark, sales=[sale(1, 2.0)], customers=[(1, "a", "x"), (2, "b", "x")])
    views.register_views(star)
    found = spark.sql("SELECT Customer_Name, Total_Transactions, Lifetime_Value FROM vw_CustomerAnalysis")
    assert sorted(rows(found)) == [("a", 1, 2.0), ("b", 0, None)]
    assert spark.sql("SELECT count(*) FROM vw_TimeAnalysis").collect()[0][0] == 0


def test_quality_checks_find_faults(spark):
    facts = [(1, 20240101, None, 1, None, 1, 5.0), (2, 20240102, 9, None, 1, None, None), sale(3, 5.0)]
    star = make_star(spark, sales=facts, customers=[(1, "a", "x"), (1, "b", "x")], dates=[day(20240101)],
                     products=[(1, None), (1, "x"), (2, "y")])
    fact = star.FactSales
    assert rows(quality.missing_values(fact, star.DimProduct)) == [("FactSales", 1), ("DimProduct", 1)]
    third = 100.0 / 3
    assert rows(quality.null_percentages(fact))[0] == pytest.approx((third, third, third))
    assert rows(quality.duplicate_keys(star.DimProduct, "Product_Key")) == [(1, 2)]
    assert rows(quality.orphans(fact, star.DimCustomer, "Customer_Key", "n")) == [(2,)]
    assert rows(quality.orphans(fact, star.DimDate, "Date_Key", "n")) == [(1,)]
    assert rows(quality.null_keys(fact)) == [(1, 1, 0)]
    assert rows(quality.surplus_keys({"DimCustomer": star.DimCustomer})) == [("DimCustomer", 1)]


@pytest.mark.parametrize("size", [1, 4, 1001])
def test_exact_quantiles_with_a_dominant_value(spark, size):
    values = sorted([5.0] * (size // 3) + [float(i * 37 % size) for i in range(size - size // 3)])
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(5)
    found = {share: value for _, share, value in rows(profile.exact_quantiles(df, ["x"]))}
    assert found == {q: values[max(-(-size * int(q * 100) // 100), 1) - 1] for q in profile.QUARTILES}


def test_summary_flavours_agree_on_small_data(spark):
    df = spark.range(101).select(F.col("id").cast("int").alias("a"), (F.col("id") * 2.0).alias("b"))
    exact = sorted(rows(profile.summary(df, ["a", "b"])))
    assert exact == sorted(rows(profile.summary(df, ["a", "b"], exact=False)))
    assert exact[0][-3:] == (25.0, 50.0, 75.0)


def test_distribution_keeps_nulls_and_top_values(spark):
    df = spark.createDataFrame([("x",)] * 3 + [(None,)] * 2 + [("y",)], "City string")
    assert sorted(rows(profile.value_distribution(df, ("City",), top=2)), key=str) == [
        ("City", "x", 3, 1), ("City", None, 2, 2),
    ]
    assert rows(profile.distinct_counts(df, ("City",))) == [("City", 3)]


def test_quarters_cover_every_dated_sale(spark):
    far = [int((date(2024, 1, 1) + timedelta(days=i)).strftime("%Y%m%d")) for i in range(0, 400, 40)]
    star = make_star(spark, sales=[sale(i, 1.0, when=k) for i, k in enumerate(far)], dates=[day(k) for k in far])
    assert sum(r[-1] for r in rows(sales.revenue_by_period(star, "Year", "Quarter"))) == len(far)
