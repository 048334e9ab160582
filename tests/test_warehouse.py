from datetime import date

from helpers import rows

from martloom.operators import warehouse


def frame(spark, names, *data):
    return spark.createDataFrame(list(data), ", ".join(f"{n} string" for n in names.split()))


def test_header_filter_is_null_safe(spark):
    df = frame(spark, "City", ("City",), (None,), ("Oslo",))
    assert sorted(rows(warehouse.drop_header_rows(df, "City")), key=str) == [("Oslo",), (None,)]


def test_text_loader_drops_header_bad_keys_and_null_names(spark):
    staged = frame(
        spark,
        "Customer_Key Customer_Name Customer_Category",
        ("Customer_Key", "Customer_Name", "Customer_Category"),
        ("1", "Ann", "x"),
        ("z", "Bob", "x"),
        ("3", None, "x"),
    )
    assert rows(warehouse.load_customers_text(staged)) == [(1, "Ann", "x")]


def test_promotion_texts_and_flags(spark):
    data = [("1", None, "TRUE"), ("2", " Bogo ", "false"), ("3", "(NULL)", "1"), ("4", "x", None)]
    staged = frame(spark, "Promotion_Key Promotion Discount_Applied", *data)
    typed = staged.selectExpr("int(Promotion_Key) Promotion_Key", "Promotion", "Discount_Applied")
    assert sorted(rows(warehouse.load_promotions(typed))) == [
        (1, "No Promotion", True), (2, "Bogo", False), (3, "(NULL)", False), (4, "x", False),
    ]
    assert sorted(rows(warehouse.load_promotions_text(staged)), key=str) == [
        (1, "No Promotion", True), (2, " Bogo ", False), (3, "No Promotion", True), (4, "x", None),
    ]
    assert (-1, "No Promotion", False) in rows(warehouse.with_unknown_promotion(warehouse.load_promotions(typed)))


def test_calendar_load_merges_moments_of_a_day(spark):
    names = "Date_Key Full_Date Day Month Month_Name Quarter Year Season"
    staged = frame(
        spark,
        names,
        ("1", "2024-03-05T10:00:00.000Z", "5", "3", "March", "1", "2024", "Spring"),
        ("2", "2024-03-05T11:00:00.000Z", "5", "3", "March", "1", "2024", "Winter"),
        ("3", None, "5", "3", "March", "1", "2024", "Winter"),
    ).selectExpr("int(Date_Key) Date_Key", "Full_Date", "int(Day) Day", "int(Month) Month", "Month_Name",
                 "int(Quarter) Quarter", "int(Year) Year", "Season")
    assert rows(warehouse.load_calendar(staged)) == [
        (20240305, date(2024, 3, 5), 5, 3, "March", 1, 2024, "Winter")
    ]


def test_sales_load_remaps_dates_and_sets_rejects_aside(spark):
    dates = spark.createDataFrame([(7, "2024-03-05T10:00:00.000Z")], "Date_Key int, Full_Date string")
    staged = spark.createDataFrame(
        [
            (1, 7, 1, 1, None, 2, 5.0),
            (2, 9, 1, 1, 4, 2, 5.0),
            (3, 7, 1, 1, 4, 2, -1.0),
            (None, 7, 1, 1, 4, 2, 5.0),
            (5, 7, None, 1, 4, 2, 5.0),
            (6, 7, 1, 1, 4, 2, float("nan")),
            (7, 7, 1, 1, 4, 2, 1e300),
        ],
        "Transaction_ID long, Date_Key int, Customer_Key int, Store_Key int, Promotion_Key int, "
        "Total_Items int, Total_Cost double",
    )
    assert rows(warehouse.load_sales(staged, dates)) == [(1, 20240305, 1, 1, -1, 2, 5.0)]
    assert sorted(r[0] for r in rows(warehouse.rejected_sales(staged, dates))) == [2, 5, 7]


def test_rows_lacking_a_required_column_are_set_aside_with_the_reason(spark):
    loaded = {
        "DimStore": spark.createDataFrame([(1, "Oslo", "a"), (None, "Rome", "b")], "Store_Key int, City string, Store_Type string"),
        "FactProductBridge": spark.createDataFrame([(1, 2), (None, None)], "Transaction_ID long, Product_Key int"),
    }
    kept, rejects = warehouse.enforce(loaded)
    assert rows(kept["DimStore"]) == [(1, "Oslo", "a")] and rows(kept["FactProductBridge"]) == [(1, 2)]
    assert sorted(rows(rejects)) == [
        ("DimStore", "no_Store_Key", '{"City":"Rome","Store_Type":"b"}'),
        ("FactProductBridge", "no_Transaction_ID,no_Product_Key", "{}"),
    ]


def test_day_keys_need_no_lookup(spark):
    staged = spark.createDataFrame(
        [(1, 20240305, 1, 1, None, 2, 5.0)],
        "Transaction_ID long, Date_Key int, Customer_Key int, Store_Key int, Promotion_Key int, "
        "Total_Items int, Total_Cost double",
    )
    found = warehouse.remapped_sales(staged, None)
    assert rows(found) == [(1, 20240305, 1, 1, -1, 2, 5.0)]
    assert "Join" not in found._jdf.queryExecution().executedPlan().toString()


def test_product_loaders_differ_in_marks(spark):
    staged = frame(spark, "Product_Key Product_Name", ("1", "['Tea'"), ("2", "'Tea']"))
    typed = staged.selectExpr("int(Product_Key) Product_Key", "Product_Name")
    assert [r[1] for r in rows(warehouse.load_products(typed).orderBy("Product_Key"))] == ["[tea", "tea"]
    assert [r[1] for r in rows(warehouse.load_products_text(staged).orderBy("Product_Key"))] == ["'Tea'", "'Tea'"]
    assert {r[1] for r in rows(warehouse.load_products_cleaned(typed))} == {"tea"}
