"""A load pays for what has changed, and shuffles a whole row once."""

import os

from helpers import rows
from pyspark.sql import functions as F

from harness.tables import Landing, tables
from martloom import schemas
from martloom.operators import buckets, silver
from martloom.operators.buckets import BUCKET
from martloom.plans import daily, kept
from martloom.sources import files, writers
from martloom.sources.staging import stage


def _times(spark, path):
    found = {}
    for folder, names in files.data_files(spark, path).items():
        found |= {n: os.stat(f"{folder.split(':', 1)[-1]}/{n}").st_mtime_ns for n in names}
    return found


def _batch(spark, tmp_path, raw_row, name, *cells):
    path = f"{tmp_path}/{name}.csv"
    writers.write_layer(spark.createDataFrame([raw_row(**c) for c in cells], schemas.RAW), path, "csv", compression="gzip")
    return [path]


def test_a_batch_that_comes_again_unchanged_writes_no_table_anew(spark, tmp_path, raw_row):
    layers = daily.Layers(f"{tmp_path}/lake", 10)
    first = _batch(spark, tmp_path, raw_row, "a", {}, {"Transaction_ID": "2"}, {"Transaction_ID": "2"}, {"Transaction_ID": "15"})
    second = _batch(spark, tmp_path, raw_row, "b", {"City": "rome"}, {"Transaction_ID": "27"})
    daily.run_daily(spark, layers.root, first, "2024-01-01", span=10)
    daily.run_daily(spark, layers.root, second, "2024-01-02", span=10)
    places = [layers.silver, layers.current, f"{layers.gold}/FactSales", f"{layers.warehouse}/Baskets", f"{layers.warehouse}/DimCustomer"]
    before = [_times(spark, p) for p in places]
    assert all(before)
    star, counts = daily.run_daily(spark, layers.root, first, "2024-01-01", span=10)
    assert [_times(spark, p) for p in places] == before and not files.exists(spark, layers.pending)
    assert counts["read"] == 4 and counts["Silver"] == star.FactSales.count() == 4
    # One cell of one bucket is another: that bucket follows, the others stay.
    other = _batch(spark, tmp_path, raw_row, "c", {}, {"Transaction_ID": "2", "Total_Cost": "50"}, {"Transaction_ID": "15"})
    star, _ = daily.run_daily(spark, layers.root, other, "2024-01-01", span=10)
    assert dict(rows(star.FactSales.select("Transaction_ID", "Total_Cost"))) == {1: 12.5, 2: 50.0, 15: 12.5, 27: 12.5}
    changed = {n for old, p in zip(before[1:2], places[1:2]) for n, t in _times(spark, p).items() if old.get(n) != t}
    assert len(changed) == 1


def test_repeated_transactions_are_found_by_their_ids_alone(spark, bronze_of):
    cells = [{"Transaction_ID": t, "Total_Items": n} for t, n in (("1", "1"), ("2", "3"), ("2", "4"), (None, "5"), (None, "6"))]
    shaped = stage(silver.shape(bronze_of(*cells, {"Transaction_ID": "1", "Total_Items": "1"})), "shaped")
    found = silver.latest_of_stored(shaped)
    assert sorted(map(str, rows(found))) == sorted(map(str, rows(silver.latest_per_transaction(shaped))))
    names = [n for n in shaped.columns if n not in silver.DERIVED]
    again = silver.derived(shaped.select(names)).select(shaped.columns)
    assert sorted(map(str, rows(again))) == sorted(map(str, rows(shaped)))


def test_baskets_of_a_load_are_dealt_out_once(spark):
    columns = "Transaction_ID long, Date_Key int, Customer_Key int, Total_Cost double, bucket string"
    sold = [(1, 20240101, 1, 2.5, "n0"), (1, 20240101, 1, 2.5, "n0"), (2, None, None, 1.0, "n0"), (None, 1, 1, 1.0, "n1")]
    lines = [(1, 7, "n0"), (1, 7, "n0"), (1, 3, "n0"), (9, None, "n0"), (None, 3, "n1")]
    sales = spark.createDataFrame(sold, columns)
    bridge = spark.createDataFrame(lines, "Transaction_ID long, Product_Key int, bucket string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = kept.baskets(sales, bridge, (BUCKET,))
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and "Join" not in plan
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    as_text = sorted(str(tuple(map(str, r))) for r in rows(found.selectExpr("Transaction_ID", "to_json(Sales)", "to_json(Lines)")))
    sale = '[{"Date_Key":20240101,"Customer_Key":1,"Total_Cost":2.5,"n":2}]'
    expected = [
        (1, sale, '[{"Product_Key":3,"n":1},{"Product_Key":7,"n":2}]'),
        (2, '[{"Total_Cost":1.0,"n":1}]', "[]"),
        (9, "[]", '[{"n":1}]'),
        (None, "[]", '[{"Product_Key":3,"n":1}]'),
        (None, '[{"Date_Key":1,"Customer_Key":1,"Total_Cost":1.0,"n":1}]', "[]"),
    ]
    assert as_text == sorted(str(tuple(map(str, r))) for r in expected)
    plain = kept.baskets(sales.drop("bucket"), bridge.drop("bucket"))
    assert sorted(map(str, rows(plain))) == sorted(map(str, rows(found.drop("bucket"))))


def test_a_format_is_written_when_it_is_asked_for(spark, tmp_path):
    given = tables(spark, "/root/testdata/sf0.001")
    landing = Landing(str(tmp_path), given.dirty_raw)
    assert landing["csv"].endswith("transactions.csv") and sorted(os.listdir(tmp_path)) == ["transactions.csv", "transactions.parquet"]
    assert all(n.endswith(".csv.gz") for names in files.data_files(spark, landing["csv"]).values() for n in names)
    assert len(list(landing.items())) == 3 and "transactions.json" in os.listdir(tmp_path)
    assert spark.read.json(landing["json"]).agg(F.count(F.lit(1))).first()[0] == spark.read.parquet(landing["parquet"]).count()


def test_files_are_listed_in_few_calls(spark, tmp_path, monkeypatch):
    spark.range(60).selectExpr("id", "id % 3 AS a", "id AS b").repartition(1).write.partitionBy("a", "b").parquet(f"{tmp_path}/t{{1}}")
    client, calls = spark.sparkContext._gateway._gateway_client, []
    send = client.send_command
    monkeypatch.setattr(client, "send_command", lambda command, *a, **k: (calls.append(command[0]), send(command, *a, **k))[1])
    found = files.data_files(spark, f"{tmp_path}/t{{1}}")
    assert len(found) == 60 and all(f.split("/")[-1].startswith("b=") and len(names) == 1 for f, names in found.items())
    # Commands "m" are garbage of earlier calls. Walking the folders took ten calls a file.
    assert len([c for c in calls if c != "m"]) < 6 * 60
    assert files.data_files(spark, f"{tmp_path}/none") == {}


def test_a_batch_that_comes_again_unchanged_is_not_parsed(spark, tmp_path, raw_row, monkeypatch):
    layers = daily.Layers(f"{tmp_path}/lake", 10)
    cells = ({}, {"Transaction_ID": "2"}, {"Transaction_ID": "2"}, {"Transaction_ID": "3", "Total_Cost": "x"})
    first = _batch(spark, tmp_path, raw_row, "a", *cells)
    _, counts = daily.run_daily(spark, layers.root, first, "2024-01-01", span=10)
    parsed, shape = [], silver.shape
    monkeypatch.setattr(silver, "shape", lambda *a: (parsed.append(1), shape(*a))[1])
    _, again = daily.run_daily(spark, layers.root, first, "2024-01-01", span=10)
    assert not parsed and again == counts and counts["read"] == 4 and counts["dropped"] == 1
    # Other rows that come twice, other formats, or no silver folder: all of them are parsed.
    twice = _batch(spark, tmp_path, raw_row, "b", {}, {"Transaction_ID": "4"}, {"Transaction_ID": "4"}, cells[-1])
    star, _ = daily.run_daily(spark, layers.root, twice, "2024-01-01", span=10)
    assert parsed and sorted(r[0] for r in rows(star.FactSales.select("Transaction_ID"))) == [1, 4]
    for change in (lambda: daily.refine(spark, layers, "2024-01-01", ("yyyy",)), lambda: daily.refine(spark, layers, "2024-01-01")):
        parsed.clear()
        change()
        assert parsed
    files.remove(spark, layers.silver)
    parsed.clear()
    daily.refine(spark, layers, "2024-01-01")
    assert parsed and daily.silver_rows(spark, layers).count() == 2


def test_a_value_that_moves_to_an_empty_cell_is_a_change(spark, tmp_path, raw_row):
    load = lambda name, **cells: daily.run_daily(
        spark, f"{tmp_path}/lake", _batch(spark, tmp_path, raw_row, name, cells), "2024-01-01"
    )[0]
    load("a", Season="gold", Promotion="NA")
    star = load("b", Season="NA", Promotion="gold")
    assert rows(star.FactSales.join(star.DimPromotion, "Promotion_Key").select("Promotion")) == [("Gold",)]


def test_parsed_rows_are_stored_without_what_follows_from_them(spark, tmp_path, raw_row, monkeypatch):
    layers, staged = daily.Layers(f"{tmp_path}/lake"), {}
    put = daily.stage
    monkeypatch.setattr(daily, "stage", lambda df, label: (staged.__setitem__(label, df.columns), put(df, label))[1])
    first = _batch(spark, tmp_path, raw_row, "a", {}, {"Transaction_ID": "2", "Total_Cost": "x"})
    daily.run_daily(spark, layers.root, first, "2024-01-01")
    assert not set(staged["marked"]) & set(silver.DERIVED)
    rejects = spark.read.parquet(layers.rejects)
    assert rows(rejects.select("Year", "Month_Name", "Product_Array", "faults")) == [(2024, "March", ["milk", "bread"], ["bad_cost"])]
    assert {n.split(".")[-2] for names in files.data_files(spark, layers.current).values() for n in names} == {"zstd"}


def test_buckets_that_held_no_files_are_looked_at_once(spark, tmp_path, monkeypatch):
    looks, listed = [], buckets.data_files
    monkeypatch.setattr(buckets, "data_files", lambda s, place: (looks.append(place.rsplit("=", 1)[-1]), listed(s, place))[1])
    put = lambda names: buckets.replace_buckets(
        spark.createDataFrame([(1, n) for n in names] or [], "id int, bucket string"), f"{tmp_path}/t", ["n1", "n2"]
    )
    put(["n1"])
    assert looks == ["n1", "n2"]
    put(["n2"])
    assert looks[2:] == ["n1", "n2", "n1"]
    assert [r[0] for r in rows(spark.read.parquet(f"{tmp_path}/t").select("bucket"))] == ["n2"]


def test_parts_of_buckets_are_partitions_of_their_own(spark):
    sales = spark.createDataFrame([(i, 20240101, 1, 2.5, f"n{i % 3}") for i in range(30)], "Transaction_ID long, Date_Key int, Customer_Key int, Total_Cost double, bucket string")
    bridge = spark.createDataFrame([(i, 7, f"n{i % 3}") for i in range(30)], "Transaction_ID long, Product_Key int, bucket string")
    found = kept.baskets(sales, bridge, (BUCKET,), ["n0", "n1", "n2", "h5"])
    # Adaptive execution merges small partitions where the number is left to it.
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert f"{3 * buckets.SLOTS + 1}), REPARTITION_BY_NUM" in plan and "AQEShuffleRead coalesced" not in plan
    assert found.count() == 30 and all(len(r["Sales"]) == len(r["Lines"]) == 1 for r in found.collect())


def test_a_load_opens_no_star(spark, tmp_path, raw_row, monkeypatch):
    def refuse(*_):
        raise AssertionError("opening the star lists every folder of the warehouse")

    with monkeypatch.context() as patched:
        patched.setattr(daily.Star, "stored", refuse)
        counts = daily.load(spark, f"{tmp_path}/lake", _batch(spark, tmp_path, raw_row, "a", {}), "2024-01-01", span=10)
    star, again = daily.run_daily(spark, f"{tmp_path}/lake", _batch(spark, tmp_path, raw_row, "a", {}), "2024-01-01", span=10)
    assert again == counts and star.FactSales.count() == 1


def test_lists_of_the_landing_files_are_made_behind_the_shuffle(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = tables(spark, "/root/testdata/sf0.001")._baskets()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    lines = plan.splitlines()
    made = next(i for i, line in enumerate(lines) if "partial_collect_list" in line)
    assert "ObjectHashAggregate" in lines[made - 1] and "Exchange" not in lines[made - 1]
    assert any("Exchange hashpartitioning(l_orderkey" in line for line in lines[made:])
