import pytest
from helpers import rows
from pyspark.sql import functions as F

from martloom import schemas
from martloom.sources import readers, writers


def test_csv_keeps_line_breaks_and_quotes(spark, tmp_path, raw_row):
    cells = raw_row(Customer_Name='Ann "A" Lee', Product="['milk',\n 'bread']")
    path = tmp_path / "a.csv"
    quoted = ",".join('"' + c.replace('"', '""') + '"' for c in cells)
    path.write_text(",".join(schemas.RAW_COLUMNS) + "\n" + quoted + "\n")
    assert rows(readers.read_any(spark, str(path))) == [cells]


def test_unknown_formats_are_refused():
    for bad in ("x.txt", "x.xlsx", "folder"):
        with pytest.raises(ValueError):
            readers.format_of(bad)


def test_batch_unions_formats_by_name(spark, tmp_path, raw_row):
    df = spark.createDataFrame([raw_row()], schemas.RAW)
    writers.write_layer(df, f"{tmp_path}/a.csv", "csv")
    df.select(*reversed(schemas.RAW_COLUMNS)).write.parquet(f"{tmp_path}/b.parquet")
    df.write.json(f"{tmp_path}/c.json")
    batch = readers.load_daily_batch(spark, [f"{tmp_path}/{n}" for n in ("a.csv", "b.parquet", "c.json")])
    assert rows(batch) == [raw_row()] * 3


def test_empty_batch_is_an_error(spark):
    with pytest.raises(ValueError):
        readers.load_daily_batch(spark, [])


def test_csv_write_keeps_blanks_and_joins_arrays(spark, tmp_path):
    df = spark.createDataFrame([("  x ", ["a", "b"])], "t string, arr array<string>")
    writers.write_layer(df, f"{tmp_path}/o", "csv")
    assert rows(spark.read.csv(f"{tmp_path}/o", header=True)) == [("  x ", "a, b")]


def test_bronze_rewrite_touches_only_its_batch(spark, tmp_path, bronze_of):
    root = f"{tmp_path}/bronze"
    writers.write_bronze(bronze_of({}), root, "2024-01-01")
    writers.write_bronze(bronze_of({}, {"Transaction_ID": "2"}), root, "2024-01-02")
    writers.write_bronze(bronze_of({}, {"Transaction_ID": "2"}), root, "2024-01-02")
    stored = lambda: spark.read.parquet(root).groupBy(F.col("batch_date").cast("string")).count()
    assert sorted(rows(stored())) == [("2024-01-01", 1), ("2024-01-02", 2)]
    writers.write_bronze(bronze_of({}).filter("false"), root, "2024-01-02")
    assert rows(stored()) == [("2024-01-01", 1)]


def test_staged_cells_keep_line_breaks_and_quotes(spark, tmp_path):
    written = [(1, 'Ann\n"Lee", jr', "Gold"), (2, None, "a\r\nb")]
    df = spark.createDataFrame(written, "Customer_Key int, Customer_Name string, Customer_Category string")
    writers.write_layer(df, f"{tmp_path}/DimCustomer", "csv")
    assert sorted(rows(readers.read_staging(spark, str(tmp_path), "DimCustomer"))) == written
    text = readers.read_staging(spark, str(tmp_path), "DimCustomer", typed=False).filter("Customer_Key <> 'Customer_Key'")
    assert sorted(rows(text)) == [(str(k), n, c) for k, n, c in written]


def test_batch_filter_prunes_partitions(spark, tmp_path, bronze_of):
    from martloom.plans import daily

    layers = daily.Layers(str(tmp_path))
    for day in ("2024-01-01", "2024-01-02"):
        writers.write_bronze(bronze_of({}), layers.bronze, day)
    batch = daily.bronze_batch(spark, layers, "2024-01-02")
    assert batch.count() == 1
    assert len(batch.inputFiles()) >= 1
    assert "PartitionFilters: [isnotnull(batch_date" in batch._jdf.queryExecution().executedPlan().toString()


def test_typed_staging_skips_header_and_text_staging_keeps_it(spark, tmp_path):
    table = tmp_path / "DimStore"
    table.mkdir()
    (table / "part.csv").write_text('Store_Key,City,Store_Type\n1,Oslo,"a,b"\nx,Bergen,c\n')
    typed = readers.read_staging(spark, str(tmp_path), "DimStore", typed=True)
    assert rows(typed) == [(1, "Oslo", "a,b"), (None, "Bergen", "c")]
    assert readers.read_staging(spark, str(tmp_path), "DimStore", typed=False).count() == 3


BROKEN = ["a\nb", "\r\n", "~n", "~~\n~t~r", '"q", ~', "", "plain", None, "~", "\r", " x ", "a b"]


def test_cells_on_one_line_come_back_as_they_were(spark, tmp_path):
    from martloom.functions import text

    cells = spark.createDataFrame([(i, c) for i, c in enumerate(BROKEN)], "i int, c string")
    both = cells.select("c", text.one_line(F.col("c")).alias("w"), text.restored(text.one_line(F.col("c"))).alias("r"))
    for c, w, r in rows(both):
        assert r == c and (w is None or not set("\r\n") & set(w))
    path = f"{tmp_path}/cells.csv"
    writers.write_layer(cells, path, "csv", one_line=True)
    found = dict(rows(readers.read_csv(spark, path, cells.schema, one_line=True)))
    # An empty cell is no value in a CSV file.
    assert found == {i: c or None for i, c in enumerate(BROKEN)}


def test_one_file_of_one_line_records_is_read_by_several_tasks(spark, tmp_path):
    cells = spark.range(4000).select(F.col("id").cast("int").alias("i"), F.concat(F.lit("line\n"), F.col("id").cast("string")).alias("c"))
    one, other = f"{tmp_path}/one.csv", f"{tmp_path}/other.csv"
    writers.write_layer(cells.coalesce(1), one, "csv", one_line=True)
    writers.write_layer(cells.coalesce(1), other, "csv")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        split = readers.read_csv(spark, one, cells.schema, one_line=True)
        whole = readers.read_csv(spark, other, cells.schema)
        parts = lambda df: df.select(F.spark_partition_id(), F.input_file_name()).distinct()
        assert parts(split).count() > 4 and parts(whole).count() == 1
        assert sorted(rows(split)) == sorted(rows(whole)) == sorted(rows(cells))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
