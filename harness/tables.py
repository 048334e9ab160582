"""The given tables mapped to a clean star schema and to dirty transaction files.

Each derived table is stored once per Spark application and folder of given tables, in the cluster's
shared folder, and read back from there: load once, query many times.
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterator, Mapping
from functools import cached_property, partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom import schemas
from martloom.functions.dates import date_key
from martloom.functions.numbers import exact, money
from martloom.operators import gold, silver, warehouse
from martloom.plans import daily
from martloom.plans.sizes import broadcast_by_size
from martloom.plans.star import Star
from martloom.sources import readers, writers
from martloom.sources.staging import new_folder, stage

BATCH_DATE = "2026-07-07"
LATER_DATE = "2026-07-08"
SPAN = 1 << 17  # transaction ids in a bucket of the lake

# Names used by the mapping from the given tables.
STORE_TYPES = {"P": "pop-up stand", "F": "flagship store", "O": "online shop"}
PAYMENTS = ["cash", "card", "mobile"]
TOKENS = ["NA", "N/A", "NULL", "None", "-", ""]
COSTS = ["abc", "-5", "NaN", "1e300", "0.004"]
UNSPECIFIED = "4-NOT SPECIFIED"


def _pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _season(day: Column) -> Column:
    month = F.month(day)
    return (
        F.when(month.isin(12, 1, 2), "Winter")
        .when(month.isin(3, 4, 5), "Spring")
        .when(month.isin(6, 7, 8), "Summer")
        .otherwise("Fall")
    )


class Landing(Mapping):
    """Folders of the dirty transactions by format, each written when it is first asked for.

    The Parquet one is made first, the others are copies of it. Text is packed: CSV with line breaks in its
    cells is read one task per file in any case, and the files are as many as the tasks that wrote them.
    """

    FORMATS = ("csv", "json", "parquet")

    def __init__(self, root: str, raw: Callable[[], DataFrame]):
        self.root, self.raw = root, raw
        self._written: dict[str, str] = {}

    def __getitem__(self, fmt: str) -> str:
        if fmt not in self.FORMATS:
            raise KeyError(fmt)
        if fmt not in self._written:
            path = f"{self.root}/transactions.{fmt}"
            if fmt == "parquet":
                writers.write_layer(self.raw(), path)
            else:
                stored = self["parquet"]
                rows = readers.read_any(self.raw().sparkSession, stored)
                if fmt == "csv":
                    writers.write_layer(rows, path, "csv", compression="gzip")
                else:
                    rows.write.json(path, compression="gzip")
            self._written[fmt] = path
        return self._written[fmt]

    def __iter__(self) -> Iterator[str]:
        return iter(self.FORMATS)

    def __len__(self) -> int:
        return len(self.FORMATS)


class Tables:
    """Lazy access to everything derived from one folder of given tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def given(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # --- clean star --------------------------------------------------------------------------

    def _order_lines(self) -> DataFrame:
        return self.given("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
            F.sum("l_quantity").cast("int").alias("items"),
            money(F.sum(exact(F.col("l_extendedprice")))).alias("cost"),
            (F.max("l_discount") >= 0.08).alias("discounted"),
        )

    def _star_fact(self) -> DataFrame:
        orders = self.given("orders").join(self._order_lines(), "o_orderkey")
        nations = self.given("customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
        status = F.array_position(F.array(*[F.lit(s) for s in STORE_TYPES]), F.col("o_orderstatus"))
        level = F.left("o_orderpriority", F.lit(1)).cast("int")
        promotion = level * 2 - F.when(F.col("discounted"), 0).otherwise(1)
        return orders.join(nations, "o_custkey").select(
            F.col("o_orderkey").alias("Transaction_ID"),
            date_key(F.col("o_orderdate")).alias("Date_Key"),
            (F.col("o_custkey") + 1).cast("int").alias("Customer_Key"),
            (F.col("c_nationkey") * 3 + status).cast("int").alias("Store_Key"),
            F.when(F.col("o_orderpriority") == UNSPECIFIED, warehouse.UNKNOWN_PROMOTION)
            .otherwise(promotion)
            .cast("int")
            .alias("Promotion_Key"),
            F.col("items").alias("Total_Items"),
            # Some amounts have more than two decimals.
            F.when(F.col("o_orderkey") % 101 == 0, F.col("cost") + 0.004).otherwise(F.col("cost")).alias("Total_Cost"),
        )

    def _star_calendar(self) -> DataFrame:
        day = F.col("Full_Date")
        days = self.given("orders").select(F.to_date("o_orderdate").alias("Full_Date")).distinct()
        return days.select(
            date_key(day).alias("Date_Key"),
            "Full_Date",
            F.dayofmonth(day).alias("Day"),
            F.month(day).alias("Month"),
            F.date_format(day, "MMMM").alias("Month_Name"),
            F.quarter(day).alias("Quarter"),
            F.year(day).alias("Year"),
            _season(day).alias("Season"),
        )

    def _star_promotions(self) -> DataFrame:
        levels = self.given("orders").select("o_orderpriority").distinct()
        level = F.left("o_orderpriority", F.lit(1)).cast("int")
        flags = F.explode(F.array(F.lit(False), F.lit(True))).alias("Discount_Applied")
        named = F.when(F.col("o_orderpriority") != UNSPECIFIED, F.col("o_orderpriority"))
        return levels.select(level.alias("level"), named.alias("named"), flags).select(
            (F.col("level") * 2 - F.when(F.col("Discount_Applied"), 0).otherwise(1))
            .cast("int")
            .alias("Promotion_Key"),
            F.coalesce("named", F.lit(warehouse.NO_PROMOTION)).alias("Promotion"),
            "Discount_Applied",
        )

    def _star_stores(self) -> DataFrame:
        types = F.posexplode(F.array(*[F.lit(v) for v in STORE_TYPES.values()])).alias("at", "Store_Type")
        stores = self.given("nation").select("n_nationkey", "n_name", types)
        return stores.select(
            (F.col("n_nationkey") * 3 + F.col("at") + 1).cast("int").alias("Store_Key"),
            F.col("n_name").alias("City"),
            "Store_Type",
        )

    def _star_frames(self) -> dict[str, Callable[[], DataFrame]]:
        return {
            "DimCustomer": lambda: self.given("customer").select(
                (F.col("c_custkey") + 1).cast("int").alias("Customer_Key"),
                F.col("c_name").alias("Customer_Name"),
                F.col("c_mktsegment").alias("Customer_Category"),
            ),
            "DimDate": self._star_calendar,
            "DimProduct": lambda: self.given("part").select(
                (F.col("p_partkey") + 1).cast("int").alias("Product_Key"),
                F.col("p_name").alias("Product_Name"),
            ),
            "DimPromotion": self._star_promotions,
            "DimStore": self._star_stores,
            "FactSales": self._star_fact,
            "FactProductBridge": lambda: self.given("lineitem").select(
                F.col("l_orderkey").alias("Transaction_ID"),
                (F.col("l_partkey") + 1).cast("int").alias("Product_Key"),
            ),
        }

    @cached_property
    def star(self) -> Star:
        """Clean star, written by the library's own warehouse writer."""
        root = new_folder(self.spark, "star")
        writers.write_warehouse(self._star_frames(), root)
        return Star.stored(self.spark, root)

    @cached_property
    def spoiled(self) -> dict[str, DataFrame]:
        """The star with faults by fixed rules: dates outside the calendar, lost measures and names, repeated keys."""
        sale, product = F.col("Transaction_ID"), F.col("Product_Key")
        frames = {n: getattr(self.star, n) for n in schemas.TABLES}
        frames["FactSales"] = frames["FactSales"].withColumns(
            {
                "Date_Key": F.when(sale % 53 == 0, 99991231).otherwise(F.col("Date_Key")),
                "Total_Items": F.when(sale % 59 != 0, F.col("Total_Items")),
                "Total_Cost": F.when(sale % 67 != 0, F.col("Total_Cost")),
            }
        )
        frames["DimProduct"] = frames["DimProduct"].withColumn(
            "Product_Name", F.when(product % 61 != 0, F.col("Product_Name"))
        )
        for name, key in gold.KEYS.items():
            frames[name] = frames[name].unionByName(frames[name].filter(F.col(key) % 3 == 0))
        return {n: stage(f, f"spoiled-{n}") for n, f in frames.items()}

    # --- dirty files -------------------------------------------------------------------------

    def _baskets(self) -> DataFrame:
        parts = self.given("part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
        lines = self.given("lineitem").select(
            "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount"
        )
        # Lines of an order lie apart, so lists made before the shuffle would be as many as lines. Names are looked
        # up behind it where that takes no shuffle of its own.
        if broadcast_by_size(parts):
            lines = lines.repartition("l_orderkey").join(parts, "l_partkey")
        else:
            lines = lines.join(parts, "l_partkey").repartition("l_orderkey")
        listed = F.array_sort(F.collect_list(F.struct("l_linenumber", "p_name")))
        return lines.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
            listed["p_name"].alias("names"),
            F.sum("l_quantity").cast("int").alias("items"),
            F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("cost"),
            (F.max("l_discount") >= 0.08).alias("discounted"),
        )

    def dirty_raw(self) -> DataFrame:
        """One text row per order, spoiled by fixed rules on its key."""
        key = F.col("o_orderkey")
        customers = self.given("customer").select(
            F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment", "c_nationkey"
        )
        nations = self.given("nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
        rows = (
            self.given("orders")
            .join(customers, "o_custkey")
            .join(nations, "c_nationkey")
            .join(self._baskets(), "o_orderkey", "left")
        )

        day = F.col("o_orderdate")
        clock = F.date_format(F.timestamp_seconds(key * 37 % 86400), "HH:mm:ss")

        def written(pattern: str, with_clock: bool = True) -> Column:
            text = F.date_format(day, pattern)
            return F.concat(text, F.lit(" "), clock) if with_clock else text

        date_text = (
            F.when(key % 103 == 0, "not a date")
            .when(key % 5 == 1, written("yyyy-MM-dd", False))
            .when(key % 5 == 2, written("dd-MM-yyyy"))
            .when(key % 5 == 3, written("dd/MM/yyyy"))
            .when((key % 5 == 4) & (F.dayofmonth(day) > 12), written("MM/dd/yyyy"))
            .otherwise(written("yyyy-MM-dd"))
        )

        def untidy(c: Column) -> Column:
            return (
                F.when(key % 14 == 0, F.concat(F.lit("  "), F.upper(c), F.lit(" ")))
                .when(key % 14 == 7, F.concat(F.lit(" "), F.lower(c), F.lit("  ")))
                .otherwise(c)
            )

        def blotted(c: Column) -> Column:
            return F.when(key % 11 == 0, _pick(TOKENS, F.floor(key / 11) % 6)).otherwise(c)

        promotion = F.when(F.col("o_orderpriority") != UNSPECIFIED, F.col("o_orderpriority"))
        store = F.element_at(
            F.create_map(*[F.lit(x) for pair in STORE_TYPES.items() for x in pair]), F.col("o_orderstatus")
        )
        discounted = F.coalesce("discounted", F.lit(False))
        flag_text = (
            F.when(key % 13 == 12, "maybe")
            .when(discounted, _pick(["Yes", "TRUE", "1"], key % 13 % 3))
            .otherwise(_pick(["No", "false", "0"], key % 13 % 3))
        )
        cost_text = F.when(key % 101 == 0, _pick(COSTS, F.floor(key / 101) % 5)).otherwise(
            F.col("cost").cast("string")
        )
        quoted = F.transform("names", lambda n: F.concat(F.lit("'"), n, F.lit("'")))
        product = F.concat(F.lit("["), F.concat_ws(", ", quoted), F.lit("]"))
        copies = F.explode(
            F.when(key % 97 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
        )
        values = {
            "Transaction_ID": key.cast("string"),
            "Date": date_text,
            # Cells with a line break and quotes.
            "Customer_Name": untidy(
                F.when(key % 17 == 0, F.concat("c_name", F.lit('\n"jr", ltd'))).otherwise(F.col("c_name"))
            ),
            "Product": F.coalesce(product, F.lit("[]")),
            "Total_Items": F.col("items").cast("string"),
            "Total_Cost": cost_text,
            "Payment_Method": untidy(_pick(PAYMENTS, key % 3)),
            "City": untidy(F.col("n_name")),
            "Store_Type": untidy(store),
            "Discount_Applied": flag_text,
            "Customer_Category": untidy(blotted(F.col("c_mktsegment"))),
            "Season": untidy(_season(day)),
            "Promotion": untidy(blotted(promotion)),
        }
        return rows.select(*[values[c].alias(c) for c in schemas.RAW_COLUMNS], copies.alias("copy")).drop("copy")

    @cached_property
    def landing(self) -> Landing:
        """The dirty transactions as a CSV, a JSON and a Parquet folder, each of them whole."""
        return Landing(new_folder(self.spark, "landing"), self.dirty_raw)

    @cached_property
    def later_landing(self) -> str:
        """A second batch: the stores of one type send all their transactions again, corrected."""
        path = new_folder(self.spark, "later") + ".csv"
        again = self.raw().filter(F.lower(F.trim("Store_Type")) == "pop-up stand")
        corrected = again.withColumns({"City": F.lit("Second City"), "Total_Items": F.lit("9")})
        writers.write_layer(corrected, path, "csv", compression="gzip")
        return path

    @cached_property
    def lake(self) -> daily.Layers:
        """Both batches through the whole daily load; the first one is loaded once more at the end."""
        root = new_folder(self.spark, "lake")
        for paths, day in (
            ([self.landing["csv"]], BATCH_DATE),
            ([self.later_landing], LATER_DATE),
            ([self.landing["csv"]], BATCH_DATE),
        ):
            daily.load(self.spark, root, paths, day, span=SPAN)
        return daily.Layers(root, SPAN)

    @cached_property
    def lake_star(self) -> Star:
        """The warehouse of the lake, with all that the daily load keeps beside it."""
        return Star.stored(self.spark, self.lake.warehouse)

    def raw(self) -> DataFrame:
        return readers.load_daily_batch(self.spark, [self.landing["csv"]])

    @cached_property
    def bronze(self) -> DataFrame:
        return stage(readers.with_audit(self.raw(), BATCH_DATE), "bronze")

    @cached_property
    def silver(self) -> DataFrame:
        return stage(silver.refine(self.bronze), "silver")

    # --- gold and staging --------------------------------------------------------------------

    @cached_property
    def gold(self) -> dict[str, DataFrame]:
        """Gold tables at timestamp grain, each stored."""
        root = new_folder(self.spark, "gold")
        writers.write_gold(gold.dimension_builders(self.silver, by_timestamp=True), root)
        dims = {n: self.spark.read.parquet(f"{root}/{n}") for n in gold.KEYS}
        facts = {
            "FactSales": gold.sales_fact(self.silver, dims, by_timestamp=True),
            "FactProductBridge": gold.product_bridge(self.silver, dims["DimProduct"]),
        }
        writers.write_gold(facts, root)
        return dims | {n: self.spark.read.parquet(f"{root}/{n}") for n in facts}

    @cached_property
    def staging_root(self) -> str:
        """The gold tables as CSV files of one record a line, product names with their list marks left on."""
        root = new_folder(self.spark, "staging")
        verbatim = silver.add_products(self.silver, verbatim=True)
        products = partial(gold.product_dimension, verbatim)
        writers.write_gold({**self.gold, "DimProduct": products}, root, "csv", one_line=True)
        return root

    def staged(self, table: str, typed: bool) -> DataFrame:
        return readers.read_staging(self.spark, self.staging_root, table, typed, one_line=True)

    @cached_property
    def gold_copy(self) -> str:
        root = new_folder(self.spark, "gold-copy")
        writers.write_gold(self.gold, root)
        return root

    def _stored(self, loaded: dict[str, DataFrame], label: str) -> tuple[str, DataFrame]:
        root = new_folder(self.spark, label)
        kept, rejects = warehouse.enforce(loaded)
        writers.write_warehouse(kept, root)
        return root, stage(rejects, f"{label}-rejects")

    @cached_property
    def warehouse_typed(self) -> tuple[str, DataFrame]:
        """Root of the tables loaded from typed staging, and the rows that may not be stored."""
        return self._stored(warehouse.load_typed(self.spark, self.staging_root, one_line=True), "typed")

    @cached_property
    def warehouse_text(self) -> tuple[str, DataFrame]:
        return self._stored(warehouse.load_text(self.spark, self.staging_root, one_line=True), "text")

    @cached_property
    def text_sales(self) -> DataFrame:
        """The dirty batch's fact loaded from text staging: it keeps its null keys."""
        return stage(warehouse.load_sales_text(self.staged("FactSales", typed=False)), "text-sales")


_OPEN: dict[tuple[str, str], Tables] = {}
_LOCK = threading.Lock()


def tables(spark: SparkSession, sf_dir: str) -> Tables:
    """The derived tables of a folder, shared by all queries of one Spark application."""
    name = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    with _LOCK:
        if name not in _OPEN:
            _OPEN[name] = Tables(spark, sf_dir)
        return _OPEN[name]
