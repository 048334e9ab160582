"""Staged files to warehouse tables, in two flavours: typed staging and all-text staging."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom import schemas
from martloom.functions import flags, text
from martloom.functions.dates import date_key, leading_date
from martloom.functions.numbers import misfit, to_double
from martloom.sources.readers import read_staging

# Words and key of the missing promotion.
UNKNOWN_PROMOTION = -1
NO_PROMOTION = "No Promotion"
_NULL_WORD = "(NULL)"


def drop_header_rows(df: DataFrame, column: str) -> DataFrame:
    """Drop lines that repeat the column name; rows with a null there are kept."""
    return df.filter(~F.col(column).eqNullSafe(F.lit(column)))


def _key(name: str) -> Column:
    return F.col(name).try_cast("int").alias(name)


def _text_rows(df: DataFrame, key: str, named: str, kind: str = "int") -> DataFrame:
    # A plain `!=` on purpose: this flavour also drops rows whose named column is null.
    return df.filter(F.col(key).try_cast(kind).isNotNull() & (F.col(named) != F.lit(named)))


# --- typed staging -----------------------------------------------------------------------------


def load_customers(staged: DataFrame) -> DataFrame:
    return staged.select(
        "Customer_Key",
        F.trim("Customer_Name").alias("Customer_Name"),
        F.trim("Customer_Category").alias("Customer_Category"),
    )


def load_calendar(staged: DataFrame) -> DataFrame:
    """Timestamp-grain rows to one row per day under a YYYYMMDD key."""
    parts = ["Day", "Month", "Month_Name", "Quarter", "Year", "Season"]
    return (
        staged.withColumn("Full_Date", leading_date(F.col("Full_Date")))
        .filter(F.col("Full_Date").isNotNull())
        .groupBy("Full_Date")
        .agg(*[F.max(p).alias(p) for p in parts])
        .select(date_key(F.col("Full_Date")).alias("Date_Key"), "Full_Date", *parts)
    )


def load_products(staged: DataFrame) -> DataFrame:
    """Names without ``]`` and ``'``, trimmed, lower case."""
    name = F.lower(F.trim(text.strip_marks(F.col("Product_Name"), "]'")))
    return staged.select("Product_Key", name.alias("Product_Name"))


def load_products_cleaned(staged: DataFrame) -> DataFrame:
    """Names with every list mark removed: one spelling per product."""
    return staged.select("Product_Key", text.clean_product(F.col("Product_Name")).alias("Product_Name"))


def load_promotions(staged: DataFrame) -> DataFrame:
    return staged.select(
        "Promotion_Key",
        F.coalesce(F.trim("Promotion"), F.lit(NO_PROMOTION)).alias("Promotion"),
        flags.to_flag(F.col("Discount_Applied"), flags.TYPED_STAGING_FLAG).alias("Discount_Applied"),
    )


def with_unknown_promotion(promotions: DataFrame) -> DataFrame:
    """Adds the member that sales without a promotion key point to."""
    spark = promotions.sparkSession
    member = spark.range(1).select(
        F.lit(UNKNOWN_PROMOTION).alias("Promotion_Key"),
        F.lit(NO_PROMOTION).alias("Promotion"),
        F.lit(False).alias("Discount_Applied"),
    )
    return promotions.unionByName(member)


def load_stores(staged: DataFrame) -> DataFrame:
    return staged.select(
        "Store_Key", F.trim("City").alias("City"), F.trim("Store_Type").alias("Store_Type")
    )


def remapped_sales(
    staged: DataFrame, staged_dates: DataFrame | None, carried: tuple[str, ...] = ()
) -> DataFrame:
    """Priced fact rows at day grain. Without ``staged_dates`` the staged key is a day's key already."""
    sound = F.col("Transaction_ID").isNotNull() & (to_double(F.col("Total_Cost")) >= 0)
    rows = staged.filter(sound)
    columns = [
        "Customer_Key",
        "Store_Key",
        F.coalesce("Promotion_Key", F.lit(UNKNOWN_PROMOTION)).alias("Promotion_Key"),
        "Total_Items",
        "Total_Cost",
        *carried,
    ]
    if staged_dates is None:
        return rows.select("Transaction_ID", "Date_Key", *columns)
    days = staged_dates.select(
        F.col("Date_Key").alias("_moment"), date_key(leading_date(F.col("Full_Date"))).alias("_day")
    )
    joined = rows.join(days, rows["Date_Key"] == days["_moment"], "left")
    return joined.select("Transaction_ID", F.col("_day").alias("Date_Key"), *columns)


def faults(table: str) -> Column:
    """Names of the reasons why a row may not be stored in ``table``; empty for a sound row."""
    named = [F.when(F.col(c).isNull(), F.lit(f"no_{c}")) for c in schemas.required(table)]
    if table == "FactSales":
        named.append(F.when(misfit(F.col("Total_Cost")), F.lit("cost_out_of_range")))
    return F.array_compact(F.array(*named))


def split_by_required(df: DataFrame, table: str) -> tuple[DataFrame, DataFrame]:
    """Rows that may be stored in ``table``, and rows that lack a column it requires or cannot be summed."""
    sound = F.size(faults(table)) == 0
    return df.filter(sound), df.filter(~sound)


def enforce(
    loaded: dict[str, DataFrame], carried: tuple[str, ...] = ()
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Loaded tables with sound rows only, and all other rows as ``TableName, reason, row`` (JSON text).

    ``carried`` columns, null in tables without them, follow the reason and are no part of the row.
    """
    kept, rejects = {}, []
    for table, df in loaded.items():
        kept[table], lost = split_by_required(df, table)
        rejects.append(
            lost.select(
                F.lit(table).alias("TableName"),
                F.concat_ws(",", faults(table)).alias("reason"),
                F.to_json(F.struct(*[c for c in df.columns if c not in carried])).alias("row"),
                *[(F.col(c) if c in df.columns else F.lit(None).cast("string")).alias(c) for c in carried],
            )
        )
    return kept, reduce(DataFrame.unionByName, rejects)


def load_sales(staged: DataFrame, staged_dates: DataFrame) -> DataFrame:
    """Fact rows at day grain; rows lacking a required key go to :func:`rejected_sales`."""
    return split_by_required(remapped_sales(staged, staged_dates), "FactSales")[0]


def rejected_sales(staged: DataFrame, staged_dates: DataFrame) -> DataFrame:
    """Fact rows that cannot be stored: a required key is missing, or the cost is too large to sum."""
    return split_by_required(remapped_sales(staged, staged_dates), "FactSales")[1]


def load_bridge(staged: DataFrame) -> DataFrame:
    return staged.filter(F.col("Transaction_ID").isNotNull() & F.col("Product_Key").isNotNull())


# --- all-text staging --------------------------------------------------------------------------


def load_customers_text(staged: DataFrame) -> DataFrame:
    rows = _text_rows(staged, "Customer_Key", "Customer_Name")
    return rows.select(_key("Customer_Key"), "Customer_Name", "Customer_Category")


def load_dates_text(staged: DataFrame) -> DataFrame:
    """Date rows with their staged key kept."""
    rows = _text_rows(staged, "Date_Key", "Date_Key")
    return rows.select(
        _key("Date_Key"),
        leading_date(F.col("Full_Date")).alias("Full_Date"),
        _key("Day"),
        _key("Month"),
        "Month_Name",
        _key("Quarter"),
        _key("Year"),
        "Season",
    )


def load_products_text(staged: DataFrame) -> DataFrame:
    """Names without brackets, otherwise as staged."""
    rows = _text_rows(staged, "Product_Key", "Product_Name")
    return rows.select(
        _key("Product_Key"), text.strip_marks(F.col("Product_Name"), "[]").alias("Product_Name")
    )


def load_promotions_text(staged: DataFrame) -> DataFrame:
    rows = _text_rows(staged, "Promotion_Key", "Promotion_Key")
    named = F.when(~F.col("Promotion").isin(_NULL_WORD, "Promotion"), F.col("Promotion"))
    return rows.select(
        _key("Promotion_Key"),
        F.coalesce(named, F.lit(NO_PROMOTION)).alias("Promotion"),
        flags.to_flag(F.col("Discount_Applied"), flags.TEXT_STAGING_FLAG).alias("Discount_Applied"),
    )


def load_stores_text(staged: DataFrame) -> DataFrame:
    return _text_rows(staged, "Store_Key", "Store_Key").select(_key("Store_Key"), "City", "Store_Type")


def load_sales_text(staged: DataFrame) -> DataFrame:
    """Fact rows with every column cast; null keys stay null."""
    rows = _text_rows(staged, "Transaction_ID", "Transaction_ID", "bigint")
    return rows.select(
        F.col("Transaction_ID").try_cast("bigint").alias("Transaction_ID"),
        _key("Date_Key"),
        _key("Customer_Key"),
        _key("Store_Key"),
        _key("Promotion_Key"),
        _key("Total_Items"),
        to_double(F.col("Total_Cost")).alias("Total_Cost"),
    )


def load_bridge_text(staged: DataFrame) -> DataFrame:
    rows = _text_rows(staged, "Transaction_ID", "Transaction_ID", "bigint")
    return rows.select(
        F.col("Transaction_ID").try_cast("bigint").alias("Transaction_ID"), _key("Product_Key")
    )


# --- whole loads -------------------------------------------------------------------------------


def load_typed(
    spark: SparkSession,
    root: str,
    unknown_promotion: bool = False,
    fmt: str = "csv",
    multiline: bool = True,
    by_timestamp: bool = True,
    carried: tuple[str, ...] = (),
    one_line: bool = False,
) -> dict[str, DataFrame]:
    """All seven tables from typed staging files under ``root``; :func:`enforce` splits off what may not be stored.

    ``by_timestamp`` tells the grain of the staged dates: moments, whose keys are looked up, or days.
    ``carried`` names further columns of the two transaction-grain tables, staged as Parquet.
    """
    staged = {
        t: read_staging(
            spark, root, t, typed=True, fmt=fmt, multiline=multiline, one_line=one_line,
            carried=carried if t.startswith("Fact") else (),
        )
        for t in schemas.TABLES
    }
    promotions = load_promotions(staged["DimPromotion"])
    return {
        "DimCustomer": load_customers(staged["DimCustomer"]),
        "DimDate": load_calendar(staged["DimDate"]),
        "DimProduct": load_products_cleaned(staged["DimProduct"]),
        "DimPromotion": with_unknown_promotion(promotions) if unknown_promotion else promotions,
        "DimStore": load_stores(staged["DimStore"]),
        "FactSales": remapped_sales(staged["FactSales"], staged["DimDate"] if by_timestamp else None, carried),
        "FactProductBridge": staged["FactProductBridge"],
    }


def load_text(
    spark: SparkSession, root: str, multiline: bool = True, one_line: bool = False
) -> dict[str, DataFrame]:
    """All seven tables from all-text staging files under ``root``, null keys included."""
    staged = {
        t: read_staging(spark, root, t, typed=False, multiline=multiline, one_line=one_line) for t in schemas.TABLES
    }
    return {
        "DimCustomer": load_customers_text(staged["DimCustomer"]),
        "DimDate": load_dates_text(staged["DimDate"]),
        "DimProduct": load_products_text(staged["DimProduct"]),
        "DimPromotion": load_promotions_text(staged["DimPromotion"]),
        "DimStore": load_stores_text(staged["DimStore"]),
        "FactSales": load_sales_text(staged["FactSales"]),
        "FactProductBridge": load_bridge_text(staged["FactProductBridge"]),
    }
