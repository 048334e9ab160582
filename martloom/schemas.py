"""Column contracts of every layer."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)


def _struct(required: str, **columns: DataType) -> StructType:
    must = set(required.split())
    return StructType([StructField(n, t, n not in must) for n, t in columns.items()])


_TEXT, _INT, _LONG, _DOUBLE = StringType(), IntegerType(), LongType(), DoubleType()

# The 13 columns of a transaction file, in file order, all read as text.
RAW_COLUMNS = (
    "Transaction_ID",
    "Date",
    "Customer_Name",
    "Product",
    "Total_Items",
    "Total_Cost",
    "Payment_Method",
    "City",
    "Store_Type",
    "Discount_Applied",
    "Customer_Category",
    "Season",
    "Promotion",
)
RAW = StructType([StructField(name, _TEXT, True) for name in RAW_COLUMNS])

# Columns whose text is put into title case and cleared of placeholder words.
CATEGORY_COLUMNS = (
    "Customer_Name",
    "Payment_Method",
    "City",
    "Store_Type",
    "Customer_Category",
    "Season",
    "Promotion",
)

# Names, types and required columns of the warehouse tables.
WAREHOUSE: dict[str, StructType] = {
    "DimCustomer": _struct(
        "Customer_Key", Customer_Key=_INT, Customer_Name=_TEXT, Customer_Category=_TEXT
    ),
    "DimDate": _struct(
        "Date_Key",
        Date_Key=_INT,
        Full_Date=DateType(),
        Day=_INT,
        Month=_INT,
        Month_Name=_TEXT,
        Quarter=_INT,
        Year=_INT,
        Season=_TEXT,
    ),
    "DimProduct": _struct("Product_Key", Product_Key=_INT, Product_Name=_TEXT),
    "DimPromotion": _struct(
        "Promotion_Key", Promotion_Key=_INT, Promotion=_TEXT, Discount_Applied=BooleanType()
    ),
    "DimStore": _struct("Store_Key", Store_Key=_INT, City=_TEXT, Store_Type=_TEXT),
    "FactSales": _struct(
        "Transaction_ID Date_Key Customer_Key Store_Key",
        Transaction_ID=_LONG,
        Date_Key=_INT,
        Customer_Key=_INT,
        Store_Key=_INT,
        Promotion_Key=_INT,
        Total_Items=_INT,
        Total_Cost=_DOUBLE,
    ),
    "FactProductBridge": _struct(
        "Transaction_ID Product_Key", Transaction_ID=_LONG, Product_Key=_INT
    ),
}
TABLES = tuple(WAREHOUSE)

# Facts of the gold layer, whose transaction ids are text still.
GOLD_FACTS = {
    "FactSales": (
        "Transaction_ID string, Date_Key int, Customer_Key int, Store_Key int, Promotion_Key int, "
        "Total_Items int, Total_Cost double"
    ),
    "FactProductBridge": "Transaction_ID string, Product_Key int",
}

MONTH = "Month_Key"  # YYYYMM, a folder level of the stored fact

_FIGURES = "amount decimal(38,6), costed long, sales long, items long, counted long"
# Tables that the daily load keeps beside the warehouse, all of them by buckets of transactions.
KEPT = {
    "DailySums": f"Date_Key int, Customer_Key int, Store_Key int, Promotion_Key int, {_FIGURES}, bucket string",
    "CustomerParts": f"Customer_Key int, first_day date, last_day date, dated long, orders long, {_FIGURES}, bucket string",
    "Baskets": (
        "Transaction_ID long, Sales array<struct<Date_Key:int,Customer_Key:int,Total_Cost:double,n:long>>, "
        "Lines array<struct<Product_Key:int,n:long>>, bucket string"
    ),
}


def stored(table: str) -> StructType:
    """Columns of a stored warehouse table whatever its folders are; folder levels come on top of them."""
    return StructType([StructField(f.name, f.dataType) for f in WAREHOUSE[table].fields])


# Types a staged file column already has in the typed flavour; anything else stays text there.
_STAGED_TYPED = (IntegerType, LongType, DoubleType)


def staging(table: str, typed: bool) -> StructType:
    """Schema of the staged CSV of ``table``: numbers typed, or every column as text."""
    return StructType(
        [
            StructField(f.name, f.dataType if typed and isinstance(f.dataType, _STAGED_TYPED) else _TEXT)
            for f in WAREHOUSE[table]
        ]
    )


def required(table: str) -> list[str]:
    return [f.name for f in WAREHOUSE[table] if not f.nullable]
