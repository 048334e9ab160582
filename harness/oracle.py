"""SQL counterparts of the registered queries, written against the given tables.

Each statement starts from the given tables and shares no code with the Spark side; the named parts
below are only common table expressions.
"""

from __future__ import annotations

import re

# --- small expression helpers ------------------------------------------------------------------


def _title(x: str) -> str:
    words = f"string_split(lower({x}), ' ')"
    return f"array_to_string(list_transform({words}, lambda w: upper(w[1]) || w[2:]), ' ')"


def _category(x: str) -> str:
    bare = f"trim({x})"
    words = "('', 'NA', 'N/A', 'NULL', 'NONE', '-')"
    return f"CASE WHEN upper({bare}) NOT IN {words} THEN {_title(bare)} END"


def _exact(x: str) -> str:
    return f"sum(CAST({x} AS DECIMAL(24,6)))"


def _cash(x: str) -> str:
    return f"CAST({_exact(x)} AS DOUBLE)"


def _share(part: str, whole: str, scale: str = "1") -> str:
    return f"CAST({part} AS DOUBLE) * {scale} / nullif(CAST({whole} AS DOUBLE), 0)"


def _mean_cash(x: str) -> str:
    return f"{_cash(x)} / nullif(CAST(count({x}) AS DOUBLE), 0)"


_SEASON = """CASE WHEN month(o_orderdate) IN (12, 1, 2) THEN 'Winter'
    WHEN month(o_orderdate) IN (3, 4, 5) THEN 'Spring'
    WHEN month(o_orderdate) IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END"""

_RAW_COLUMNS = (
    "Transaction_ID, Date, Customer_Name, Product, Total_Items, Total_Cost, Payment_Method, City, "
    "Store_Type, Discount_Applied, Customer_Category, Season, Promotion"
)
_CATEGORIES = "Customer_Name Payment_Method City Store_Type Customer_Category Season Promotion".split()

# --- common table expressions ------------------------------------------------------------------

_PARTS: dict[str, str] = {}

_PARTS["order_lines"] = f"""
SELECT l_orderkey, CAST(sum(l_quantity) AS INT) AS items, {_cash('l_extendedprice')} AS cost,
       max(l_discount) >= 0.08 AS discounted
FROM lineitem GROUP BY l_orderkey"""

_PARTS["FactSales"] = """
SELECT o_orderkey AS Transaction_ID, CAST(strftime(o_orderdate, '%Y%m%d') AS INT) AS Date_Key,
       CAST(o_custkey + 1 AS INT) AS Customer_Key,
       CAST(c_nationkey * 3 + CASE o_orderstatus WHEN 'P' THEN 1 WHEN 'F' THEN 2 WHEN 'O' THEN 3 END AS INT)
         AS Store_Key,
       CAST(CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN -1
            ELSE CAST(left(o_orderpriority, 1) AS INT) * 2 - CASE WHEN discounted THEN 0 ELSE 1 END END AS INT)
         AS Promotion_Key,
       items AS Total_Items, CASE WHEN o_orderkey % 101 = 0 THEN cost + CAST(0.004 AS DOUBLE) ELSE cost END AS Total_Cost
FROM orders JOIN order_lines ON l_orderkey = o_orderkey JOIN customer ON c_custkey = o_custkey"""

_PARTS["FactProductBridge"] = """
SELECT l_orderkey AS Transaction_ID, CAST(l_partkey + 1 AS INT) AS Product_Key FROM lineitem"""

_PARTS["DimCustomer"] = """
SELECT CAST(c_custkey + 1 AS INT) AS Customer_Key, c_name AS Customer_Name,
       c_mktsegment AS Customer_Category FROM customer"""

_PARTS["DimProduct"] = """
SELECT CAST(p_partkey + 1 AS INT) AS Product_Key, p_name AS Product_Name FROM part"""

_PARTS["DimDate"] = f"""
SELECT DISTINCT CAST(strftime(o_orderdate, '%Y%m%d') AS INT) AS Date_Key,
       CAST(o_orderdate AS DATE) AS Full_Date, CAST(day(o_orderdate) AS INT) AS Day,
       CAST(month(o_orderdate) AS INT) AS Month, monthname(o_orderdate) AS Month_Name,
       CAST(quarter(o_orderdate) AS INT) AS Quarter, CAST(year(o_orderdate) AS INT) AS Year,
       {_SEASON} AS Season
FROM orders"""

_PARTS["DimPromotion"] = """
SELECT CAST(left(o_orderpriority, 1) AS INT) * 2 - CASE WHEN flag THEN 0 ELSE 1 END AS Promotion_Key,
       coalesce(nullif(o_orderpriority, '4-NOT SPECIFIED'), 'No Promotion') AS Promotion,
       flag AS Discount_Applied
FROM (SELECT DISTINCT o_orderpriority FROM orders), (VALUES (false), (true)) AS f(flag)"""

_PARTS["DimStore"] = """
SELECT CAST(n_nationkey * 3 + place AS INT) AS Store_Key, n_name AS City, kind AS Store_Type
FROM nation, (VALUES (1, 'pop-up stand'), (2, 'flagship store'), (3, 'online shop')) AS k(place, kind)"""

_PARTS["order_baskets"] = """
SELECT l_orderkey,
       string_agg('''' || p_name || '''', ', ' ORDER BY l_linenumber, p_name) AS names,
       CAST(CAST(sum(l_quantity) AS INT) AS VARCHAR) AS items,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS VARCHAR) AS cost,
       max(l_discount) >= 0.08 AS discounted
FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY l_orderkey"""


def _untidy(x: str) -> str:
    return (
        f"CASE WHEN o_orderkey % 14 = 0 THEN '  ' || upper({x}) || ' ' "
        f"WHEN o_orderkey % 14 = 7 THEN ' ' || lower({x}) || '  ' ELSE {x} END"
    )


def _blotted(x: str) -> str:
    tokens = "['NA', 'N/A', 'NULL', 'None', '-', '']"
    return f"(CASE WHEN o_orderkey % 11 = 0 THEN {tokens}[(o_orderkey // 11) % 6 + 1] ELSE {x} END)"


_NAMED = "(CASE WHEN o_orderkey % 17 = 0 THEN c_name || chr(10) || '\"jr\", ltd' ELSE c_name END)"
_CLOCK = "strftime(TIMESTAMP '1970-01-01' + to_seconds(o_orderkey * 37 % 86400), ' %H:%M:%S')"

_PARTS["written"] = f"""
SELECT CAST(o_orderkey AS VARCHAR) AS Transaction_ID,
       CASE WHEN o_orderkey % 103 = 0 THEN 'not a date'
            WHEN o_orderkey % 5 = 1 THEN strftime(o_orderdate, '%Y-%m-%d')
            WHEN o_orderkey % 5 = 2 THEN strftime(o_orderdate, '%d-%m-%Y') || {_CLOCK}
            WHEN o_orderkey % 5 = 3 THEN strftime(o_orderdate, '%d/%m/%Y') || {_CLOCK}
            WHEN o_orderkey % 5 = 4 AND day(o_orderdate) > 12 THEN strftime(o_orderdate, '%m/%d/%Y') || {_CLOCK}
            ELSE strftime(o_orderdate, '%Y-%m-%d') || {_CLOCK} END AS Date,
       {_untidy(_NAMED)} AS Customer_Name,
       '[' || coalesce(names, '') || ']' AS Product,
       items AS Total_Items,
       CASE WHEN o_orderkey % 101 = 0 THEN ['abc', '-5', 'NaN', '1e300', '0.004'][(o_orderkey // 101) % 5 + 1]
            ELSE cost END AS Total_Cost,
       {_untidy("['cash', 'card', 'mobile'][o_orderkey % 3 + 1]")} AS Payment_Method,
       {_untidy('n_name')} AS City,
       {_untidy("CASE o_orderstatus WHEN 'P' THEN 'pop-up stand' WHEN 'F' THEN 'flagship store' "
                "WHEN 'O' THEN 'online shop' END")} AS Store_Type,
       CASE WHEN o_orderkey % 13 = 12 THEN 'maybe'
            WHEN coalesce(discounted, false) THEN ['Yes', 'TRUE', '1'][o_orderkey % 13 % 3 + 1]
            ELSE ['No', 'false', '0'][o_orderkey % 13 % 3 + 1] END AS Discount_Applied,
       {_untidy(_blotted('c_mktsegment'))} AS Customer_Category,
       {_untidy(_SEASON)} AS Season,
       {_untidy(_blotted("nullif(o_orderpriority, '4-NOT SPECIFIED')"))} AS Promotion
FROM orders
JOIN customer ON c_custkey = o_custkey
JOIN nation ON n_nationkey = c_nationkey
LEFT JOIN order_baskets ON l_orderkey = o_orderkey,
LATERAL (SELECT unnest(range(CASE WHEN o_orderkey % 97 = 0 THEN 2 ELSE 1 END))) AS copies(copy)"""

# In a CSV file an empty cell is no value; JSON keeps empty text.
_PARTS["raw"] = """
SELECT * REPLACE (nullif(Customer_Category, '') AS Customer_Category, nullif(Promotion, '') AS Promotion)
FROM written"""

_FORMATS = (
    "['%Y-%m-%d %H:%M:%S', '%Y-%m-%d', '%d-%m-%Y %H:%M:%S', '%d/%m/%Y %H:%M:%S', '%m/%d/%Y %H:%M:%S', "
    "'%d-%m-%Y', '%m-%d-%Y', '%d/%m/%Y', '%m/%d/%Y', '%Y/%m/%d']"
)
_PRODUCTS = (
    "list_filter(list_transform(string_split(translate(Product, '[]''\"', ''), ','), lambda x: trim(x)), "
    "lambda x: x <> '')"
)

_PARTS["typed"] = f"""
SELECT trim(Transaction_ID) AS Transaction_ID,
       CAST(try_strptime(trim(Date), {_FORMATS}) AS TIMESTAMP) AS Date,
       {_category('Customer_Name')} AS Customer_Name, trim(Product) AS Product,
       TRY_CAST(Total_Items AS INT) AS Total_Items,
       CASE WHEN isfinite(TRY_CAST(Total_Cost AS DOUBLE)) THEN TRY_CAST(Total_Cost AS DOUBLE) END AS Total_Cost,
       {_category('Payment_Method')} AS Payment_Method, {_category('City')} AS City,
       {_category('Store_Type')} AS Store_Type,
       CASE WHEN lower(trim(Discount_Applied)) IN ('yes', 'true', '1') THEN true
            WHEN lower(trim(Discount_Applied)) IN ('no', 'false', '0') THEN false END AS Discount_Applied,
       {_category('Customer_Category')} AS Customer_Category, {_category('Season')} AS Season,
       {_category('Promotion')} AS Promotion, {_PRODUCTS} AS Product_Array
FROM raw"""

_PARTS["shaped"] = """
SELECT *, CAST(year(Date) AS INT) AS Year, CAST(month(Date) AS INT) AS Month, CAST(day(Date) AS INT) AS Day,
       CAST(quarter(Date) AS INT) AS Quarter, monthname(Date) AS Month_Name,
       Transaction_ID IS NULL AS f_id, Date IS NULL AS f_date, coalesce(Total_Items <= 0, true) AS f_items,
       coalesce(Total_Cost < 0, true) AS f_cost,
       coalesce(Total_Cost >= 1e18, false) AS f_range, coalesce(len(Product_Array), 0) = 0 AS f_products
FROM typed"""

_PARTS["valid"] = """
SELECT * FROM shaped WHERE NOT (f_id OR f_date OR f_items OR f_cost OR f_range OR f_products)"""

# Copies of a transaction are identical in this input, so any of them may be kept.
_PARTS["silver"] = "SELECT DISTINCT * EXCLUDE (f_id, f_date, f_items, f_cost, f_range, f_products) FROM valid"


def _numbered(key: str, columns: str, source: str) -> str:
    order = ", ".join(f"{c.strip()} NULLS FIRST" for c in columns.split(","))
    return f"""
SELECT CAST(row_number() OVER (ORDER BY {order}) AS INT) AS {key}, {columns}
FROM (SELECT DISTINCT {columns} FROM {source})"""


_PARTS["g_customer"] = _numbered("Customer_Key", "Customer_Name, Customer_Category", "silver")
_PARTS["g_store"] = _numbered("Store_Key", "City, Store_Type", "silver")
_PARTS["g_promotion"] = _numbered("Promotion_Key", "Promotion, Discount_Applied", "silver")
_PARTS["mentions"] = "SELECT Transaction_ID, unnest(Product_Array) AS Product_Name FROM silver"
_PARTS["g_product"] = _numbered("Product_Key", "Product_Name", "mentions")
_PARTS["g_moment"] = """
SELECT CAST(row_number() OVER (ORDER BY Full_Date, Season NULLS FIRST) AS INT) AS Date_Key, *
FROM (SELECT DISTINCT Date AS Full_Date, Day, Month, Month_Name, Quarter, Year, Season FROM silver)"""
_PARTS["g_calendar"] = """
SELECT CAST(strftime(CAST(Date AS DATE), '%Y%m%d') AS INT) AS Date_Key, CAST(Date AS DATE) AS Full_Date,
       max(Day) AS Day, max(Month) AS Month, max(Month_Name) AS Month_Name, max(Quarter) AS Quarter,
       max(Year) AS Year, max(Season) AS Season
FROM silver GROUP BY 1, 2"""


def _gold_fact(date_key: str, same: str) -> str:
    return f"""
SELECT s.Transaction_ID, {date_key} AS Date_Key, c.Customer_Key, t.Store_Key, p.Promotion_Key,
       s.Total_Items, s.Total_Cost
FROM silver s
LEFT JOIN g_customer c ON s.Customer_Name {same} c.Customer_Name AND s.Customer_Category {same} c.Customer_Category
LEFT JOIN g_store t ON s.City {same} t.City AND s.Store_Type {same} t.Store_Type
LEFT JOIN g_promotion p ON s.Promotion {same} p.Promotion AND s.Discount_Applied {same} p.Discount_Applied"""


_DAY_KEY = "CAST(strftime(s.Date, '%Y%m%d') AS INT)"
_PARTS["g_fact"] = _gold_fact("d.Date_Key", "=") + "\nLEFT JOIN g_moment d ON s.Date = d.Full_Date"
_PARTS["g_bridge"] = """
SELECT m.Transaction_ID, p.Product_Key FROM mentions m LEFT JOIN g_product p ON m.Product_Name = p.Product_Name"""

# Product names as plain comma pieces, list marks left on.
_PARTS["pieces"] = """
SELECT unnest(list_transform(string_split(Product, ','), lambda x: trim(x))) AS Product_Name FROM silver"""
_PARTS["piece_keys"] = _numbered("Product_Key", "Product_Name", "pieces")

# The batch's fact as loaded from text staging, and as loaded from typed staging.
_PARTS["text_fact"] = """
SELECT CAST(Transaction_ID AS BIGINT) AS Transaction_ID, Date_Key, Customer_Key, Store_Key, Promotion_Key,
       Total_Items, Total_Cost FROM g_fact"""
_PARTS["typed_fact"] = """
SELECT CAST(f.Transaction_ID AS BIGINT) AS Transaction_ID,
       CAST(strftime(d.Full_Date, '%Y%m%d') AS INT) AS Date_Key, f.Customer_Key, f.Store_Key,
       coalesce(f.Promotion_Key, -1) AS Promotion_Key, f.Total_Items, f.Total_Cost
FROM g_fact f LEFT JOIN g_moment d ON f.Date_Key = d.Date_Key WHERE f.Total_Cost >= 0"""


# The second batch, and what is current after both.
_PARTS["raw2"] = """
SELECT * REPLACE ('Second City' AS City, '9' AS Total_Items) FROM raw WHERE lower(trim(Store_Type)) = 'pop-up stand'"""
for _name, _source in (("typed", "raw"), ("shaped", "typed"), ("valid", "shaped"), ("silver", "valid")):
    _PARTS[f"{_name}2"] = re.sub(rf"\bFROM {_source}\b", f"FROM {_source}2", _PARTS[_name])
_PARTS["current"] = """
SELECT * EXCLUDE (place) FROM (
  SELECT *, row_number() OVER (PARTITION BY Transaction_ID ORDER BY source_batch_date DESC) AS place
  FROM (SELECT *, '2026-07-07' AS source_batch_date FROM silver
        UNION ALL SELECT *, '2026-07-08' FROM silver2) AS both_batches) AS ranked
WHERE place = 1"""
_PARTS["c_mentions"] = "SELECT Transaction_ID, unnest(Product_Array) AS Product_Name FROM current"


def _register(key: str, columns: str, first: str, then: str) -> str:
    """Members of the first load numbered from 1, those that only the second has numbered after them."""
    order = ", ".join(f"{c.strip()} NULLS FIRST" for c in columns.split(","))
    numbered = f"CAST(row_number() OVER (ORDER BY {order}) AS INT)"
    return f"""
SELECT {numbered} AS {key}, {columns} FROM (SELECT DISTINCT {columns} FROM {first})
UNION ALL
SELECT CAST({numbered} + (SELECT count(*) FROM (SELECT DISTINCT {columns} FROM {first})) AS INT), {columns}
FROM (SELECT {columns} FROM {then} EXCEPT SELECT {columns} FROM {first})"""


_PARTS["c_customer"] = _register("Customer_Key", "Customer_Name, Customer_Category", "silver", "current")
_PARTS["c_store"] = _register("Store_Key", "City, Store_Type", "silver", "current")
_PARTS["c_promotion"] = _register("Promotion_Key", "Promotion, Discount_Applied", "silver", "current")
_PARTS["c_product"] = _register("Product_Key", "Product_Name", "mentions", "c_mentions")
_PARTS["c_calendar"] = re.sub(r"\bFROM silver\b", "FROM current", _PARTS["g_calendar"])

# The warehouse over both batches.
_PARTS["lake_FactSales"] = f"""
SELECT CAST(s.Transaction_ID AS BIGINT) AS Transaction_ID, {_DAY_KEY} AS Date_Key, c.Customer_Key, t.Store_Key,
       coalesce(p.Promotion_Key, -1) AS Promotion_Key, s.Total_Items, s.Total_Cost
FROM current s
JOIN c_customer c ON s.Customer_Name = c.Customer_Name AND s.Customer_Category = c.Customer_Category
JOIN c_store t ON s.City = t.City AND s.Store_Type = t.Store_Type
LEFT JOIN c_promotion p ON s.Promotion = p.Promotion AND s.Discount_Applied = p.Discount_Applied"""
_PARTS["lake_FactProductBridge"] = """
SELECT CAST(m.Transaction_ID AS BIGINT) AS Transaction_ID, p.Product_Key
FROM c_mentions m JOIN c_product p ON m.Product_Name = p.Product_Name"""
_PARTS["lake_DimCustomer"] = "SELECT * FROM c_customer"
_PARTS["lake_DimStore"] = "SELECT * FROM c_store"
_PARTS["lake_DimProduct"] = "SELECT Product_Key, lower(Product_Name) AS Product_Name FROM c_product"
_PARTS["lake_DimPromotion"] = """
SELECT Promotion_Key, coalesce(Promotion, 'No Promotion') AS Promotion,
       coalesce(Discount_Applied, false) AS Discount_Applied FROM c_promotion"""
_PARTS["lake_DimDate"] = "SELECT * FROM c_calendar"


def _of_lake(sql: str) -> str:
    names = r"\b(Fact(?:Sales|ProductBridge)|Dim(?:Customer|Store|Product|Promotion|Date)|bought|name_counts|pair_list)\b"
    return re.sub(names, r"lake_\1", sql)


def _with(body: str) -> str:
    """Prefix ``body`` with the named parts it uses, in definition order."""
    needed: set[str] = set()

    def visit(sql: str) -> None:
        for name in _PARTS:
            if name not in needed and re.search(rf"\b{name}\b", sql):
                needed.add(name)
                visit(_PARTS[name])

    visit(body)
    parts = ",\n".join(f"{n} AS ({_PARTS[n].strip()})" for n in _PARTS if n in needed)
    return f"WITH {parts}\n{body.strip()}" if parts else body.strip()


_SQL: dict[str, str] = {}

# --- sources and sinks -------------------------------------------------------------------------

_SQL["s1_csv_scan"] = f"SELECT {_RAW_COLUMNS} FROM raw"
_SQL["s2_format_dispatch"] = f"""
SELECT {_RAW_COLUMNS}, 'csv' AS format FROM raw
UNION ALL SELECT {_RAW_COLUMNS}, f FROM written, (VALUES ('json'), ('parquet')) AS formats(f)"""
_SQL["s3_batch_load"] = f"SELECT {_RAW_COLUMNS} FROM raw UNION ALL SELECT {_RAW_COLUMNS} FROM written"
_SQL["s4_bronze_audit"] = f"""
SELECT {_RAW_COLUMNS}, '2026-07-07' AS source_batch_date, true AS has_ingestion_timestamp FROM raw"""
_SQL["s5_layer_write_csv"] = f"SELECT {_RAW_COLUMNS} FROM raw"
_SQL["s6_bronze_partition_write"] = f"""
SELECT {_RAW_COLUMNS}, d AS source_batch_date, d AS batch_date
FROM raw, (VALUES ('2026-07-06'), ('2026-07-07')) AS days(d)"""
_SQL["s7_array_flatten"] = """
SELECT * REPLACE (array_to_string(Product_Array, ', ') AS Product_Array), '2026-07-07' AS source_batch_date FROM silver"""
_GOLD = {
    "DimCustomer": "g_customer",
    "DimDate": "g_moment",
    "DimProduct": "g_product",
    "DimPromotion": "g_promotion",
    "DimStore": "g_store",
    "FactSales": "g_fact",
    "FactProductBridge": "g_bridge",
}
for _table, _part in _GOLD.items():
    _SQL[f"s8_gold_write_{_table}"] = f"SELECT * FROM {_part}"
_SQL["s9_staging_scan_typed"] = "SELECT * FROM text_fact"
_SQL["s9_staging_scan_text"] = """
SELECT Transaction_ID, CAST(Date_Key AS VARCHAR) AS Date_Key, CAST(Customer_Key AS VARCHAR) AS Customer_Key,
       CAST(Store_Key AS VARCHAR) AS Store_Key, CAST(Promotion_Key AS VARCHAR) AS Promotion_Key,
       CAST(Total_Items AS VARCHAR) AS Total_Items, CAST(Total_Cost AS VARCHAR) AS Total_Cost
FROM g_fact"""
_KEYED = "Date_Key IS NOT NULL AND Customer_Key IS NOT NULL AND Store_Key IS NOT NULL"
# --- silver ------------------------------------------------------------------------------------

_SQL["t1_trim"] = "SELECT " + ", ".join(f"trim({c}) AS {c}" for c in _RAW_COLUMNS.split(", ")) + " FROM raw"
_SQL["t2_title_case"] = (
    "SELECT Transaction_ID, " + ", ".join(f"{_title(f'trim({c})')} AS {c}" for c in _CATEGORIES) + " FROM raw"
)
_SQL["t3_placeholder_null"] = (
    "SELECT Transaction_ID, " + ", ".join(f"{_category(c)} AS {c}" for c in _CATEGORIES) + " FROM raw"
)
_SQL["t4_multi_format_timestamp"] = "SELECT Transaction_ID, Date FROM shaped"
_SQL["t5_numeric_casts"] = "SELECT Transaction_ID, Total_Items, Total_Cost FROM shaped"
_SQL["t6_boolean_flag"] = "SELECT Transaction_ID, Discount_Applied FROM shaped"
_SQL["t7_date_parts"] = "SELECT Transaction_ID, Year, Month, Day, Quarter, Month_Name FROM shaped"
_SQL["t8_basket_array"] = "SELECT Transaction_ID, array_to_string(Product_Array, '|') AS products FROM shaped"
_AS_TEXT = "REPLACE (array_to_string(Product_Array, '|') AS Product_Array)"
_FLAGS = "f_id, f_date, f_items, f_cost, f_range, f_products"
_SQL["t9_row_validation"] = f"""
SELECT * EXCLUDE ({_FLAGS}) {_AS_TEXT}, '2026-07-07' AS source_batch_date FROM valid"""
_SQL["t9_rejected_rows"] = """
SELECT Transaction_ID, concat_ws(',', CASE WHEN f_id THEN 'no_transaction_id' END,
       CASE WHEN f_date THEN 'no_date' END, CASE WHEN f_items THEN 'bad_items' END,
       CASE WHEN f_cost THEN 'bad_cost' END,
       CASE WHEN f_range THEN 'cost_out_of_range' END, CASE WHEN f_products THEN 'no_products' END) AS faults
FROM shaped WHERE f_id OR f_date OR f_items OR f_cost OR f_range OR f_products"""
_SQL["t10_rejection_counts"] = """
SELECT count(*) AS total_rows,
       count(*) FILTER (NOT (f_id OR f_date OR f_items OR f_cost OR f_range OR f_products)) AS valid_rows,
       count(*) FILTER (f_id OR f_date OR f_items OR f_cost OR f_range OR f_products) AS dropped_rows,
       count(*) FILTER (f_id) AS no_transaction_id, count(*) FILTER (f_date) AS no_date,
       count(*) FILTER (f_items) AS bad_items, count(*) FILTER (f_cost) AS bad_cost,
       count(*) FILTER (f_range) AS cost_out_of_range,
       count(*) FILTER (f_products) AS no_products
FROM shaped"""
_SQL["t11_latest_per_transaction"] = f"SELECT * {_AS_TEXT}, '2026-07-07' AS source_batch_date FROM silver"
_SPARK_FORMATS = {
    "yyyy-MM-dd HH:mm:ss": "%Y-%m-%d %H:%M:%S",
    "yyyy-MM-dd": "%Y-%m-%d",
    "dd-MM-yyyy HH:mm:ss": "%d-%m-%Y %H:%M:%S",
    "dd/MM/yyyy HH:mm:ss": "%d/%m/%Y %H:%M:%S",
    "MM/dd/yyyy HH:mm:ss": "%m/%d/%Y %H:%M:%S",
    "dd-MM-yyyy": "%d-%m-%Y",
    "MM-dd-yyyy": "%m-%d-%Y",
    "dd/MM/yyyy": "%d/%m/%Y",
    "MM/dd/yyyy": "%m/%d/%Y",
    "yyyy/MM/dd": "%Y/%m/%d",
}
_SQL["t12_date_diagnostic"] = (
    "\nUNION ALL ".join(
        f"SELECT '{shown}' AS date_format, count(try_strptime(trim(Date), '{f}')) AS rows_read FROM raw"
        for shown, f in _SPARK_FORMATS.items()
    )
    + f"\nUNION ALL SELECT 'unreadable', count(*) FROM raw WHERE try_strptime(trim(Date), {_FORMATS}) IS NULL"
)

# --- keys, dimensions, fact, bridge ------------------------------------------------------------

_SQL["k1_dense_key"] = """
SELECT CAST(row_number() OVER (ORDER BY c_mktsegment, c_name) AS INT) AS row_key, c_mktsegment, c_name
FROM customer"""
_SQL["g1_dim_customer"] = "SELECT * FROM g_customer"
_SQL["g2_dim_product"] = "SELECT * FROM g_product"
_SQL["g3_dim_date_timestamp"] = "SELECT * FROM g_moment"
_SQL["g3_dim_date_calendar"] = "SELECT * FROM g_calendar"
_SQL["g4_dim_store"] = "SELECT * FROM g_store"
_SQL["g5_dim_promotion"] = "SELECT * FROM g_promotion"
_SQL["g6_fact_sales"] = _gold_fact(_DAY_KEY, "=")
_SQL["g6_fact_sales_null_safe"] = _gold_fact(_DAY_KEY, "IS NOT DISTINCT FROM")
_SQL["g6_fact_sales_timestamp"] = "SELECT * FROM g_fact"
_SQL["g7_product_bridge"] = "SELECT * FROM g_bridge"

# --- warehouse loads ---------------------------------------------------------------------------

_SQL["l1_load_customer"] = "SELECT * FROM g_customer"
_SQL["l1_load_customer_text"] = "SELECT * FROM g_customer WHERE Customer_Name IS NOT NULL"
_SQL["l2_load_date"] = "SELECT * FROM g_calendar"
_SQL["l2_load_date_text"] = "SELECT * REPLACE (CAST(Full_Date AS DATE) AS Full_Date) FROM g_moment"
_SQL["l3_load_product"] = """
SELECT Product_Key, lower(trim(replace(replace(Product_Name, ']', ''), '''', ''))) AS Product_Name
FROM piece_keys"""
_SQL["l3_load_product_text"] = """
SELECT Product_Key, replace(replace(Product_Name, '[', ''), ']', '') AS Product_Name FROM piece_keys"""
_SQL["l3_load_product_cleaned"] = """
SELECT Product_Key, lower(trim(translate(Product_Name, '[]''"', ''))) AS Product_Name FROM piece_keys"""
_LOADED_PROMOTION = """
SELECT Promotion_Key, coalesce(Promotion, 'No Promotion') AS Promotion,
       coalesce(Discount_Applied, false) AS Discount_Applied FROM g_promotion"""
_SQL["l4_load_promotion"] = _LOADED_PROMOTION
_SQL["l4_load_promotion_text"] = """
SELECT Promotion_Key, coalesce(Promotion, 'No Promotion') AS Promotion, Discount_Applied FROM g_promotion"""
_SQL["l4_unknown_promotion"] = _LOADED_PROMOTION + "\nUNION ALL SELECT -1, 'No Promotion', false"
_SQL["l5_load_store"] = "SELECT * FROM g_store"
_SQL["l5_load_store_text"] = "SELECT * FROM g_store"
_SQL["l6_load_sales"] = f"SELECT * FROM typed_fact WHERE {_KEYED}"
_SQL["l6_rejected_sales"] = f"SELECT * FROM typed_fact WHERE NOT ({_KEYED})"
_SQL["l6_load_sales_text"] = "SELECT * FROM text_fact"
_BRIDGE = "SELECT CAST(Transaction_ID AS BIGINT) AS Transaction_ID, Product_Key FROM g_bridge"
_SQL["l7_load_bridge"] = _BRIDGE + " WHERE Product_Key IS NOT NULL"
_SQL["l7_load_bridge_text"] = _BRIDGE
_SQL["l8_header_rows"] = """
SELECT CAST(Customer_Key AS VARCHAR) AS Customer_Key, Customer_Name, Customer_Category FROM g_customer"""

# --- whole loads -------------------------------------------------------------------------------

# Columns that a warehouse table requires, for each flavour the table as loaded.
_REQUIRED = {
    "DimCustomer": "Customer_Key",
    "DimDate": "Date_Key",
    "DimProduct": "Product_Key",
    "DimPromotion": "Promotion_Key",
    "DimStore": "Store_Key",
    "FactSales": "Transaction_ID, Date_Key, Customer_Key, Store_Key",
    "FactProductBridge": "Transaction_ID, Product_Key",
}
_LOADED = {
    "": {
        "DimCustomer": "l1_load_customer", "DimDate": "l2_load_date", "DimProduct": "l3_load_product_cleaned",
        "DimPromotion": "l4_load_promotion", "DimStore": "l5_load_store",
        "FactSales": "SELECT * FROM typed_fact", "FactProductBridge": _BRIDGE,
    },
    "text_": {
        "DimCustomer": "l1_load_customer_text", "DimDate": "l2_load_date_text", "DimProduct": "l3_load_product_text",
        "DimPromotion": "l4_load_promotion_text", "DimStore": "l5_load_store_text",
        "FactSales": "l6_load_sales_text", "FactProductBridge": _BRIDGE,
    },
}
for _flavour, _tables in _LOADED.items():
    _lost = []
    for _table, _body in _tables.items():
        _body = _SQL.get(_body, _body)
        _keys = _REQUIRED[_table].split(", ")
        _sound = " AND ".join(f"{k} IS NOT NULL" for k in _keys)
        _SQL[f"s10_warehouse_{_flavour}{_table}"] = f"SELECT * FROM ({_body}) AS l WHERE {_sound}"
        _reason = ", ".join(f"CASE WHEN {k} IS NULL THEN 'no_{k}' END" for k in _keys)
        _lost.append(
            f"SELECT '{_table}' AS TableName, concat_ws(',', {_reason}) AS reason FROM ({_body}) AS l WHERE NOT ({_sound})"
        )
    _SQL[f"s10_warehouse_{_flavour}rejects"] = (
        "SELECT TableName, reason, count(*) AS RowsCount FROM (" + " UNION ALL ".join(_lost) + ") AS r GROUP BY ALL"
    )

# --- the daily load over two batches -----------------------------------------------------------

_SQL["d1_daily_fact"] = "SELECT * FROM lake_FactSales"
_SQL["d1_daily_bridge"] = "SELECT * FROM lake_FactProductBridge"
for _table, _part in (
    ("DimCustomer", "c_customer"), ("DimProduct", "c_product"), ("DimPromotion", "c_promotion"), ("DimStore", "c_store")
):
    _SQL[f"k1_register_{_table}"] = f"SELECT * FROM {_part}"
_SQL["g3_daily_calendar"] = "SELECT * FROM c_calendar"
_SQL["s10_one_month"] = f"""
SELECT Full_Date, Season, {_cash('Total_Cost')} AS Revenue FROM lake_FactSales JOIN lake_DimDate USING (Date_Key)
WHERE Year = 1995 AND Month = 3 GROUP BY Full_Date, Season"""
_SQL["p2_sketched_describe"] = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count({c}) AS value_count, round(avg(CAST({c} AS DOUBLE)), 2) AS mean_value, "
    f"CAST(min({c}) AS DOUBLE) AS min_value, CAST(max({c}) AS DOUBLE) AS max_value FROM current"
    for c in ("Total_Items", "Total_Cost")
)
_SQL["d2_current_transactions"] = f"SELECT * {_AS_TEXT} FROM current"
_SQL["d3_silver_rejects"] = "\nUNION ALL ".join(
    f"SELECT *, '{day}' AS source_batch_date FROM ("
    + re.sub(r"\bFROM shaped\b", f"FROM {part}", _SQL["t9_rejected_rows"])
    + ") AS r"
    for day, part in (("2026-07-07", "shaped"), ("2026-07-08", "shaped2"))
)

# --- quality -----------------------------------------------------------------------------------

_SQL["q1_missing_values"] = """
SELECT 'FactSales' AS TableName, count(*) AS MissingCount FROM FactSales
WHERE Total_Cost IS NULL OR Total_Items IS NULL OR Transaction_ID % 59 = 0 OR Transaction_ID % 67 = 0
UNION ALL SELECT 'DimProduct', sum(CASE WHEN Product_Key % 3 = 0 THEN 2 ELSE 1 END)::BIGINT FROM DimProduct
WHERE Product_Key % 61 = 0"""
_SQL["q2_null_percentages"] = "SELECT " + ", ".join(
    f"{_share(f'(count(*) - count({k}_Key))', 'count(*)', '100')} AS PctNull_{k}"
    for k in ("Customer", "Store", "Promotion")
) + " FROM text_fact"
_SQL["q3_duplicate_keys"] = """
SELECT Product_Key, CAST(2 AS BIGINT) AS Occurrences FROM DimProduct WHERE Product_Key % 3 = 0"""
_SQL["q4_orphan_customers"] = """
SELECT count(*) AS Orphaned_Customers FROM text_fact f
WHERE NOT EXISTS (SELECT 1 FROM g_customer c WHERE c.Customer_Key = f.Customer_Key)"""
_SQL["q5_invalid_dates"] = "SELECT count(*) AS InvalidDates FROM FactSales WHERE Transaction_ID % 53 = 0"
_SQL["q6_cost_outliers"] = """
SELECT * FROM FactSales
WHERE Total_Cost > (SELECT avg(Total_Cost) + 3 * stddev_samp(Total_Cost) FROM FactSales)"""
_SQL["q7_product_purchases"] = """
SELECT Product_Key, count(Transaction_ID) AS TimesPurchased FROM FactProductBridge GROUP BY Product_Key"""
_SQL["q8_customers_by_category"] = """
SELECT Customer_Category, count(*) AS NumCustomers FROM DimCustomer GROUP BY Customer_Category"""
_SQL["q9_stores_by_city"] = "SELECT City, count(*) AS NumStores FROM DimStore GROUP BY City"
_SQL["q10_promotion_usage"] = """
SELECT Promotion, Discount_Applied, count(*) AS UsageCount FROM DimPromotion GROUP BY ALL"""
_TABLES = "DimCustomer DimDate DimProduct DimPromotion DimStore FactSales FactProductBridge".split()
_SQL["q11_row_counts"] = "\nUNION ALL ".join(
    f"SELECT '{t}' AS TableName, count(*) AS RowsCount FROM {t}" for t in _TABLES
)
_SQL["q12_null_keys"] = "SELECT " + ", ".join(
    f"count(*) FILTER ({k}_Key IS NULL) AS Null_{k}_Keys" for k in ("Customer", "Store", "Date")
) + " FROM text_fact"
_SQL["q13_value_ranges"] = f"""
SELECT min(Total_Cost) AS Min_Cost, max(Total_Cost) AS Max_Cost, {_mean_cash('Total_Cost')} AS Avg_Cost,
       min(Total_Items) AS Min_Items, max(Total_Items) AS Max_Items,
       {_share('sum(Total_Items)', 'count(Total_Items)')} AS Avg_Items
FROM FactSales"""
_SQL["q14_surplus_keys"] = "\nUNION ALL ".join(
    f"SELECT '{t}' AS TableName, count(*) FILTER ({t[3:]}_Key % 3 = 0) AS Duplicates FROM {t}"
    for t in _TABLES
    if t.startswith("Dim")
)

# --- profiles ----------------------------------------------------------------------------------

_SQL["p1_shape"] = "SELECT count(*) AS row_count, CAST(21 AS INT) AS column_count FROM silver"


def _described(column: str, source: str, extra: str = "") -> str:
    x = f"CAST({column} AS DOUBLE)"
    return f"""SELECT '{column}' AS column_name, count({column}) AS value_count, round(avg({x}), 4) AS mean_value,
       round(stddev_samp({x}), 4) AS stddev_value, min({x}) AS min_value, max({x}) AS max_value{extra}
FROM {source}"""


_SQL["p2_describe"] = "\nUNION ALL ".join(_described(c, "silver") for c in ("Total_Items", "Total_Cost"))
_SQL["p3_quartiles"] = "\nUNION ALL ".join(
    _described(
        c,
        "silver",
        "".join(f", CAST(quantile_disc({c}, {q}) AS DOUBLE) AS p{n}" for q, n in ((0.25, 25), (0.5, 50), (0.75, 75))),
    )
    for c in ("Total_Items", "Total_Cost")
)
_NEVER_NULL = ["ingestion_timestamp", "source_batch_date"]
_SILVER = _RAW_COLUMNS.split(", ") + ["Year", "Month", "Day", "Quarter", "Month_Name", "Product_Array"]
_SQL["p4_null_counts"] = "\nUNION ALL ".join(
    [f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count FROM silver" for c in _SILVER]
    + [f"SELECT '{c}', 0" for c in _NEVER_NULL]
)
_PROFILED = "Customer_Category City Store_Type Payment_Method Season Promotion".split()
_SQL["p5_distinct_counts"] = "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, (SELECT count(*) FROM (SELECT DISTINCT {c} FROM silver)) AS distinct_count"
    for c in _PROFILED
)
_SQL["p6_value_distribution"] = (
    "SELECT * FROM (SELECT column_name, column_value, count(*) AS value_count, "
    "CAST(row_number() OVER (PARTITION BY column_name ORDER BY count(*) DESC, column_value NULLS FIRST) AS INT) "
    "AS place FROM ("
    + " UNION ALL ".join(f"SELECT '{c}' AS column_name, {c} AS column_value FROM silver" for c in _PROFILED)
    + ") AS v GROUP BY column_name, column_value) AS r WHERE place <= 10"
)
_SQL["p7_date_range"] = "SELECT min(Date) AS earliest_date, max(Date) AS latest_date FROM silver"
_SQL["p8_basket_sizes"] = _described("num_products", "(SELECT len(Product_Array) AS num_products FROM silver) AS s")
_SQL["p9_top_products"] = """
SELECT Product_Name, count(*) AS times_listed FROM mentions GROUP BY Product_Name
ORDER BY times_listed DESC, Product_Name LIMIT 20"""
_SQL["p10_distinct_products"] = "SELECT count(DISTINCT Product_Name) AS distinct_products FROM mentions"
_SQL["p11_season_summary"] = f"""
SELECT Season, count(*) AS sale_count, {_mean_cash('Total_Cost')} AS average_cost,
       {_cash('Total_Cost')} AS total_cost
FROM silver GROUP BY Season"""
_SQL["p12_city_summary"] = f"""
SELECT City, count(*) AS sale_count, {_mean_cash('Total_Cost')} AS average_cost FROM silver GROUP BY City
ORDER BY sale_count DESC, City LIMIT 10"""
_SQL["p13_extreme_costs"] = """
SELECT * FROM (SELECT Transaction_ID, Total_Cost, Total_Items, 'highest' AS extreme FROM silver
               ORDER BY Total_Cost DESC, Transaction_ID LIMIT 10)
UNION ALL
SELECT * FROM (SELECT Transaction_ID, Total_Cost, Total_Items, 'lowest' AS extreme FROM silver
               ORDER BY Total_Cost, Transaction_ID LIMIT 10)"""

# --- reports -----------------------------------------------------------------------------------

_CASH = _cash("Total_Cost")
_SQL["e1_total_revenue"] = f"SELECT {_CASH} AS Total_Revenue FROM FactSales"
_SQL["e2_total_transactions"] = "SELECT count(DISTINCT Transaction_ID) AS Total_Transactions FROM FactSales"
_SQL["e3_average_order_value"] = f"SELECT {_mean_cash('Total_Cost')} AS Average_Order_Value FROM FactSales"
_SQL["e4_average_basket_size"] = f"""
SELECT {_share('sum(Total_Items)', 'count(Total_Items)')} AS Avg_Basket_Size FROM FactSales"""


def _by(columns: str, dims: str, figures: str, tail: str = "") -> str:
    joins = " ".join(f"JOIN {d} USING ({d[3:]}_Key)" for d in dims.split())
    return f"SELECT {columns}, {figures} FROM FactSales {joins} GROUP BY {columns} {tail}"


_REVENUE = f"{_CASH} AS Revenue"
_SQL["e5_revenue_by_year"] = _by("Year", "DimDate", _REVENUE)
_SQL["e6_revenue_by_quarter"] = _by("Year, Quarter", "DimDate", _REVENUE)
_SQL["e7_revenue_by_month"] = _by("Year, Month_Name", "DimDate", _REVENUE)
_SQL["e8_revenue_by_season"] = _by("Season", "DimDate", _REVENUE)
_SQL["e9_revenue_by_category"] = _by("Customer_Category", "DimCustomer", _REVENUE)
_SQL["e10_top_customers"] = _by(
    "Customer_Name", "DimCustomer", f"{_CASH} AS Total_Spent", "ORDER BY Total_Spent DESC, Customer_Name LIMIT 10"
)
_EXACT_REVENUE = f"{_exact('Total_Cost')} AS exact"
_SQL["e11_segment_contribution"] = f"""
SELECT Customer_Category, CAST(exact AS DOUBLE) AS Revenue,
       {_share('exact', 'sum(exact) OVER ()', '100')} AS Contribution_Pct
FROM ({_by('Customer_Category', 'DimCustomer', _EXACT_REVENUE)}) AS r"""
_SQL["e12_revenue_by_city"] = _by("City", "DimStore", _REVENUE)
_SQL["e13_revenue_by_store_type"] = _by("Store_Type", "DimStore", _REVENUE)
_SQL["e14_top_cities"] = _by(
    "City",
    "DimStore",
    f"{_REVENUE}, count(Transaction_ID) AS Transactions",
    "ORDER BY Revenue DESC, City LIMIT 5",
)
_SQL["e15_top_store_types"] = _by(
    "Store_Type",
    "DimStore",
    f"{_mean_cash('Total_Cost')} AS Avg_Transaction_Value",
    "ORDER BY Avg_Transaction_Value DESC, Store_Type LIMIT 5",
)
_SQL["e16_revenue_by_promotion"] = _by("Promotion", "DimPromotion", _REVENUE)
_SQL["e17_items_per_promotion"] = _by(
    "Promotion", "DimPromotion", f"{_share('sum(Total_Items)', 'count(Total_Items)')} AS Avg_Items_Sold"
)
_SQL["e18_discount_impact"] = _by(
    "Discount_Applied", "DimPromotion", f"{_CASH} AS Total_Revenue, count(Transaction_ID) AS Trans_Count"
)
_SOLD = """
SELECT Product_Name, count(Transaction_ID) AS Times_Sold
FROM FactProductBridge JOIN DimProduct USING (Product_Key) GROUP BY Product_Name
ORDER BY Times_Sold {}, Product_Name LIMIT 10"""
_SQL["e19_best_sellers"] = _SOLD.format("DESC")
_SQL["e20_slow_sellers"] = _SOLD.format("ASC")
_BOUGHT = "FactSales JOIN FactProductBridge USING (Transaction_ID) JOIN DimProduct USING (Product_Key)"
_SQL["e21_products_by_category"] = f"""
SELECT Product_Name, Customer_Category, count(*) AS Purchases
FROM {_BOUGHT} JOIN DimCustomer USING (Customer_Key) GROUP BY ALL"""
_SQL["e22_product_revenue"] = f"""
SELECT Product_Name, round(CAST(sum(CAST(Total_Cost / size AS DECIMAL(28,10))) AS DOUBLE), 2) AS Estimated_Revenue
FROM {_BOUGHT}
JOIN (SELECT Transaction_ID, count(*) AS size FROM FactProductBridge GROUP BY 1) AS z USING (Transaction_ID)
GROUP BY Product_Name"""
_SQL["e23_products_by_season"] = f"""
SELECT Season, Product_Name, count(*) AS Units_Sold FROM {_BOUGHT} JOIN DimDate USING (Date_Key) GROUP BY ALL"""
_SQL["e24_month_over_month"] = f"""
SELECT Year, Month, CAST(exact AS DOUBLE) AS Revenue, CAST(before AS DOUBLE) AS Prev_Month_Revenue,
       {_share('(exact - before)', 'before', '100')} AS MoM_Growth_Pct
FROM (SELECT *, lag(exact) OVER (ORDER BY Year, Month) AS before
      FROM ({_by('Year, Month', 'DimDate', _EXACT_REVENUE)}) AS m) AS g"""
_SQL["e25_customer_value"] = _by(
    "Customer_Name, Customer_Category",
    "DimCustomer",
    f"count(Transaction_ID) AS Total_Transactions, {_CASH} AS Total_LTV",
)
_SQL["f8_headline_texts"] = f"""
SELECT 'Total Revenue' AS Metric, format('{{:,.0f}}', {_CASH}) AS Value FROM FactSales
UNION ALL SELECT 'Total Transactions', format('{{:,}}', count(DISTINCT Transaction_ID)) FROM FactSales
UNION ALL SELECT 'Average Order Value', format('{{:,.2f}}', {_mean_cash('Total_Cost')}) FROM FactSales
UNION ALL SELECT 'Avg Basket Size', format('{{:,.2f}}', {_share('sum(Total_Items)', 'count(Total_Items)')})
FROM FactSales"""

_SQL["a1_retention"] = f"""
SELECT Customer_Segment, Num_Customers, {_share('Num_Customers', 'sum(Num_Customers) OVER ()', '100')} AS Pct_Of_Total
FROM (SELECT CASE WHEN orders = 1 THEN '1 (New)' WHEN orders <= 3 THEN '2-3 (Occasional)'
                  WHEN orders <= 6 THEN '4-6 (Regular)' WHEN orders <= 10 THEN '7-10 (Loyal)'
                  ELSE '10+ (VIP)' END AS Customer_Segment, count(*) AS Num_Customers
      FROM (SELECT Customer_Key, count(DISTINCT Transaction_ID) AS orders FROM FactSales GROUP BY 1) AS o
      GROUP BY 1) AS b"""
_SQL["a2_days_between_orders"] = f"""
SELECT count(DISTINCT Customer_Key) AS Customers_With_Multiple_Orders,
       {_share('sum(gap)', 'count(gap)')} AS Avg_Days_Between_Orders
FROM (SELECT Customer_Key, datediff('day', lag(Full_Date) OVER (PARTITION BY Customer_Key ORDER BY Full_Date), Full_Date)
             AS gap
      FROM FactSales JOIN DimDate USING (Date_Key)) AS g
WHERE gap IS NOT NULL"""
_SQL["a3_average_lifespan"] = f"""
SELECT 'Avg Customer Lifespan (Days)' AS Metric, {_share('sum(days)', 'count(days)')} AS Value
FROM (SELECT Customer_Key, datediff('day', min(Full_Date), max(Full_Date)) AS days
      FROM FactSales JOIN DimDate USING (Date_Key) GROUP BY Customer_Key) AS s"""
_PARTS["bought"] = """
SELECT DISTINCT Transaction_ID, lower(trim(Product_Name)) AS name
FROM FactProductBridge JOIN DimProduct USING (Product_Key)"""
_PARTS["name_counts"] = "SELECT name, count(*) AS n FROM bought GROUP BY name"
_PARTS["pair_list"] = """
SELECT x.name AS Product1, y.name AS Product2, count(*) AS n
FROM bought x JOIN bought y ON x.Transaction_ID = y.Transaction_ID AND x.name < y.name GROUP BY 1, 2"""
_SQL["a4_product_pairs"] = """
SELECT Product1, Product2, p.n AS Pair_Trans_Count,
       round(CAST(p.n AS DOUBLE) * 100 / total, 2) AS Support_Pct,
       round(CAST(p.n AS DOUBLE) * 100 / CAST(s1.n AS DOUBLE), 2) AS Confidence_Pct,
       round((CAST(p.n AS DOUBLE) / s1.n) / (CAST(s2.n AS DOUBLE) / total), 2) AS Lift
FROM pair_list p JOIN name_counts s1 ON s1.name = Product1 JOIN name_counts s2 ON s2.name = Product2,
     (SELECT CAST(count(DISTINCT Transaction_ID) AS DOUBLE) AS total FROM FactSales) AS w
ORDER BY Lift DESC, Product1, Product2 LIMIT 10"""
_SQL["a5_segments_by_season"] = _by(
    "Season, Customer_Category",
    "DimDate DimCustomer",
    f"count(Transaction_ID) AS Transactions, {_REVENUE}, {_mean_cash('Total_Cost')} AS Avg_Order_Value",
)

# --- views -------------------------------------------------------------------------------------

_SQL["w1_sales_overview"] = """
SELECT Transaction_ID, Full_Date, Customer_Name, City, Store_Type, Total_Items, Total_Cost
FROM FactSales JOIN DimDate USING (Date_Key) JOIN DimCustomer USING (Customer_Key) JOIN DimStore USING (Store_Key)"""


def _members(dim: str, columns: str, figures: str) -> str:
    key = f"{dim[3:]}_Key"
    shown = f"{key}, {columns}"
    return f"SELECT {shown}, {figures} FROM {dim} LEFT JOIN FactSales USING ({key}) GROUP BY {shown}"


_SQL["w2_customer_analysis"] = _members(
    "DimCustomer",
    "Customer_Name, Customer_Category",
    f"count(DISTINCT Transaction_ID) AS Total_Transactions, {_CASH} AS Lifetime_Value, "
    f"{_mean_cash('Total_Cost')} AS Average_Order_Value",
)
_SQL["w3_product_performance"] = """
SELECT p.Product_Key, p.Product_Name, count(b.Transaction_ID) AS Total_Times_Purchased,
       count(DISTINCT f.Customer_Key) AS Unique_Customers_Bought
FROM DimProduct p LEFT JOIN FactProductBridge b ON p.Product_Key = b.Product_Key
LEFT JOIN FactSales f ON b.Transaction_ID = f.Transaction_ID
GROUP BY p.Product_Key, p.Product_Name"""
_SQL["w4_promotion_analysis"] = _members(
    "DimPromotion",
    "Promotion, Discount_Applied",
    f"count(Transaction_ID) AS Times_Used, {_CASH} AS Generated_Revenue",
)
_SQL["w5_store_performance"] = _members(
    "DimStore",
    "City, Store_Type",
    f"{_CASH} AS Total_Revenue, count(Transaction_ID) AS Transaction_Count, "
    f"{_share('sum(Total_Items)', 'count(Total_Items)')} AS Avg_Basket_Size",
)
_SQL["w6_time_analysis"] = f"""
SELECT Full_Date, Year, Quarter, Month_Name, Season, {_CASH} AS Daily_Revenue,
       count(Transaction_ID) AS Daily_Transactions
FROM DimDate LEFT JOIN FactSales USING (Date_Key) GROUP BY ALL"""


# The same reports over the warehouse of the lake, and profiles over all that is current there.
for _name in ("bought", "name_counts", "pair_list"):
    _PARTS[f"lake_{_name}"] = _of_lake(_PARTS[_name])
_KEPT = re.compile(r"(e([5-9]|1[0-8]|2[1-5])|a\d|w[2-6])_")
for _name in [n for n in _SQL if _KEPT.match(n)]:
    _SQL[f"{_name}_kept"] = _of_lake(_SQL[_name])
for _name in ("p5_distinct_counts", "p6_value_distribution"):
    _SQL[_name.replace("_", "_sketched_", 1)] = re.sub(r"\bFROM silver\b", "FROM current", _SQL[_name])


def statements() -> dict[str, str]:
    return {name: _with(body) for name, body in _SQL.items()}
