"""Bronze text to typed, validated, unique transactions."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from martloom import schemas
from martloom.functions import dates, flags, numbers, text
from martloom.plans.sizes import broadcast_by_size
from martloom.sources.staging import stage


RULES = "1"  # to be raised with any change of the rules below: batches that were parsed by others are parsed again


def trim_all(df: DataFrame) -> DataFrame:
    """Every text column without outer blanks."""
    return df.withColumns({n: F.trim(F.col(n)) for n, t in df.dtypes if t == "string"})


def title_case(df: DataFrame, columns: tuple[str, ...] = schemas.CATEGORY_COLUMNS) -> DataFrame:
    return df.withColumns({c: F.initcap(F.col(c)) for c in columns})


def null_placeholders(df: DataFrame, columns: tuple[str, ...] = schemas.CATEGORY_COLUMNS) -> DataFrame:
    return df.withColumns({c: text.without_placeholder(F.col(c)) for c in columns})


def clean_text(df: DataFrame) -> DataFrame:
    """Trim, drop placeholder words, then title-case. The order matters: casing first would turn
    ``NA`` into ``Na``, which no placeholder matches."""
    return title_case(null_placeholders(trim_all(df)))


def cast_types(df: DataFrame, formats: tuple[str, ...] = dates.TIMESTAMP_FORMATS) -> DataFrame:
    """Timestamp, counts, amount and flag; what cannot be read becomes null and is judged later."""
    shaped = df.withColumn("_shape", dates.digit_shape(F.col("Date")))
    return shaped.withColumns(
        {
            "Date": dates.parse_timestamp(F.col("Date"), formats, F.col("_shape")),
            "Total_Items": numbers.to_int(F.col("Total_Items")),
            "Total_Cost": numbers.to_double(F.col("Total_Cost")),
            "Discount_Applied": flags.to_flag(F.col("Discount_Applied")),
        }
    ).drop("_shape")


def add_date_parts(df: DataFrame) -> DataFrame:
    return df.withColumns(dates.date_parts(F.col("Date")))


def add_products(df: DataFrame, verbatim: bool = False) -> DataFrame:
    """``Product_Array`` from the basket text; ``verbatim`` leaves list marks on the names."""
    split = text.basket_verbatim if verbatim else text.basket
    return df.withColumn("Product_Array", split(F.col("Product")))


def shape(bronze: DataFrame, formats: tuple[str, ...] = dates.TIMESTAMP_FORMATS) -> DataFrame:
    """All cleaning and typing steps; no row is dropped."""
    return add_products(add_date_parts(cast_types(clean_text(bronze), formats)))


def _faults() -> dict[str, Column]:
    items, cost = F.col("Total_Items"), F.col("Total_Cost")
    basket_size = F.coalesce(F.size("Product_Array"), F.lit(0))
    return {
        "no_transaction_id": F.col("Transaction_ID").isNull(),
        "no_date": F.col("Date").isNull(),
        "bad_items": F.coalesce(items <= 0, F.lit(True)),
        "bad_cost": F.coalesce((cost < 0) | F.isnan(cost), F.lit(True)),
        "cost_out_of_range": numbers.misfit(cost),
        "no_products": basket_size <= 0,
    }


def with_faults(shaped: DataFrame) -> DataFrame:
    """Adds ``faults``, the names of the rules a row breaks."""
    named = [F.when(broken, F.lit(name)).otherwise(F.lit("")) for name, broken in _faults().items()]
    return shaped.withColumn("faults", F.array_remove(F.array(*named), ""))


def valid_rows(shaped: DataFrame, counts: Observation | str = "validation") -> DataFrame:
    """Rows that break no rule.

    ``counts`` receives the rows ``read`` and ``dropped`` while the result is computed. Observing them
    between parsing and filtering also keeps the optimizer from copying the filter, and with it all
    the parsing, below the projection that parses.
    """
    broken = reduce(or_, _faults().values())
    marked = shaped.withColumn("_invalid", broken).observe(
        counts, F.count(F.lit(1)).alias("read"), F.count_if("_invalid").alias("dropped")
    )
    return marked.filter("NOT _invalid").drop("_invalid")


def rejected_rows(shaped: DataFrame, counts: Observation | str = "rejection") -> DataFrame:
    """Rows that break a rule, with ``faults``; observed and parsed once as in :func:`valid_rows`."""
    marked = with_faults(shaped).observe(counts, F.count(F.lit(1)).alias("read"))
    return marked.filter(F.size("faults") > 0)


def rejection_counts(shaped: DataFrame) -> DataFrame:
    """Rows in, rows kept, rows dropped, and rows per broken rule, in one pass."""
    faults = _faults()
    marked = shaped.select(*[broken.alias(name) for name, broken in faults.items()])
    invalid = reduce(or_, [F.col(name) for name in faults])
    return marked.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(~invalid).alias("valid_rows"),
        F.count_if(invalid).alias("dropped_rows"),
        *[F.count_if(name).alias(name) for name in faults],
    )


def derived(rows: DataFrame) -> DataFrame:
    """The columns that follow from others of a typed row: what a shuffle need not carry."""
    return add_products(add_date_parts(rows))


DERIVED = ("Year", "Month", "Day", "Quarter", "Month_Name", "Product_Array")


def latest_per_transaction(df: DataFrame, key: str = "Transaction_ID", within: tuple[str, ...] = ()) -> DataFrame:
    """One row per transaction: of the latest batch the last ingested, ties settled by row content.

    A batch date counts before the load time, so loading an old batch again overrules no later one.

    Columns ``within`` follow from the key; rows partitioned by them are not shuffled again.

    An aggregate, not a window: each map task first reduces its own copies to one row, so even an id
    holding a large part of all rows sends one row per task through the shuffle.
    """
    keys = [key, *within]
    others = [c for c in df.columns if c not in keys]
    age = [F.col(c) for c in ("source_batch_date", "ingestion_timestamp") if c in others]
    order = F.struct(*age, F.xxhash64(*others))
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*others), order).alias("_best"))
    return best.select(*[F.col(c) if c in keys else F.col(f"_best.{c}").alias(c) for c in df.columns])


def latest_of_shaped(shaped: DataFrame, key: str = "Transaction_ID") -> DataFrame:
    """``latest_per_transaction`` of shaped rows, without sorting and shuffling the columns that follow from others.

    Ties are settled by the whole row as there, its hash being taken first.
    """
    others = [c for c in shaped.columns if c != key]
    carried = [c for c in others if c not in DERIVED]
    age = [F.col(c) for c in ("source_batch_date", "ingestion_timestamp") if c in others]
    narrow = shaped.withColumn("_content", F.xxhash64(*others)).drop(*DERIVED)
    best = narrow.groupBy(key).agg(F.max_by(F.struct(*carried), F.struct(*age, "_content")).alias("_best"))
    return derived(best.select(key, *[F.col(f"_best.{c}").alias(c) for c in carried])).select(*shaped.columns)


def latest_of_stored(rows: DataFrame, key: str = "Transaction_ID") -> DataFrame:
    """``latest_per_transaction`` of a stored table, in which few transactions come more than once.

    Only ids are shuffled to find these; the rest of the rows stay where they are. Where too many come again for
    a broadcast, all rows are gathered.
    """
    repeated = stage(
        rows.groupBy(F.col(key).alias("_again")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("_again"), "repeated"
    )
    if not broadcast_by_size(repeated):
        return latest_per_transaction(rows, key)
    same = F.col(key).eqNullSafe(F.col("_again"))
    return rows.join(repeated, same, "left_anti").unionByName(
        latest_per_transaction(rows.join(repeated, same, "left_semi"), key)
    )


def refine(
    bronze: DataFrame,
    formats: tuple[str, ...] = dates.TIMESTAMP_FORMATS,
    counts: Observation | str = "refine",
) -> DataFrame:
    """Bronze to silver in one pass and one shuffle; ``counts`` as in :func:`valid_rows`."""
    return latest_of_shaped(valid_rows(shape(bronze, formats), counts))


def date_diagnostic(bronze: DataFrame, formats: tuple[str, ...] = dates.TIMESTAMP_FORMATS) -> DataFrame:
    """Rows each format can read, and rows none can, in one pass."""
    text = F.trim(F.col("Date"))
    shaped = bronze.select(text.alias("text"), dates.digit_shape(text).alias("shape"))
    readable = dates.readable_by(F.col("text"), formats, F.col("shape"))
    # Positional names: a format is no handy column name.
    reads = shaped.select(*[flag.alias(f"f{i}") for i, flag in enumerate(readable.values())])
    counts = [F.count_if(name) for name in reads.columns]
    counts.append(F.count_if(~reduce(or_, [F.col(name) for name in reads.columns])))
    pairs = [
        F.struct(F.lit(label).alias("date_format"), count.alias("rows_read"))
        for label, count in zip([*formats, "unreadable"], counts, strict=True)
    ]
    return reads.agg(F.array(*pairs).alias("c")).select(F.inline("c"))
