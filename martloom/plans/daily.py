"""The daily load: transaction files to bronze, silver, gold and warehouse tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from martloom import schemas
from martloom.functions.dates import TIMESTAMP_FORMATS
from martloom.operators import gold, quality, silver, sketches, warehouse
from martloom.operators.buckets import BUCKET, SLOT, SPAN, bucket_of, by_bucket, replace_buckets, slots_for, write_batch_buckets
from martloom.operators.register import grow
from martloom.plans import kept
from martloom.plans.sizes import broadcast_by_size
from martloom.plans.star import Star
from martloom.sources import readers, writers
from martloom.sources.files import exists, remove
from martloom.sources.staging import scratch, stage

ALL = "all"  # the bucket of what belongs to no transaction


@dataclass(frozen=True)
class Layers:
    """Folders of one data lake. Transactions are stored in buckets of ``span`` ids, for good."""

    root: str
    span: int = SPAN

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze/transactions"

    @property
    def silver(self) -> str:
        """Clean rows by batch and bucket."""
        return f"{self.root}/silver/transactions"

    @property
    def rejects(self) -> str:
        """Rows that broke a rule, with its name, by batch."""
        return f"{self.root}/silver/rejects"

    @property
    def current(self) -> str:
        """The newest copy of every transaction over all batches, by bucket."""
        return f"{self.root}/silver/current"

    @property
    def profiles(self) -> str:
        """Sketches of the columns of current, by bucket."""
        return f"{self.root}/silver/profiles"

    @property
    def pending(self) -> str:
        """Buckets that changed in silver and not yet in all that follows from it."""
        return f"{self.root}/silver/pending"

    @property
    def parsed(self) -> str:
        """What each batch's bronze rows were when they were parsed last, in two combined hashes."""
        return f"{self.root}/silver/parsed"

    @property
    def gold(self) -> str:
        return f"{self.root}/gold"

    @property
    def days(self) -> str:
        """The calendar of each bucket."""
        return f"{self.root}/gold/parts/DimDate"

    @property
    def warehouse(self) -> str:
        return f"{self.root}/warehouse"

    @property
    def settings(self) -> str:
        return f"{self.root}/settings"


def settle(spark: SparkSession, layers: Layers, **chosen: bool) -> None:
    """Keep what a lake was begun with, and refuse to go on otherwise: its buckets and keys would not fit."""
    wanted = {"span": layers.span, **chosen}
    if not exists(spark, layers.settings):
        spark.createDataFrame([tuple(wanted.values())], list(wanted)).write.parquet(layers.settings)
    begun = spark.read.parquet(layers.settings).first().asDict()
    if begun != wanted:
        raise ValueError(f"The lake at {layers.root} was begun with {begun}, not with {wanted}")


def ingest(spark: SparkSession, layers: Layers, paths: Iterable[str], batch_date: str, multiline: bool = True) -> None:
    """Files to the batch's bronze folder, unchanged but for the audit columns."""
    raw = readers.load_daily_batch(spark, paths, multiline)
    writers.write_bronze(readers.with_audit(raw, batch_date), layers.bronze, batch_date)


def bronze_batch(spark: SparkSession, layers: Layers, batch_date: str) -> DataFrame:
    stored = spark.read.parquet(layers.bronze)
    return stored.filter(F.col("batch_date") == F.lit(batch_date)).drop("batch_date")


_KNOWN: dict[str, StructType] = {}


def _known_schema(name: str, derive: Callable[[], DataFrame]) -> StructType:
    """Columns of a layer: declared when read, as buckets may hold no file. They follow from the code alone."""
    if name not in _KNOWN:
        _KNOWN[name] = derive().schema
    return _KNOWN[name]


def _clean_schema(spark: SparkSession) -> StructType:
    def derive() -> DataFrame:
        nothing = readers.with_audit(spark.createDataFrame([], schemas.RAW), "")
        return silver.shape(nothing).withColumn(BUCKET, F.lit(""))

    return _known_schema("clean", derive)


def silver_rows(spark: SparkSession, layers: Layers) -> DataFrame:
    """Clean rows of all batches, with ``batch_date`` and ``bucket``."""
    dated = StructType([*_clean_schema(spark).fields, StructField("batch_date", StringType())])
    return spark.read.schema(dated).parquet(layers.silver)


def current_rows(spark: SparkSession, layers: Layers) -> DataFrame:
    return spark.read.schema(_clean_schema(spark)).parquet(layers.current)


def _without_derived(rows: DataFrame) -> DataFrame:
    return rows.drop(*silver.DERIVED)


def _whole(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Rows with the columns that follow from others, made again behind a shuffle."""
    return silver.derived(rows).select(*columns)


def _hashed(columns: list[str]) -> list[Column]:
    """Columns to hash a row by. Hashes pass over nulls, so which cells are null is hashed as well."""
    return [*(F.col(c) for c in columns), *(F.col(c).isNull() for c in columns)]


def _prints(rows: DataFrame) -> DataFrame:
    """Number of rows and two combined hashes of their content per bucket; the load time is no content."""
    cells = _hashed([c for c in rows.columns if c not in (*silver.DERIVED, BUCKET, "batch_date", "ingestion_timestamp")])
    return rows.groupBy(BUCKET).agg(
        F.count(F.lit(1)).alias("n"),
        F.bit_xor(F.xxhash64(*cells)).alias("one"),
        F.bit_xor(F.xxhash64(F.lit(1), *cells)).alias("two"),
    )


def _raw_print(bronze: DataFrame, formats: tuple[str, ...]) -> dict[str, str]:
    """Number of bronze rows, two combined hashes of their text, and what they are parsed by. Rows may repeat, so hashes are added."""
    cells = _hashed(list(schemas.RAW_COLUMNS))
    whole = [F.coalesce(F.sum(h.cast("decimal(20,0)")), F.lit(0)) for h in (F.xxhash64(*cells), F.xxhash64(F.lit(1), *cells))]
    figures = bronze.agg(*[c.cast("string") for c in (F.count(F.lit(1)), *whole)]).first()
    return dict(zip(("n", "one", "two", "rules"), (*figures, "|".join((silver.RULES, *formats))), strict=True))


def _changed(now: DataFrame, before: DataFrame) -> DataFrame:
    """Buckets whose rows are not those of ``before``, on either side."""
    both = _prints(now).unionByName(_prints(before))
    twice = both.groupBy(*both.columns).agg(F.count(F.lit(1)).alias("sides")).filter("sides < 2")
    return twice.select(BUCKET).distinct()


def refine(
    spark: SparkSession, layers: Layers, batch_date: str, formats: tuple[str, ...] = TIMESTAMP_FORMATS
) -> dict[str, int]:
    """Bronze batch to silver, clean and rejected rows; every row is parsed once. Returns row counts.

    Buckets whose rows of the batch are others than before are noted first, and only these are stored: whatever
    happens to the load afterwards, ``merge`` knows what to do again. A batch that comes again unchanged is read and
    not parsed, and keeps the load time of its first coming in silver and among the rejects; without its silver
    folder it is parsed anew.
    """
    bronze, folder, note = bronze_batch(spark, layers, batch_date), f"{layers.silver}/batch_date={batch_date}", f"{layers.parsed}/batch_date={batch_date}"
    now = _raw_print(bronze, formats)
    if exists(spark, note):
        before = spark.read.parquet(note).first().asDict()
        counts = {c: before.pop(c) for c in ("read", "dropped")}
        if before == now and exists(spark, folder):
            return counts
        remove(spark, note)
    with scratch(spark):
        judged = silver.with_faults(silver.shape(bronze, formats))
        marked = stage(_without_derived(judged), "marked")
        sound, bucket = F.size("faults") == 0, bucket_of("Transaction_ID", layers.span)
        clean = silver.latest_of_stored(marked.filter(sound).drop("faults")).withColumn(BUCKET, bucket)
        dealt = _whole(clean.hint("rebalance", BUCKET), [*(c for c in judged.columns if c != "faults"), BUCKET])
        if exists(spark, folder):
            held = silver_rows(spark, layers).filter(F.col("batch_date") == F.lit(batch_date))
            noted = stage(_changed(clean, held), "changed")
            noted.write.mode("append").parquet(layers.pending)
            names = sorted(row[0] for row in noted.collect())  # one short text per bucket
            if names:
                replace_buckets(dealt.filter(F.col(BUCKET).isin(names)), folder, names, dealt=True)
        else:
            marked.filter(sound).select(bucket).distinct().write.mode("append").parquet(layers.pending)
            write_batch_buckets(dealt, layers.silver, batch_date)
        writers.write_batch(_whole(marked.filter(~sound), judged.columns), layers.rejects, batch_date)
        counts = marked.agg(F.count(F.lit(1)).alias("read"), F.count_if(~sound).alias("dropped")).first().asDict()
    spark.createDataFrame([(*now.values(), *counts.values())], [*now, *counts]).write.parquet(note)
    return counts


def pending_buckets(spark: SparkSession, layers: Layers) -> list[str]:
    """Names of the buckets that batches have changed since the last whole load: one short text each."""
    if not exists(spark, layers.pending):
        return []
    noted = spark.read.schema(f"{BUCKET} string").parquet(layers.pending)
    return sorted(row[0] for row in noted.distinct().collect())


def merge(spark: SparkSession, layers: Layers) -> list[str]:
    """Changed buckets of all silver batches to current: of a transaction that comes again, the latest batch's row.

    Other buckets are neither read nor written. Sketches of the changed ones follow. A transaction that no batch has any longer is gone.
    Buckets that only one batch has are copied as they are, since a batch holds a transaction once.
    """
    buckets = pending_buckets(spark, layers)
    rows = silver_rows(spark, layers).filter(F.col(BUCKET).isin(buckets))
    found = rows.groupBy(BUCKET).agg(F.count_distinct("batch_date").alias("n"), F.count(F.lit(1)).alias("rows"))
    shared = {r[BUCKET]: r["rows"] for r in found.filter("n > 1").collect()}  # a row per bucket
    rows, columns = rows.drop("batch_date"), [c for c in rows.columns if c != "batch_date"]
    latest = rows.filter(~F.col(BUCKET).isin([*shared]))
    if shared:
        met = by_bucket(_without_derived(rows.filter(F.col(BUCKET).isin([*shared]))), shared, slots_for(max(shared.values())))
        latest = latest.unionByName(_whole(silver.latest_per_transaction(met, within=(BUCKET, SLOT)), columns))
    replace_buckets(latest, layers.current, buckets, dealt=True)
    changed = current_rows(spark, layers).filter(F.col(BUCKET).isin(buckets))
    replace_buckets(sketches.sketched(changed, BUCKET), layers.profiles, buckets)
    return buckets


def profile_parts(spark: SparkSession, layers: Layers) -> DataFrame:
    """Sketches to be merged by ``operators.sketches``: profiles of current that read none of its rows."""
    columns = _known_schema("profiles", lambda: sketches.sketched(current_rows(spark, layers), BUCKET))
    return spark.read.schema(columns).parquet(layers.profiles).drop(BUCKET)


def model(
    spark: SparkSession,
    layers: Layers,
    null_safe: bool = False,
    by_timestamp: bool = False,
) -> None:
    """Silver to gold, whole. Dimensions are stored first, so the fact joins them at their known size."""
    with scratch(spark):
        clean = current_rows(spark, layers)
        builders = gold.dimension_builders(clean, by_timestamp)
        writers.write_gold(builders, layers.gold)
        stored = {n: spark.read.parquet(f"{layers.gold}/{n}") for n in builders}
        facts = {
            "FactSales": gold.sales_fact(clean, stored, null_safe, by_timestamp),
            "FactProductBridge": gold.product_bridge(clean, stored["DimProduct"]),
        }
        writers.write_gold(facts, layers.gold)


def store(
    spark: SparkSession,
    layers: Layers,
    unknown_promotion: bool = False,
    buckets: int | None = None,
    database: str | None = None,
    by_timestamp: bool = False,
) -> Star:
    """Gold to warehouse tables, whole; rows that lack a required column or cannot be summed are set aside."""
    with scratch(spark):
        loaded = warehouse.load_typed(spark, layers.gold, unknown_promotion, fmt="parquet", by_timestamp=by_timestamp)
        if by_timestamp:  # the kept and the rejected rows share one lookup
            loaded["FactSales"] = stage(loaded["FactSales"], "remapped")
        kept, rejects = warehouse.enforce(loaded)
        writers.write_warehouse(kept, layers.warehouse, buckets, database)
        writers.write_layer(rejects, f"{layers.warehouse}_rejects", partition_by="TableName")
    return Star.stored(spark, layers.warehouse)


def _registers(spark: SparkSession, layers: Layers, changed: DataFrame) -> dict[str, DataFrame]:
    """The four keyed dimensions, grown by the members that are new in the changed rows."""
    members = {name: (changed.select(columns), columns) for name, columns in gold.ATTRIBUTES.items()}
    products = changed.select(F.explode("Product_Array").alias("Product_Name"))
    members["DimProduct"] = (products, ["Product_Name"])

    def run(name: str) -> DataFrame:
        rows, columns = members[name]
        return grow(rows, f"{layers.gold}/{name}", gold.KEYS[name], columns)

    with ThreadPoolExecutor(len(members)) as pool:
        return dict(zip(members, pool.map(run, members)))


def extend(
    spark: SparkSession,
    layers: Layers,
    buckets: list[str],
    null_safe: bool = False,
    unknown_promotion: bool = False,
) -> None:
    """Changed buckets of current to gold and warehouse, and to the tables kept for reports.

    New members join the registers of the dimensions, so that all keys given out before stay; of facts and kept
    tables the changed buckets are replaced. Only dimensions are written whole. The calendar is merged from one
    small part per bucket, so it follows rows that go as well as rows that come.
    """
    here = F.col(BUCKET).isin(buckets)
    changed = current_rows(spark, layers).filter(here)

    def calendar() -> None:
        parts = _known_schema("calendar", lambda: gold.calendar_dimension(changed, (BUCKET,)))
        replace_buckets(gold.calendar_dimension(changed, (BUCKET,)), layers.days, buckets)
        writers.write_layer(gold.merged_calendar(spark.read.schema(parts).parquet(layers.days)), f"{layers.gold}/DimDate")

    def replace_fact(name: str, rows: DataFrame) -> None:
        fields = schemas.WAREHOUSE[name].fields
        typed = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields], BUCKET)
        if name == "FactSales":
            month = F.expr("Date_Key DIV 100").cast("int")
            replace_buckets(typed.withColumn(schemas.MONTH, month), f"{layers.warehouse}/{name}", buckets, schemas.MONTH)
        else:
            replace_buckets(typed, f"{layers.warehouse}/{name}", buckets, dealt=True)

    with scratch(spark), ThreadPoolExecutor(6) as pool:
        dated = pool.submit(calendar)
        dims = _registers(spark, layers, changed)
        facts = {
            "FactSales": gold.sales_fact(changed, dims, null_safe, carried=(BUCKET,)),
            "FactProductBridge": gold.product_bridge(changed, dims["DimProduct"], (BUCKET,)),
        }
        # Rows looked up without a shuffle still lie as in current, by bucket.
        met = {"FactSales": list(gold.ATTRIBUTES), "FactProductBridge": ["DimProduct"]}
        lies = {name: all(broadcast_by_size(dims[d]) for d in of) for name, of in met.items()}
        writers.write_each(
            facts, lambda name, rows: replace_buckets(rows, f"{layers.gold}/{name}", buckets, dealt=lies[name])
        )
        dated.result()
        loaded = warehouse.load_typed(
            spark, layers.gold, unknown_promotion, fmt="parquet", by_timestamp=False, carried=(BUCKET,)
        )
        for name in facts:
            loaded[name] = loaded[name].filter(here)
        sound, rejects = warehouse.enforce(loaded, (BUCKET,))
        rejects = rejects.withColumn(BUCKET, F.coalesce(BUCKET, F.lit(ALL)))
        small = {n: rows for n, rows in sound.items() if n not in facts}
        steps = [
            pool.submit(writers.write_warehouse, small, layers.warehouse),
            *(pool.submit(replace_fact, name, sound[name]) for name in facts),
            pool.submit(replace_buckets, rejects, f"{layers.warehouse}_rejects", [*buckets, ALL], "TableName"),
        ]
        for step in steps:
            step.result()  # raises what failed
        kept.replace(spark, layers.warehouse, buckets)


def load(
    spark: SparkSession,
    root: str,
    paths: Iterable[str],
    batch_date: str,
    null_safe: bool = False,
    unknown_promotion: bool = False,
    multiline: bool = True,
    by_timestamp: bool = False,
    span: int = SPAN,
) -> dict[str, int]:
    """One batch from files to a warehouse over all batches so far; row counts of every layer.

    The work follows the batch, not the history: only buckets of transactions that the batch has, or had the
    last time, are merged, modelled and loaded again. A load that broke off is made up for by the next one.

    The date dimension has a row per day. With ``by_timestamp`` it has one per moment and season, a moment
    under two seasons doubles its sales, and gold and warehouse are built anew from all of current.
    """
    layers = Layers(root, span)
    settle(spark, layers, null_safe=null_safe, unknown_promotion=unknown_promotion, by_timestamp=by_timestamp)
    ingest(spark, layers, paths, batch_date, multiline)
    stored_before = exists(spark, layers.warehouse) and not exists(spark, layers.pending)
    counts = refine(spark, layers, batch_date)
    buckets = merge(spark, layers) if pending_buckets(spark, layers) or not stored_before else []
    if stored_before and not buckets:
        pass  # nothing has changed
    elif by_timestamp:
        model(spark, layers, null_safe, by_timestamp)
        store(spark, layers, unknown_promotion, by_timestamp=by_timestamp)
    else:
        extend(spark, layers, buckets, null_safe, unknown_promotion)
    remove(spark, layers.pending)
    stored = {"Silver": current_rows(spark, layers)}
    stored |= {n: spark.read.parquet(f"{layers.gold}/{n}") for n in schemas.TABLES if not n.startswith("Fact")}
    stored |= {n: spark.read.schema(columns).parquet(f"{layers.gold}/{n}") for n, columns in schemas.GOLD_FACTS.items()}
    # One row per table.
    counts |= {r["TableName"]: r["RowsCount"] for r in quality.row_counts(stored).collect()}
    return counts


def run_daily(spark: SparkSession, root: str, paths: Iterable[str], batch_date: str, **options) -> tuple[Star, dict[str, int]]:
    """``load`` with its options, and the star it leaves: opening that lists every folder of the warehouse."""
    counts = load(spark, root, paths, batch_date, **options)
    return Star.stored(spark, f"{root}/warehouse"), counts
