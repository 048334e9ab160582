"""The star schema as one object, and the roll-up every revenue report is built from."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom import schemas
from martloom.functions.numbers import exact
from martloom.operators.gold import KEYS
from martloom.plans.sizes import broadcast_by_size
from martloom.sources.files import exists


@dataclass(frozen=True)
class Star:
    """The seven warehouse tables, and what a daily load keeps beside them.

    Reports read the kept tables where a star has them and give the same rows either way.
    """

    DimCustomer: DataFrame
    DimDate: DataFrame
    DimProduct: DataFrame
    DimPromotion: DataFrame
    DimStore: DataFrame
    FactSales: DataFrame
    FactProductBridge: DataFrame
    SalesByMonth: DataFrame | None = None
    DailySums: DataFrame | None = None
    CustomerParts: DataFrame | None = None
    Baskets: DataFrame | None = None

    @classmethod
    def stored(cls, spark: SparkSession, root: str) -> Star:
        """Star over Parquet tables written by ``write_warehouse``, ``write_gold`` or the daily load."""
        tables = {t: spark.read.parquet(f"{root}/{t}") for t in schemas.TABLES if not t.startswith("Fact")}
        for name in ("FactSales", "FactProductBridge"):
            # Declared, as a folder of buckets may hold no file.
            stored = spark.read.schema(schemas.stored(name)).parquet(f"{root}/{name}")
            if name == "FactSales" and schemas.MONTH in stored.columns:
                months = F.col(schemas.MONTH).cast("int").alias(schemas.MONTH)
                tables["SalesByMonth"] = stored.select(*schemas.WAREHOUSE[name].names, months)
            tables[name] = stored.select(*schemas.WAREHOUSE[name].names)
        for name, columns in schemas.KEPT.items():
            if exists(spark, f"{root}/{name}"):
                tables[name] = spark.read.schema(columns).parquet(f"{root}/{name}").drop("bucket")
        return cls(**tables)

    def bare(self) -> Star:
        """The seven tables alone."""
        return replace(self, SalesByMonth=None, DailySums=None, CustomerParts=None, Baskets=None)

    def register(self) -> None:
        """Temporary views under the table names, for reports written in SQL."""
        for name in schemas.TABLES:
            getattr(self, name).createOrReplaceTempView(name)

    def dimension_of(self, attribute: str) -> str:
        """Dimension holding a descriptive column."""
        for name in KEYS:
            if attribute in schemas.WAREHOUSE[name].names and attribute != KEYS[name]:
                return name
        raise KeyError(attribute)


def figures() -> dict[str, Column]:
    """Additive figures of the fact: each may be summed again after any grouping."""
    return {
        "amount": F.sum(exact(F.col("Total_Cost"))),
        "costed": F.count("Total_Cost"),
        "sales": F.count("Transaction_ID"),
        "items": F.sum("Total_Items"),
        "counted": F.count("Total_Items"),
    }


def summed_again() -> dict[str, Column]:
    """The same figures over rows that hold them already."""
    return {name: F.sum(name) for name in figures()}


def sums(named: dict[str, Column]) -> list[Column]:
    return [column.alias(name) for name, column in named.items()]


def roll_up(
    star: Star,
    base: DataFrame,
    attributes: Sequence[str],
    figures: dict[str, Column],
    carried: Sequence[str] = (),
) -> DataFrame:
    """Additive ``figures`` of ``base`` by dimension attributes, and by columns it carries itself.

    A dimension that Spark would broadcast by size is looked up row by row, so only the final groups
    are shuffled. For any larger dimension ``base`` is first reduced to its key: the join then sees
    one row per key, and a member holding a third of all rows weighs as much as any other.
    """
    wanted: dict[str, list[str]] = {}
    for a in attributes:
        wanted.setdefault(star.dimension_of(a), []).append(a)
    parts = {d: getattr(star, d).select(KEYS[d], *columns) for d, columns in wanted.items()}
    small = [d for d in parts if broadcast_by_size(parts[d])]
    large = [d for d in parts if d not in small]
    for d in small:
        base = base.join(parts[d], KEYS[d])
    if not large:
        return base.groupBy(*carried, *attributes).agg(*sums(figures))
    known = [a for d in small for a in wanted[d]]
    totals = base.groupBy(*carried, *known, *[KEYS[d] for d in large]).agg(*sums(figures))
    for d in large:
        totals = totals.join(parts[d], KEYS[d])
    return totals.groupBy(*carried, *attributes).agg(*[F.sum(n).alias(n) for n in figures])


def sales_by(star: Star, *attributes: str) -> DataFrame:
    """Additive fact figures grouped by dimension attributes (inner star join)."""
    dims = {star.dimension_of(a) for a in attributes}
    if star.CustomerParts is not None and dims == {"DimCustomer"}:
        return roll_up(star, star.CustomerParts, attributes, summed_again())
    if star.DailySums is not None and "Customer_Name" not in attributes:
        return roll_up(star, star.DailySums, attributes, summed_again())
    return roll_up(star, star.FactSales, attributes, figures())


def sales_per_key(star: Star, key: str) -> DataFrame:
    if star.DailySums is not None and key != "Customer_Key":
        return star.DailySums.groupBy(key).agg(*sums(summed_again()))
    return star.FactSales.groupBy(key).agg(*sums(figures()))
