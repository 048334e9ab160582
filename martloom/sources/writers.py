"""Layer writers. Output stays spread over many files; nothing is squeezed into one task."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from martloom import schemas
from martloom.functions import text
from martloom.sources.staging import PACKED


def flatten_arrays(df: DataFrame, separator: str = ", ") -> DataFrame:
    """Array columns as joined text, for formats without arrays."""
    arrays = [f.name for f in df.schema.fields if isinstance(f.dataType, ArrayType)]
    return df.withColumns({c: F.concat_ws(separator, F.col(c)) for c in arrays}) if arrays else df


def write_layer(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    partition_by: str | None = None,
    mode: str = "overwrite",
    one_line: bool = False,
    compression: str | None = None,
) -> None:
    """Write one layer table as Parquet, or as CSV with header and exact blanks.

    ``one_line`` writes line breaks in cells by marks, so that a record is a line and readers told so
    (``one_line`` there) can split a file over many tasks. ``compression`` of text is for files that are read whole
    anyway: packed ones cannot be split. Parquet is always packed.
    """
    if fmt == "csv":
        flat = flatten_arrays(df)
        if one_line:
            flat = flat.withColumns({n: text.one_line(F.col(n)) for n, kind in flat.dtypes if kind == "string"})
        writer = (
            flat.write.option("header", True)
            .option("escape", '"')
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
        )
    elif fmt == "parquet":
        writer, compression = df.write, compression or PACKED
    else:
        raise ValueError(f"Unsupported output format: {fmt}")
    if partition_by:
        writer = writer.partitionBy(partition_by).option("partitionOverwriteMode", "dynamic")
    if compression:
        writer = writer.option("compression", compression)
    writer.mode(mode).format(fmt).save(path)


def write_batch(rows: DataFrame, path: str, batch_date: str, fmt: str = "parquet") -> None:
    """Replace one batch's folder and leave every other batch as it is, so a re-run changes nothing.

    The folder itself is written: a batch that is empty this time clears what it held before.
    """
    write_layer(rows, f"{path}/batch_date={batch_date}", fmt)


write_bronze = write_batch


Table = DataFrame | Callable[[], DataFrame]


def write_each(tables: Mapping[str, Table], write: Callable[[str, DataFrame], None], at_once: int = 4) -> None:
    """Write independent tables as concurrent jobs, so small ones fill the gaps large ones leave.

    A table may be given as a function building it: keyed dimensions already run jobs while built.
    """

    def run(name: str) -> None:
        table = tables[name]
        write(name, table if isinstance(table, DataFrame) else table())

    with ThreadPoolExecutor(at_once) as pool:
        # Consuming the results raises the first failure.
        list(pool.map(run, tables))


def write_gold(tables: Mapping[str, Table], root: str, fmt: str = "parquet", one_line: bool = False) -> None:
    write_each(tables, lambda name, table: write_layer(table, f"{root}/{name}", fmt, one_line=one_line))


def write_warehouse(
    tables: Mapping[str, Table], root: str, buckets: int | None = None, database: str | None = None
) -> None:
    """Store loaded tables as Parquet of the warehouse types under ``root``.

    With ``buckets`` the two transaction-grain tables are registered in ``database`` and bucketed by
    Transaction_ID, so joins between them need no shuffle.
    """

    def write(name: str, loaded: DataFrame) -> None:
        fields = schemas.WAREHOUSE[name].fields
        table = loaded.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in fields])
        if not (buckets and name.startswith("Fact")):
            write_layer(table, f"{root}/{name}")
            return
        (
            table.repartition(buckets, "Transaction_ID")
            .write.mode("overwrite")
            .format("parquet")
            .option("path", f"{root}/{name}")
            .bucketBy(buckets, "Transaction_ID")
            .sortBy("Transaction_ID")
            .saveAsTable(f"{database}.{name}" if database else name)
        )

    write_each(tables, write)
