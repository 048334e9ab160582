"""Batch file readers: text columns first, types later."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from martloom import schemas
from martloom.functions import text

FORMATS = {".csv": "csv", ".parquet": "parquet", ".json": "json"}
WORKBOOKS = (".xlsx", ".xls")


def read_csv(
    spark: SparkSession,
    paths: str | list[str],
    schema: StructType = schemas.RAW,
    multiline: bool = True,
    header: bool = True,
    one_line: bool = False,
) -> DataFrame:
    """CSV with a fixed schema and doubled-quote escaping.

    ``multiline`` keeps line breaks inside quoted cells, at the price of one task per file. Pass
    False for exports known to hold one record per line: such files are then split over many tasks.
    ``one_line`` is for files that this library wrote with it: they are split, and breaks come back.
    """
    rows = (
        spark.read.schema(schema)
        .option("header", header)
        .option("multiLine", multiline and not one_line)
        .option("escape", '"')
        .csv(paths)
    )
    if not one_line:
        return rows
    return rows.withColumns({n: text.restored(F.col(n)) for n, kind in rows.dtypes if kind == "string"})


def format_of(path: str) -> str:
    lowered = path.lower().rstrip("/")
    for suffix, name in FORMATS.items():
        if lowered.endswith(suffix):
            return name
    if lowered.endswith(WORKBOOKS):
        raise ValueError(f"Workbook {path}: export it to CSV or Parquet first, Spark reads those in parallel")
    raise ValueError(f"No reader for files like {path}")


def _read(spark: SparkSession, name: str, paths: list[str], multiline: bool) -> DataFrame:
    if name == "csv":
        return read_csv(spark, paths, multiline=multiline)
    if name == "json":
        return spark.read.schema(schemas.RAW).json(paths)
    stored = spark.read.parquet(*paths)
    return stored.select([F.col(c).cast("string").alias(c) for c in schemas.RAW_COLUMNS])


def read_any(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """Read one file or folder, the format told by its suffix."""
    return _read(spark, format_of(path), [path], multiline)


def load_daily_batch(spark: SparkSession, paths: Iterable[str], multiline: bool = True) -> DataFrame:
    """All files of a batch as one frame: one scan per format, however many files there are."""
    by_format: dict[str, list[str]] = {}
    for path in paths:
        by_format.setdefault(format_of(path), []).append(path)
    if not by_format:
        raise ValueError("No files given for the batch")
    frames = [_read(spark, name, group, multiline) for name, group in by_format.items()]
    return reduce(DataFrame.unionByName, frames)


def with_audit(raw: DataFrame, batch_date: str) -> DataFrame:
    """Raw rows plus load time and batch tag; nothing is filtered or cast."""
    return raw.withColumns(
        {"ingestion_timestamp": F.current_timestamp(), "source_batch_date": F.lit(batch_date)}
    )


def read_staging(
    spark: SparkSession,
    root: str,
    table: str,
    typed: bool = True,
    skip_header: bool | None = None,
    fmt: str = "csv",
    multiline: bool = True,
    carried: tuple[str, ...] = (),
    one_line: bool = False,
) -> DataFrame:
    """Staged rows of one warehouse table, from CSV or from Parquet brought to the same types.

    The typed flavour skips the header line and turns unreadable numbers into null; the text flavour
    keeps every line, header included, as the loaders of that flavour filter it themselves. Cells may hold
    line breaks, as this library's writers keep them; ``multiline`` and ``one_line`` as in :func:`read_csv`. ``carried`` names
    text columns of gold facts that are stored in folders by their values.
    """
    schema = schemas.staging(table, typed)
    path = f"{root}/{table}"
    if fmt == "parquet":
        declared = f"{schemas.GOLD_FACTS[table]}, {', '.join(f'{c} string' for c in carried)}" if carried else None
        stored = (spark.read.schema(declared) if declared else spark.read).parquet(path)
        kinds = {f.name: f.dataType for f in stored.schema.fields}
        same = {f.name for f in schema if kinds[f.name] == f.dataType}
        return stored.select(
            *[
                (F.col(f.name) if f.name in same else F.col(f.name).cast("string").try_cast(f.dataType)).alias(f.name)
                for f in schema
            ],
            *carried,
        )
    header = typed if skip_header is None else skip_header
    return read_csv(spark, path, schema, multiline=multiline, header=header, one_line=one_line)
