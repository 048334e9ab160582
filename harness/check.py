"""Compare every registered query with its SQL counterpart: ``python -m harness.check [sf_dir] [names]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

from harness import oracle, registry
from martloom.session import build_session

GIVEN = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()

# Plan parts no query may contain: row-by-row crossing of tables, and Python per row.
UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in GIVEN:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return value if value is None else str(value)


def table(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    """Rows in a canonical order, columns sorted by name, values as text."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    found = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(found, key=lambda r: [(v is not None, v or "") for v in r])


def compare(spark, con, name: str, sf_dir: str) -> tuple[bool, str]:
    started = time.time()
    frame = registry.queries()[name](spark, sf_dir)
    unwanted = [part for part in UNWANTED if part in frame._jdf.queryExecution().executedPlan().toString()]
    if unwanted:
        return False, f"plan holds {unwanted}"
    mine = table(frame.columns, frame.collect())
    took = time.time() - started
    cursor = con.execute(oracle.statements()[name])
    theirs = table([d[0] for d in cursor.description], cursor.fetchall())
    note = f"{took:6.2f}s {len(mine[1])} rows"
    if mine == theirs:
        return True, note
    if mine[0] != theirs[0]:
        return False, f"{note}; columns {mine[0]} <> {theirs[0]}"
    left, right = set(mine[1]) - set(theirs[1]), set(theirs[1]) - set(mine[1])
    return False, f"{note} vs {len(theirs[1])}; only here {sorted(left, key=str)[:2]}; only there {sorted(right, key=str)[:2]}"


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = build_session(
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    for name in registry.queries():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        if name not in oracle.statements():
            print(f"NONE  {name}")
            continue
        try:
            same, note = compare(spark, con, name, sf_dir)
        except Exception as error:  # report and go on with the next query
            same, note = False, str(error)[:700]
        bad += not same
        print(f"{'same ' if same else 'DIFF '} {name:32s} {note}", flush=True)
    print(f"{bad} differing")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
