"""Time every registered query: ``BENCH_SF_DIR=... BENCH_CPUS=... python bench.py [name prefixes]``.

Prints one JSON line. The derived tables are loaded first and timed as ``load_*``; each query is
then executed in full once, its rows discarded.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from harness import registry  # noqa: E402
from harness.tables import tables  # noqa: E402
from martloom.session import build_session  # noqa: E402

LOADS = (
    "star", "spoiled", "landing", "bronze", "silver", "gold", "gold_copy", "staging_root", "text_sales",
    "warehouse_typed", "warehouse_text", "lake",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = tuple(sys.argv[1:])
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()  # JVM start is not part of any figure
    seconds: dict[str, float] = {}

    def timed(name: str, work) -> None:
        started = time.perf_counter()
        work()
        seconds[name] = round(time.perf_counter() - started, 3)

    derived = tables(spark, sf_dir)
    for name in LOADS:
        timed(f"load_{name}", lambda n=name: getattr(derived, n))
    for name, build in registry.queries().items():
        if not wanted or name.startswith(wanted):
            timed(name, lambda b=build: b(spark, sf_dir).write.format("noop").mode("overwrite").save())
    print(
        json.dumps(
            {
                "metric": "sum of loads and queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
