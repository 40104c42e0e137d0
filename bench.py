"""Time the headline queries and print one JSON line.

Each query runs once to warm up, then ``BENCH_RUNS`` times; the median of building the plan plus writing all
columns to a discarding sink is reported.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from vinculo.catalogue import ENTRIES, Tables
from vinculo.session import build_session

HEADLINE = (
    "normalized_text",
    "roster_features",
    "partners_by_fragment",
    "partners_by_name",
    "name_scores",
    "similar_names",
    "similar_names_by_signature",
    "nested_establishments",
    "company_profiles",
    "association_lists",
    "founder_window",
    "registry_from_csv",
    "gold_roster",
)


def timed(name: str, tables: Tables) -> float:
    """Seconds from the query's call until its last row has been produced."""
    started = time.perf_counter()
    ENTRIES[name].run(tables).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "vinculo-bench",
        master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="20g",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="vinculo-bench-"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    tables = Tables(spark, folder)
    seconds = {}
    for name in HEADLINE:
        timed(name, tables)
        seconds[name] = round(statistics.median(timed(name, tables) for _ in range(runs)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
