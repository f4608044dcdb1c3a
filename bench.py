"""Time the headline queries and print one JSON line.

Each query is run once to warm up and then three times; the median counts.
Queries that write files do all of their writing in each run. ``python bench.py
all`` times every registered query.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from rollcall import catalogue
from rollcall.session import local_session

RUNS = 3

# One query for each kind of work; the others differ in input or in the table.
HEADLINE = [
    "hires_enriched",
    "hires_enriched_large_lookup",
    "hires_in_year",
    "hires_by_quarter",
    "hires_by_quarter_large_lookup",
    "mean_hires",
    "departments_above_mean",
    "refine_distinct",
    "refine_hot_copies",
    "normalise_history",
    "normalise_files",
    "ingest_csv_distinct",
    "append_capped",
    "append_records_ok",
    "stream_append_records",
    "stream_into_table",
    "backup_restore_one",
    "refined_summary",
]


def seconds(spark, run, sf_dir: str) -> float:
    start = time.perf_counter()
    run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, int(cpus) if cpus.isdigit() else 8)
    times = {}
    for key in catalogue.QUERIES if sys.argv[1:] == ["all"] else HEADLINE:
        run = catalogue.QUERIES[key]
        seconds(spark, run, sf_dir)
        times[key] = round(statistics.median(seconds(spark, run, sf_dir) for _ in range(RUNS)), 3)
    print(
        json.dumps(
            {
                "metric": "sum of median query times",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(sf_dir.rstrip("/").rsplit("sf", 1)[-1]),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
