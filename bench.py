"""Timings of every registered query; prints one JSON line.

BENCH_SF_DIR  tables (default /root/testdata/sf0.1)
BENCH_CPUS    cores of the local session (default 8)
BENCH_RUNS    rounds over all queries (default 4); the first one warms up
BENCH_BUDGET  seconds after which no further query is run (default 1200)
BENCH_ONLY    comma-separated query names (default all)

A query's figure is the median of its runs but the first, or that one if there was no time for
more. Each run is reported on stderr as it ends; queries that were never run are listed.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F

from talentlake.plans import inputs
from talentlake.plans.queries import QUERIES

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "4"))
BUDGET = float(os.environ.get("BENCH_BUDGET", "1200"))
ONLY = [name for name in os.environ.get("BENCH_ONLY", "").split(",") if name]


def run(spark: SparkSession, name: str) -> tuple[float, int]:
    """Seconds to build and run a query to its last row, and its rows."""
    seen = Observation()
    start = time.perf_counter()
    df = QUERIES[name](spark, SF_DIR).observe(seen, F.count("*").alias("rows"))
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start, seen.get["rows"]


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("talentlake-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    start = time.perf_counter()
    rows_in = {
        "roster": inputs.roster(spark, SF_DIR).count(),
        "values": inputs.values(spark, SF_DIR).count(),
        **{
            name: inputs.table(spark, SF_DIR, name).count()
            for name in ("documents", "orders", "lineitem", "events", "pages")
        },
    }
    landing = time.perf_counter() - start

    runs: dict[str, list[float]] = {}
    rows_out: dict[str, int] = {}
    names = ONLY or list(QUERIES)
    for round_ in range(RUNS):
        for name in names:
            if time.perf_counter() - start > BUDGET:
                break
            took, rows_out[name] = run(spark, name)
            runs.setdefault(name, []).append(took)
            print(f"{round_} {name} {took:.2f} s, {rows_out[name]} rows", file=sys.stderr, flush=True)
    seconds = {name: round(statistics.median(taken[1:] or taken), 3) for name, taken in runs.items()}

    print(
        json.dumps(
            {
                "metric": "sum of medians over all queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(SF_DIR).name.removeprefix("sf"),
                "cpus": int(CPUS),
                "runs": min(map(len, runs.values()), default=0),
                "not_run": [name for name in names if name not in runs],
                "landing_sec": round(landing, 3),
                "rows_in": rows_in,
                "rows_out": rows_out,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
