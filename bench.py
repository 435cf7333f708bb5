"""Times the headline queries over $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is run to the end (every column of every row is computed, nothing is kept) once
to warm up and then BENCH_RUNS times; the median counts.  ``full_build`` is a whole build
from the landed raw tables to the star.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from collections.abc import Callable
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from parity import adapter  # noqa: E402
from parity.queries import QUERIES, RUN_2, house, landed  # noqa: E402
from tidemark.plans.build import run_build  # noqa: E402
from tidemark.session import local_session  # noqa: E402
from tidemark.sources.store import Scratch  # noqa: E402

HEADLINES = (
    "silver_listings", "host_versions", "listing_versions", "host_latest", "listing_latest",
    "scd2_timestamp_two_runs", "key_resolution", "asof_join", "fact_listings",
    "mart_listing_neighbourhood", "mart_property_type", "mart_host_neighbourhood",
    "mom_change", "dq_report",
)


def finish(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def full_build(spark: SparkSession, raw: dict[str, DataFrame]) -> None:
    run_build(spark, raw, Scratch(spark, "bench-build").path, RUN_2, cutoff=adapter.CUTOFF)


def timed(work: Callable[[], None], runs: int) -> float:
    work()
    times = []
    for _ in range(runs):
        start = time.perf_counter()
        work()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    wanted = [n for n in os.environ.get("BENCH_ONLY", "").split(",") if n]
    spark = local_session(cpus)
    spark.sparkContext.setLogLevel("ERROR")
    raw = landed(spark, sf_dir)
    house(spark, sf_dir)
    work = {"full_build": lambda: full_build(spark, raw)}
    work |= {n: (lambda n=n: finish(QUERIES[n](spark, sf_dir))) for n in HEADLINES}
    times = {n: timed(w, runs) for n, w in work.items() if not wanted or n in wanted}
    spark.stop()
    print(json.dumps({
        "metric": "total_query_time", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": Path(sf_dir).name.removeprefix("sf"), "cpus": cpus,
        "runs": runs,
    }))


if __name__ == "__main__":
    main()
