"""Time the headline queries and print one JSON line.

Each query runs once to warm up and then ``BENCH_RUNS`` times; the median counts.
Results go to Spark's no-op sink, so every row and column is computed and nothing
is collected. The marts are timed twice: derived all the way from the raw tables
(``sessions``) and from a stored silver table as the batch jobs read it
(``stored_sessions``).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession

from skylattice import driver_tables, registry
from skylattice.operators.sessions import build_sessions, session_observations
from skylattice.plans import jobs, marts
from skylattice.scratch import new_path
from skylattice.session import RECOMMENDED
from skylattice.sources import read_silver, write_table

DERIVED = (
    "envelope_roundtrip",
    "bbox_filter",
    "silver_dedup",
    "silver_enrich",
    "aircraft_activity",
    "airline_counts",
    "altitude_speed",
    "session_observations",
    "sessions",
    "area_duration",
    "session_quality",
    "rollup_sessions",
    "stream_bronze",
    "stream_silver",
    "stream_sessions",
)


def build_bench_session(cpus: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", cpus)
    )
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def consume(result: DataFrame | None) -> None:
    if result is not None:
        result.write.format("noop").mode("overwrite").save()


def stored_cases(spark: SparkSession, sf_dir: str) -> dict:
    """The batch jobs' own work on a silver table written beforehand."""
    path = new_path(spark, "silver")
    write_table(driver_tables.silver(spark, sf_dir), path)

    def silver() -> DataFrame:
        return read_silver(spark, path)

    def all_reports() -> None:
        jobs.generate_all_reports(spark, path, new_path(spark, "marts"))

    return {
        "stored_aircraft_activity": lambda: marts.aircraft_activity(silver()),
        "stored_airline_counts": lambda: marts.airline_counts(silver()),
        "stored_altitude_speed": lambda: marts.altitude_speed(silver()),
        "stored_session_observations": lambda: session_observations(silver()),
        "stored_sessions": lambda: build_sessions(silver()),
        "stored_area_duration": lambda: marts.monitored_area_duration(silver())[0],
        "stored_run_date": lambda: read_silver(spark, path, run_date=registry.RUN_DATE),
        "all_reports": all_reports,
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_bench_session(cpus)
    cases = {
        name: (lambda query=registry.QUERIES[name]: query(spark, sf_dir)) for name in DERIVED
    }
    cases.update(stored_cases(spark, sf_dir))
    first, medians = {}, {}
    for name, case in cases.items():
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            consume(case())
            times.append(time.perf_counter() - start)
        first[name] = round(times[0], 3)
        medians[name] = round(statistics.median(times[1:]), 3)
        print(f"{name:32s} first {first[name]:7.3f}  median {medians[name]:7.3f}", file=sys.stderr)
    print(
        json.dumps(
            {
                "metric": "sum of median query times",
                "value": round(sum(medians.values()), 3),
                "unit": "sec",
                "queries": medians,
                "first_run": first,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
