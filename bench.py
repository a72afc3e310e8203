"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` (default /root/testdata/sf0.1) holds the tables, ``BENCH_CPUS``
(default: all) the number of local threads. Each query is run ``BENCH_RUNS``
times (default 2) and its fastest run counts, so that neither class loading nor
code generation of the first run is measured.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame, SparkSession

from quayside.bindings import queries as bound
from quayside.bindings.frames import telemetry
from quayside.plans.cleaning import validate_messages
from quayside.session import configure

HEADLINE = (
    "reject_reason",
    "clean_rows_rmg",
    "clean_messages",
    "stuck_runs",
    "stuck_runs_split",
    "dedupe_first",
    "hourly_backfill",
    "hourly_fact_rmg",
    "supplier_hourly_fact",
    "nation_fleet",
    "rejected_summary",
    "hourly_fleet",
    "latest_n",
    "dim_equipment",
    "raw_upsert",
    "topic_profile",
    "stuck_stream",
    "stream_clean",
)
# Queries whose seconds per row are worth a figure of their own.
RATES = ("validate_messages", "stuck_runs", "stuck_stream", "stream_clean")


def validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate_messages(telemetry(spark, sf_dir))


def consume(df: DataFrame) -> None:
    """Compute every column of every row, and keep nothing."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "*")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    threads = os.cpu_count() if cpus == "*" else int(cpus)
    spark = configure(
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("quayside-bench")
        .config("spark.sql.shuffle.partitions", str(threads))
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    messages = telemetry(spark, sf_dir).count()
    readings = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    todo = {"validate_messages": validate, **{name: bound.QUERIES[name] for name in HEADLINE}}
    seconds: dict[str, float] = {}
    for name, query in todo.items():
        for _ in range(runs):
            started = time.perf_counter()
            consume(query(spark, sf_dir))
            taken = time.perf_counter() - started
            seconds[name] = round(min(taken, seconds.get(name, taken)), 3)
    rows = {"validate_messages": messages, "stream_clean": messages}
    rates = {name: round(rows.get(name, readings) / seconds[name]) for name in RATES}
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "rows_per_second": rates,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
