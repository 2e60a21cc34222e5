"""Time the headline queries on the shared test tables; prints one JSON line.

BENCH_SF_DIR chooses the tables, BENCH_CPUS the local threads. Each query is written to a
no-op sink, so every row and column is computed; the best of BENCH_RUNS runs counts.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from candleforge import session
from candleforge.registry.queries import QUERIES

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))

HEADLINE = [
    "ohlcv_hourly",
    "ohlcv_daily",
    "ohlcv_daily_from_hourly",
    "symbol_summary",
    "daily_volume_trend",
    "symbol_overview",
    "intraday_price_path",
    "data_freshness",
    "dq_summary",
    "symbol_rollup",
    "silver_typed",
    "silver_from_bronze",
    "silver_dedup",
    "upsert_match",
    "dq_suite",
    "contract_violations_bronze",
    "quarantine",
    "rejection_gate",
    "row_floor_gate",
    "fingerprint",
    "change_detection",
    "missing_sources",
    "zip_scan",
    "run_status",
    "tier_report",
]

# Queries that write tables first; timed once.
WRITING = ["silver_upsert", "compact", "cluster_by", "daily_load_to_gold"]

# Rows per second are comparable with published operational numbers.
RATES = {
    "bronze_parse": ("zip_scan", "events"),
    "silver": ("silver_from_bronze", "events"),
    "hourly_candles": ("ohlcv_hourly", "events"),
    "dedup": ("silver_dedup", "lineitem"),
}


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    session.prepare(spark)

    def timed(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    timed("ohlcv_hourly")  # start the JVM's compilers and the Python workers
    timed("zip_scan")
    seconds = {name: round(min(timed(name) for _ in range(RUNS)), 3) for name in HEADLINE}
    seconds |= {name: round(timed(name), 3) for name in WRITING}
    rates = {}
    for label, (name, table) in RATES.items():
        rows = spark.read.parquet(f"{SF_DIR}/{table}.parquet").count()
        rates[f"{label}_rows_per_sec"] = round(rows / seconds[name])
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "rates": rates,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "cpus": int(CPUS),
            }
        )
    )


if __name__ == "__main__":
    main()
