"""Headline queries, timed to full evaluation: prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from checks.queries import queries
from stammwerk.session import RECOMMENDED_SETTINGS

HEADLINE = [
    "feed_partner_info_initial",
    "feed_partner_info_delta",
    "feed_counterparty_initial",
    "feed_account_initial",
    "feed_cust_support_initial",
    "feed_cust_support_delta",
    "feed_acct_manager_initial",
    "current_account",
    "current_support",
    "unit_code_decode",
    "flatten_short",
    "flatten_full",
    "flatten_full_spread",
    "flatten_short_from_current",
    "flatten_full_from_current",
    "flatten_all_versions",
    "sink_bucketed",
    "job_run_feed",
    "job_run_feeds",
    "job_run_flatten",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
    )
    for key, value in RECOMMENDED_SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    found = queries()
    spark.read.parquet(f"{sf_dir}/orders.parquet").write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        # The best of a few runs: the first one also pays for code generation.
        times = []
        for _ in range(runs):
            started = time.perf_counter()
            found[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - started)
        seconds[name] = round(min(times), 3)
    print(
        json.dumps(
            {
                "metric": "total seconds, headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
