"""Headline queries on local[$BENCH_CPUS] over $BENCH_SF_DIR; prints one JSON line.

Each query runs once to warm up and then $BENCH_RUNS times (default 3); its figure is the
median.  Results go to the ``noop`` sink, so every column of every row is computed and
nothing is pulled to the driver.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

os.environ.setdefault("PYTHONWARNINGS", "ignore")

from portolan.plans.all import REGISTRY
from portolan.session import local_session

HEADLINE = [
    "trades_by_branch_and_currency",
    "trades_by_branch_and_type",
    "daily_trade_summary",
    "daily_summary_of_joined_trades",
    "harmonized_trades",
    "customer_trade_summary",
    "rep_performance",
    "deal_summary",
    "sales_statistics",
    "monthly_won_running_total",
    "amounts_seen_by_analyst",
    "deals_of_entitled_user",
    "detected_pii_columns",
    "accounts_as_of",
    "trades_after_restore",
    "classified_notes",
    "label_shares_of_sample",
    "note_search_suspicious",
    "document_search",
    "nearest_vectors",
    "csv_good_rows",
    "transfer_details",
    "statement_entries",
    "incremental_daily_totals",
    "metrics_by_segment_and_currency",
]


def timed(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    REGISTRY[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus)
    seconds = {}
    for name in names:
        timed(spark, name, sf_dir)
        seconds[name] = round(statistics.median(timed(spark, name, sf_dir) for _ in range(runs)), 3)
    spark.stop()
    print(json.dumps({
        "metric": "total_seconds_headline_queries", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")),
    }))


if __name__ == "__main__":
    main()
