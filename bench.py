"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores.
Each query runs twice and the faster run counts, from building the plan to the last result row
(written to Spark's no-op sink, so nothing is collected to Python).
"""

from __future__ import annotations

import json
import os
import time

from barweave.session import local_session
from workload.queries import QUERIES

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = 2

HEADLINE = [
    "src_backfill_csv",
    "src_quotes",
    "sink_dynamic_overwrite",
    "split_factors",
    "split_asof_map",
    "adjusted_bars",
    "price_array_agg",
    "cumulative_backfill",
    "cumulative_daily",
    "late_split_fix",
    "dim_daily_prices",
    "current_day_init",
    "latest_quote",
    "merge_matched_update",
    "apply_quotes",
    "top50_above_last_day",
    "top50_by_cap",
    "change_by_cap",
    "dq_report",
    "catchup_three_days",
    "catchup_three_days_bucketed",
    "stream_current_day",
]


def run(spark, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = local_session(CPUS)
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {name: round(min(run(spark, name) for _ in range(RUNS)), 3) for name in HEADLINE}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
