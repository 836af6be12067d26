"""Time the headline queries: one warm-up, then the median of `$BENCH_RUNS` runs (3).

Reads `$BENCH_SF_DIR` (default /root/testdata/sf0.1) on `local[$BENCH_CPUS]` and prints one
JSON line. Results are forced with the noop writer; building the plan counts.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from rillhouse.plans import queries
from rillhouse.session import build_session

HEADLINES = (
    "visitor_stats",
    "visitor_stats_layered",
    "log_topics",
    "new_visitor_fix",
    "unique_visit",
    "user_jump",
    "cdc_envelope",
    "rule_column_filter",
    "dim_latest",
    "order_interval_join",
    "lookup_user",
    "lookup_category",
    "order_wide",
    "payment_wide",
)


def timed(spark, fn, sf_dir: str) -> float:
    start = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="16g"
    )
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINES)).split(",")
    table = queries.all_queries()
    took = {}
    for name in names:
        timed(spark, table[name], sf_dir)
        took[name] = round(
            statistics.median(timed(spark, table[name], sf_dir) for _ in range(runs)), 3
        )
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(took.values()), 3),
                "unit": "sec",
                "queries": took,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
                "spark": spark.version,
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
