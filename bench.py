"""Times the headline queries at `$BENCH_SF_DIR` on `local[$BENCH_CPUS]`; prints one JSON line.

Every query runs once to warm up and then three times into the no-op sink, which computes all rows
and stores none; the median counts. Settings are those of `build_session`.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from ratestrata.catalog import QUERIES
from ratestrata.session import build_session

HEADLINE = [
    "stage_rates", "dedup_latest", "dim_countries", "daily_change", "plausible", "top_container", "fct_rates",
    "trailing_stats", "currency_summary", "regional_daily", "moving_avg", "rates_by_region",
    "country_currency_map", "unique", "upsert", "run_state", "currencies_by_region", "rates_table",
    "trend", "kpis", "run_checks", "daily_run", "landed_table", "csv_source",
]
# Jobs that write tables of their own: one warm-up and one measured run.
ONCE = {"kpis", "run_checks", "daily_run", "landed_table"}
RUNS = 3


def seconds(run) -> float:
    start = time.perf_counter()
    run().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    chosen = [name for name in os.environ.get("BENCH_QUERIES", "").split(",") if name] or HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="16g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in chosen:
        def run(name=name):
            return QUERIES[name](spark, sf_dir)

        seconds(run)
        times[name] = round(statistics.median(seconds(run) for _ in range(1 if name in ONCE else RUNS)), 4)
    spark.stop()
    print(json.dumps({
        "metric": "total of median query times", "value": round(sum(times.values()), 4), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
