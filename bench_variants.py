"""Times alternative forms of the same operator on stored tables; prints one JSON line.

The tables are built from `$BENCH_SF_DIR`. Every form runs once to warm up, then three times; the
median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import functions as F

from ratestrata import adapters as A, catalog as C, schemas
from ratestrata.operators import containment, series
from ratestrata.plans import gold, silver
from ratestrata.session import build_session, shared_folder
from ratestrata.sources import landing as L

PAIR = silver.PAIR
KEYS = [*PAIR, "rate_date"]


def facts_by_one_exchange(staged):
    """Hash by pair first: dedup and lag share it, at the price of whole pairs per task."""
    newest = series.dedup_latest(staged.repartition(*PAIR), KEYS, "extracted_at")
    return series.daily_change(series.plausible(newest, "rate"), PAIR, "rate_date", "rate")


def facts_by_two_exchanges(staged):
    newest = series.dedup_latest(staged, ["rate_date", *reversed(PAIR)], "extracted_at")
    return series.daily_change(series.plausible(newest, "rate"), PAIR, "rate_date", "rate")


def regional_by_fan_out(fct, dim):
    r, c = fct.alias("r"), dim.alias("c")
    on = (F.col("c.region") == F.col("r.currency_region")) & F.col("c.currencies").contains(F.col("r.target_currency"))
    return r.filter(F.col("rate_date") >= F.date_sub(F.lit(A.AS_OF).cast("date"), 30)).join(c, on, "left").groupBy(
        "rate_date", *PAIR, F.coalesce("r.currency_region", F.lit("Unknown")).alias("region"), "primary_country_name"
    ).agg(
        F.avg("rate"), F.min("rate"), F.max("rate"), F.avg("rate_change_pct"), F.count_distinct("c.cca2"),
    )


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = build_session(
        "variants", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="16g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    root = shared_folder(spark, "variants")

    def stored(name, df, *order):
        (df.repartitionByRange(*order).sortWithinPartitions(*order) if order else df.coalesce(1)).write.parquet(f"{root}/{name}")
        return spark.read.parquet(f"{root}/{name}")

    staged = stored("staged", A.staged_rates(spark, sf_dir), "pipeline_run_id")
    dim = stored("dim", C.countries(spark, sf_dir))
    fct = stored("fct", silver.fct_rates(staged, dim, codes=A.target_codes(spark, sf_dir)), "rate_date", "target_currency")
    raw = stored("raw", A.raw_rates(spark, sf_dir), "_pipeline_run_id")
    day = raw.filter(F.col("rate_date") == A.AS_OF)
    paths = {"month": f"{root}/by_month/t", "whole": f"{root}/whole/t"}
    L.land(spark, paths["month"], raw, KEYS, schemas.RAW_RATES, L.RATE_MONTH)
    L.land(spark, paths["whole"], raw, KEYS, schemas.RAW_RATES)

    def sink(df):
        df.write.format("noop").mode("overwrite").save()

    def regions(match):
        return containment.top_container(
            fct.select(*KEYS), dim, "target_currency", "currencies", "population", {"region": "region"}, match
        )

    variants = {
        "summary_one_pass": lambda: sink(gold.currency_summary(fct, A.AS_OF)),
        "summary_joined": lambda: sink(gold.currency_summary_joined(fct, A.AS_OF)),
        "facts_one_exchange": lambda: sink(facts_by_one_exchange(staged)),
        "facts_two_exchanges": lambda: sink(facts_by_two_exchanges(staged)),
        "container_substring": lambda: sink(regions("substring")),
        "container_token": lambda: sink(regions("token")),
        "regional_fan_out": lambda: sink(regional_by_fan_out(fct, dim)),
        "regional_counted": lambda: sink(gold.regional_daily(fct, dim, A.AS_OF)),
        "upsert_day_by_month": lambda: L.land(spark, paths["month"], day, KEYS, schemas.RAW_RATES, L.RATE_MONTH),
        "upsert_day_whole_table": lambda: L.land(spark, paths["whole"], day, KEYS, schemas.RAW_RATES),
    }
    times = {}
    for name, run in variants.items():
        took = []
        for _ in range(4):
            start = time.perf_counter()
            run()
            took.append(time.perf_counter() - start)
        times[name] = round(statistics.median(took[1:]), 3)
    spark.stop()
    print(json.dumps({"metric": "median of variant times", "unit": "sec", "variants": times}))


if __name__ == "__main__":
    main()
