"""What a landed batch changes in the facts: the months it touches, and the months of the rows that follow its rows.

A fact depends on the landed rows of its pair and day, on the last clean row before it, and on the countries that list its
code. So three sets of months are built again: those that were landed anew, those in which the first row of a pair follows
a last row that changed, and those with a code whose country changed. All others keep their files.

Months are text such as `2024-01`; their number is bounded by the calendar, so lists of them may pass through the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ratestrata import schemas
from ratestrata.operators.containment import CODE, container_map
from ratestrata.operators.segments import halo, over_segments, tails
from ratestrata.operators.series import change_columns, dedup_latest, plausible
from ratestrata.plans import silver, staging
from ratestrata.sources.landing import WHOLE, landed_folders, read_landing

MONTH = "rate_month"
PAIR = silver.PAIR
KEPT = {"region": "currency_region", "name_common": "primary_country_name"}


def month_of(day: str = "rate_date") -> Column:
    return F.date_format(day, "yyyy-MM")


def months_since(spark: SparkSession, path: str, version: int | None) -> list[str] | None:
    """Months of the landed table that batches after `version` wrote; None if it has no months, or no version is known."""
    folders = landed_folders(spark, path)
    if version is None or folders is None:
        return None
    newer = folders.filter(F.col("version") > version).select(F.substring("folder", 1, 7).alias("month")).distinct()
    months = sorted(row[0] for row in newer.collect())
    return None if WHOLE in months else [month for month in months if month[:1].isdigit()]


def clean_rates(spark: SparkSession, path: str, months: Sequence[str], lo: float = 0, hi: float = 1_000_000) -> DataFrame:
    """Newest plausible row per pair and day of some months, with `rate_month`; no other landed files are read."""
    folders = landed_folders(spark, path).filter(F.substring("folder", 1, 7).isin(list(months))).select("folder")
    rates = staging.stage_rates(read_landing(spark, path, schemas.RAW_RATES, folders))
    newest = dedup_latest(rates, ["rate_date", *reversed(PAIR)], "extracted_at")
    return plausible(newest, "rate", lo, hi).withColumn(MONTH, month_of())


def code_countries(dim: DataFrame, codes: DataFrame, code_lengths: Sequence[int] | None = None) -> DataFrame:
    """Region and name of the most populous country or countries that list each code."""
    best = container_map(dim, "currencies", "population", list(KEPT), codes, "target_currency", "substring", code_lengths)
    return best.withColumnsRenamed({CODE: "code", **KEPT})


def last_rows(rows: DataFrame) -> DataFrame:
    """The last row of every pair and month: what carries the previous rate over the cut between months."""
    return tails(rows.select(*PAIR, MONTH, "rate_date", "rate"), PAIR, MONTH, ["rate_date"])


def differing(one: DataFrame, other: DataFrame) -> DataFrame:
    """Rows that stand in one of two tables only; NULL equals NULL."""
    return one.exceptAll(other).unionByName(other.exceptAll(one))


def following_months(before: DataFrame, after: DataFrame, months: Sequence[str]) -> list[str]:
    """Months of the first rows behind last rows that changed: the change is handed to no row beyond.

    `before` and `after` are the last rows of all pairs and months; they differ in `months` only.
    """
    there = F.col(MONTH).isin(list(months))
    changed = differing(before.filter(there), after.filter(there)).select(*PAIR, MONTH).distinct()
    # a pair's months and marks in order; a mark stands behind its own month
    marks = after.select(*PAIR, MONTH, F.lit(0).alias("mark")).unionByName(changed.select(*PAIR, MONTH, F.lit(1).alias("mark")))
    behind = Window.partitionBy(*PAIR).orderBy(MONTH, "mark").rowsBetween(1, Window.unboundedFollowing)
    following = F.first(F.when(F.col("mark") == 0, F.col(MONTH)), ignorenulls=True).over(behind)
    found = marks.withColumn("following", following).filter("mark = 1 and following is not null").select("following").distinct()
    return sorted({row[0] for row in found.collect()} - set(months))


def months_of_codes(ends: DataFrame, before: DataFrame, after: DataFrame) -> list[str]:
    """Months that hold a code whose country or countries changed."""
    codes = differing(before, after).select(F.col("code").alias("target_currency")).distinct()
    return sorted(row[0] for row in ends.join(codes, "target_currency", "left_semi").select(MONTH).distinct().collect())


def facts_of_months(clean: DataFrame, ends: DataFrame, countries: DataFrame) -> DataFrame:
    """The facts of the months in `clean`. Windows are one month of one pair, behind the last row before it."""
    here = clean.select(MONTH).distinct()
    before = halo(ends, PAIR, MONTH, ["rate_date"]).join(here, MONTH, "left_semi")
    changes = over_segments(clean, before, PAIR, MONTH, ["rate_date"], lambda window: {"previous_day_rate": F.lag("rate").over(window)})
    changes = change_columns(changes, "rate")
    return changes.join(countries, F.col("target_currency") == F.col("code"), "left").select(*silver.FACT_COLUMNS)
