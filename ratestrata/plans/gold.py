"""Gold: summary per pair, regional series, and the country map."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from ratestrata.functions.tiers import volatility_tier
from ratestrata.operators.containment import CODE, matching_pieces
from ratestrata.operators.series import as_date, latest_per_key, moving_avg, trailing_stats

PAIR = ["base_currency", "target_currency"]
TIES = ["currency_region", "primary_country_name"]
DAYS = 30

LATEST = {
    "rate": "latest_rate",
    "inverse_rate": "inverse_rate",
    "rate_date": "rate_date",
    "rate_change_pct": "day_over_day_change_pct",
    "currency_region": "region",
    "primary_country_name": "primary_country_name",
}


def _summary_columns(latest: dict[str, Column], run_id: Column) -> list[Column]:
    stddev, average = F.col("rate_stddev_30d"), F.col("rate_avg_30d")
    return [
        *[F.col(name) for name in PAIR],
        *[col.alias(name) for name, col in latest.items()],
        F.round(average, 6).alias("rate_avg_30d"),
        F.round("rate_min_30d", 6).alias("rate_min_30d"),
        F.round("rate_max_30d", 6).alias("rate_max_30d"),
        F.round(stddev, 8).alias("rate_volatility_30d"),
        volatility_tier(stddev, average).alias("volatility_tier"),
        "days_of_data",
        run_id.alias("pipeline_run_id"),
    ]


def currency_summary(fct: DataFrame, as_of: date | str | Column, days: int = DAYS) -> DataFrame:
    """Latest rate per pair with trailing statistics, in one pass and one shuffle.

    The newest row and the statistics are aggregates of the same grouping; every map task
    sends one row per pair. A pair whose base is NULL has a latest rate but no
    statistics, as NULL equals nothing. For facts that are still to be computed; see
    `currency_summary_joined` for stored ones.
    """
    base, target = F.col(PAIR[0]), F.col(PAIR[1])
    recent = (F.col("rate_date") >= F.date_sub(as_date(as_of), days)) & base.isNotNull() & target.isNotNull()
    rate = F.when(recent, F.col("rate"))
    newest = F.struct(F.col("rate_date").isNull().alias("undated"), "rate_date", *TIES, "pipeline_run_id")
    grouped = fct.groupBy(*PAIR).agg(
        F.max_by(F.struct(*LATEST, "pipeline_run_id"), newest).alias("newest"),
        F.stddev_samp(rate).alias("rate_stddev_30d"),
        F.avg(rate).alias("rate_avg_30d"),
        F.min(rate).alias("rate_min_30d"),
        F.max(rate).alias("rate_max_30d"),
        F.nullif(F.count(rate), F.lit(0)).alias("days_of_data"),
    )
    latest = {new: F.col(f"newest.{old}") for old, new in LATEST.items()}
    return grouped.select(*_summary_columns(latest, F.col("newest.pipeline_run_id")))


def currency_summary_joined(
    fct: DataFrame, as_of: date | str | Column, days: int = DAYS, stats: DataFrame | None = None
) -> DataFrame:
    """The same result for stored facts: the newest rows, joined to the statistics.

    It scans twice, but the second scan opens only the row groups of the lookback and a few
    columns, and its aggregate hashes where one with whole rows in it must sort. On a
    million stored facts it took two thirds of the time of the single pass. With `stats`, as
    `trailing_from_moments` makes them, the facts are scanned for the newest rows only.
    """
    latest = latest_per_key(fct, PAIR, "rate_date", [*TIES, "pipeline_run_id"])
    if stats is None:
        stats = trailing_stats(fct, PAIR, "rate", as_of, days)
    columns = {new: F.col(old) for old, new in LATEST.items()}
    return latest.join(stats, PAIR, "left").select(
        *_summary_columns(columns, F.col("pipeline_run_id"))
    )


def country_counts(
    dim: DataFrame, codes: DataFrame, match: str = "substring", code_lengths: Sequence[int] | None = None
) -> DataFrame:
    """Distinct countries per region and listed code."""
    needed = dim.select("cca2", "region", "currencies").filter(F.col("region").isNotNull())
    pieces = matching_pieces(needed, "currencies", codes, "target_currency", match, code_lengths)
    return pieces.groupBy(F.col("region").alias("_region"), CODE).agg(
        F.count_distinct("cca2").alias("_countries")
    )


def regional_daily(
    fct: DataFrame,
    dim: DataFrame,
    as_of: date | str | Column,
    days: int = DAYS,
    match: str = "substring",
    code_lengths: Sequence[int] | None = None,
    codes: DataFrame | None = None,
) -> DataFrame:
    """Statistics per day, pair, region and primary country since `as_of - days`.

    Joining every fact to all countries of its region that list its code would multiply
    rows only to count them. The count is taken per (region, code) beforehand. The
    averages stay the same, since a group repeats the one rate its pair has that day.
    `codes` may name a smaller frame that holds the target currencies.
    """
    recent = fct.filter(F.col("rate_date") >= F.date_sub(as_date(as_of), days))
    counts = country_counts(dim, recent if codes is None else codes, match, code_lengths)
    matched = recent.join(
        counts, (F.col("currency_region") == F.col("_region")) & (F.col("target_currency") == F.col(CODE)), "left"
    )
    return matched.groupBy(
        "rate_date",
        *PAIR,
        F.coalesce("currency_region", F.lit("Unknown")).alias("region"),
        "primary_country_name",
    ).agg(
        F.avg("rate").alias("avg_rate"),
        F.min("rate").alias("min_rate"),
        F.max("rate").alias("max_rate"),
        F.avg("rate_change_pct").alias("avg_rate_change_pct"),
        F.coalesce(F.max("_countries"), F.lit(0)).cast("bigint").alias("country_count"),
    )


def rates_by_region(
    fct: DataFrame,
    dim: DataFrame,
    as_of: date | str | Column,
    days: int = DAYS,
    match: str = "substring",
    code_lengths: Sequence[int] | None = None,
    codes: DataFrame | None = None,
) -> DataFrame:
    """`regional_daily` with the mean of the last seven rows of each pair and region."""
    daily = regional_daily(fct, dim, as_of, days, match, code_lengths, codes)
    # Two primary countries can share a series and a day; the name settles their order.
    series = moving_avg(
        daily, [*PAIR, "region"], ["rate_date", F.asc_nulls_first("primary_country_name")], "avg_rate"
    )
    return series.select(
        "rate_date",
        *PAIR,
        "region",
        "primary_country_name",
        F.round("avg_rate", 6).alias("avg_rate"),
        F.round("min_rate", 6).alias("min_rate"),
        F.round("max_rate", 6).alias("max_rate"),
        F.round("avg_rate_change_pct", 4).alias("avg_rate_change_pct"),
        "country_count",
        F.round("rate_7d_moving_avg", 6).alias("rate_7d_moving_avg"),
    )


def country_currency_map(dim: DataFrame, summary: DataFrame, base: str | None = None) -> DataFrame:
    """Every country with the latest rate of its first listed currency: one row each if the summary has one base,
    or one is named."""
    rates = (summary if base is None else summary.filter(F.col("base_currency") == base)).select(
        F.col("target_currency").alias("_target"),
        "latest_rate",
        F.col("rate_date").alias("latest_rate_date"),
        F.col("day_over_day_change_pct").alias("day_change_pct"),
        "volatility_tier",
    )
    countries = dim.select(
        "cca2", "cca3", "name_common", "region", "subregion", "capital", "population", "population_tier",
        "population_density", "area_km2", "currencies", "is_un_member", "flag_emoji",
        F.split_part("currencies", F.lit(", "), F.lit(1)).alias("primary_currency"),
    )
    return countries.join(rates, F.col("primary_currency") == F.col("_target"), "left").drop("_target")


def in_report_order(df: DataFrame) -> DataFrame:
    """The order in which a gold table is shown. A stored table has none, so sort when reading."""
    names = set(df.columns)
    if "primary_currency" in names:
        return df.orderBy(F.desc_nulls_last("population"))
    if "rate_7d_moving_avg" in names:
        return df.orderBy(F.desc("rate_date"), "target_currency", "region")
    return df.orderBy("target_currency")
