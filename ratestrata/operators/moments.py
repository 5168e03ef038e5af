"""Summaries that merge: count, mean, squared deviations and bounds per series and day, or per any coarser range.

A trailing statistic is a merge of some days, so the rows themselves are read once, when their day is summarised.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from ratestrata.operators.series import as_date

MOMENTS = ["n", "mean", "squares", "low", "high"]


def daily_moments(df: DataFrame, keys: Sequence[str], value: str, day: str = "rate_date") -> DataFrame:
    """`n`, `mean`, `squares` (of deviations from the mean), `low` and `high` of the values of each series and day. Null values don't count."""
    number = F.col(value).cast("double")
    return df.filter(F.col(value).isNotNull()).groupBy(*keys, day).agg(
        F.count("*").alias("n"),
        F.avg(number).alias("mean"),
        (F.var_pop(number) * F.count("*")).alias("squares"),
        F.min(value).alias("low"),
        F.max(value).alias("high"),
    )


def _merged(all_: Column, part: Column) -> Column:
    """Moments of two disjoint sets of rows together (Chan, Golub and LeVeque 1979): no large sums of squares cancel."""
    n = all_["n"] + part["n"]
    step = part["mean"] - all_["mean"]
    return F.struct(
        n.alias("n"),
        (all_["mean"] + step * part["n"] / n).alias("mean"),
        (all_["squares"] + part["squares"] + step * step * all_["n"] * part["n"] / n).alias("squares"),
    )


def merge_moments(moments: DataFrame, keys: Sequence[str], day: str = "rate_date") -> DataFrame:
    """The moments of each series over all its days here, merged in the order of the days."""
    part = F.struct(day, F.col("n").cast("double").alias("n"), "mean", "squares")
    none = F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("squares"))
    merged = moments.groupBy(*keys).agg(
        F.sort_array(F.collect_list(part)).alias("parts"), F.min("low").alias("low"), F.max("high").alias("high")
    ).withColumn("all", F.aggregate("parts", none, _merged))
    return merged.select(*keys, F.col("all.n").cast("bigint").alias("n"), "all.mean", "all.squares", "low", "high")


def deviation(n: Column, squares: Column) -> Column:
    """Sample standard deviation; NULL of a single value."""
    return F.when(n > 1, F.sqrt(squares / (n - 1)))


def trailing_from_moments(
    moments: DataFrame, keys: Sequence[str], as_of: date | str | Column, days: int = 30, day: str = "rate_date"
) -> DataFrame:
    """What `trailing_stats` makes of the rows, made of their daily moments: `as_of - days` on, that day included."""
    recent = moments.filter(F.col(day) >= F.date_sub(as_date(as_of), days))
    return merge_moments(recent, keys, day).select(
        *keys,
        deviation(F.col("n"), F.col("squares")).alias("rate_stddev_30d"),
        F.col("mean").alias("rate_avg_30d"),
        F.col("low").alias("rate_min_30d"),
        F.col("high").alias("rate_max_30d"),
        F.col("n").alias("days_of_data"),
    )
