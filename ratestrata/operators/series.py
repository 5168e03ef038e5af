"""Keyed time series: newest row, change, trailing statistics, moving average."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F

RANK = "_recency_rank"
HASH = "_key_hash"


def as_date(day: date | str | Column) -> Column:
    return day if isinstance(day, Column) else F.lit(day).cast("date")


def dedup_latest(
    df: DataFrame,
    keys: Sequence[str],
    order_by: str,
    tie_breakers: Sequence[str] | None = None,
) -> DataFrame:
    """The newest row of each key. A NULL `order_by` counts as newest.

    Ties fall to the largest tie-breakers, by default all other columns in turn, so the
    result does not depend on the order of arrival. Spark limits each key inside the
    map tasks already (`WindowGroupLimit ... Partial`): however many copies one key
    has, a map task sends a single row of it into the shuffle.

    Rows are sorted by a hash of the key first: a number that differs from key to key, where the first bytes of text
    keys seldom do, decides nearly all comparisons without a look at the rows.
    """
    rest = [name for name in df.columns if name not in (*keys, order_by)]
    ties = rest if tie_breakers is None else list(tie_breakers)
    newest = Window.partitionBy(HASH, *keys).orderBy(
        F.desc_nulls_first(order_by), *[F.desc_nulls_last(name) for name in ties]
    )
    hashed = df.withColumn(HASH, F.xxhash64(*keys))
    return hashed.withColumn(RANK, F.row_number().over(newest)).filter(F.col(RANK) == 1).drop(RANK, HASH)


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order: str, tie_breakers: Sequence[str] | None = None
) -> DataFrame:
    """Most recent row of each series."""
    return dedup_latest(df, keys, order, tie_breakers)


def plausible(df: DataFrame, col: str, lo: float = 0, hi: float = 1_000_000) -> DataFrame:
    """Rows with `lo < col < hi`. Filter before `daily_change`, so that a bad row is nobody's previous one."""
    return df.filter((F.col(col) > lo) & (F.col(col) < hi))


def daily_change(df: DataFrame, keys: Sequence[str], order: str, value: str) -> DataFrame:
    """Add `inverse_rate`, `previous_day_rate` and `rate_change_pct`.

    Expects one row per key and day, as `dedup_latest` leaves it: a series then holds at
    most one row per calendar day, so even the series that owns most of the raw rows is
    a small window.
    """
    series = Window.partitionBy(*keys).orderBy(order)
    return change_columns(df.withColumn("previous_day_rate", F.lag(value).over(series)), value)


def change_columns(df: DataFrame, value: str) -> DataFrame:
    """Add `inverse_rate` and `rate_change_pct` to rows that know their `previous_day_rate`."""
    rate, previous = F.col(value), F.col("previous_day_rate")
    return (
        df.withColumn("inverse_rate", F.round(F.lit(1).cast("decimal(2,1)") / F.nullif(rate, F.lit(0)), 8))
        .withColumn(
            "rate_change_pct",
            F.when(previous != 0, F.round((rate - previous) / previous * 100, 4)),
        )
    )


def trailing_stats(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    as_of: date | str | Column,
    days: int = 30,
    order: str = "rate_date",
) -> DataFrame:
    """Sample deviation, mean, bounds and count since `as_of - days`, that day included.

    Later days than `as_of` count too. The partial aggregation leaves one row per key and map task.
    """
    recent = df.filter(F.col(order) >= F.date_sub(as_date(as_of), days))
    return recent.groupBy(*keys).agg(
        F.stddev_samp(value).alias("rate_stddev_30d"),
        F.avg(value).alias("rate_avg_30d"),
        F.min(value).alias("rate_min_30d"),
        F.max(value).alias("rate_max_30d"),
        F.count("*").alias("days_of_data"),
    )


def moving_avg(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    n: int = 7,
    name: str = "rate_7d_moving_avg",
) -> DataFrame:
    """Mean of the last `n` rows of the series (rows, not days); shorter at its start.

    Like `daily_change` it is for series of days, whose length the calendar bounds.
    """
    frame = Window.partitionBy(*keys).orderBy(*order).rowsBetween(1 - n, Window.currentRow)
    return df.withColumn(name, F.avg(value).over(frame))
