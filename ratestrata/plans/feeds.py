"""What the report panels show, as DataFrames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ratestrata.functions.tiers import VOLATILITY_TIERS
from ratestrata.operators.series import as_date


def _figures(df: DataFrame, **values: Column) -> DataFrame:
    """One row per figure, from one aggregate of `df`."""
    rows = [F.struct(F.lit(name).alias("kpi"), F.col(name).alias("value")) for name in values]
    return df.agg(*[value.cast("double").alias(name) for name, value in values.items()]).select(F.inline(F.array(*rows)))


def kpis(
    summary: DataFrame,
    dim: DataFrame,
    fct: DataFrame,
    runs: DataFrame,
    landed: Sequence[DataFrame],
    checks: DataFrame,
    as_of: date | str | Column,
    code: str = "EUR",
    days: int = 30,
    runs_as_of: date | str | Column | None = None,
) -> DataFrame:
    """The headline figures, one row each: one aggregate for each input, so nothing is scanned twice or joined.

    Pass stored tables. `runs_as_of` is for audit logs of other days than the rates.
    """
    since = F.date_sub(as_date(as_of), days)
    own = fct.filter((F.col("target_currency") == code) & (F.col("rate_date") >= since))
    recent_runs = runs.filter(F.to_date("started_at") >= F.date_sub(as_date(as_of if runs_as_of is None else runs_as_of), days))
    rows = reduce(DataFrame.union, [table.select(F.lit(1).alias("one")) for table in landed])
    return reduce(
        DataFrame.union,
        [
            _figures(summary, currencies_tracked=F.count_distinct("target_currency")),
            _figures(dim, countries_mapped=F.count("*")),
            _figures(
                own,
                avg_inverse_rate=F.round(F.avg("inverse_rate"), 4),
                latest_change_pct=F.round(F.max(F.struct("rate_date", "rate_change_pct"))["rate_change_pct"], 2),
            ),
            _figures(
                recent_runs,
                runs=F.count("*"),
                run_success_pct=F.round(F.count_if(F.col("status") == "success") * 100 / F.nullif(F.count("*"), F.lit(0)), 2),
            ),
            _figures(rows, landed_rows=F.count("*")),
            _figures(checks, checks_passed=F.count_if("passed"), checks_total=F.count("*")),
        ],
    )


def trend(
    region_rates: DataFrame,
    codes: Sequence[str],
    as_of: date | str | Column,
    days: int = 30,
    base: str | None = None,
    scale: Mapping[str, float] | None = None,
) -> DataFrame:
    """Moving-average series of the chosen codes over the `days` days up to `as_of`, a column
    each. `scale` divides a code that is of another magnitude."""
    day = F.col("rate_date")
    wanted = region_rates.filter(
        F.col("target_currency").isin(list(codes)) & (day > F.date_sub(as_date(as_of), days)) & (day <= as_date(as_of))
    )
    if base is not None:
        wanted = wanted.filter(F.col("base_currency") == base)
    series = wanted.groupBy("rate_date").pivot("target_currency", list(codes)).agg(F.max("rate_7d_moving_avg"))
    return series.select(
        "rate_date",
        *[
            (F.col(f"`{code}`") / F.lit(scale[code]) if code in (scale or {}) else F.col(f"`{code}`")).alias(code)
            for code in codes
        ],
    )


def currencies_by_region(dim: DataFrame) -> DataFrame:
    """Distinct listed currencies, and countries, per region."""
    listed = dim.select("region", "cca2", F.explode_outer(F.split("currencies", ", ")).alias("code"))
    return listed.groupBy("region").agg(
        F.count_distinct("code").alias("currency_count"), F.count_distinct("cca2").alias("country_count")
    )


def volatility_distribution(summary: DataFrame) -> DataFrame:
    """Currencies per tier, also for tiers that none has."""
    tier = F.col("volatility_tier")
    counts = summary.agg(*[F.count_if(tier == name).alias(name) for name in VOLATILITY_TIERS])
    rows = [
        F.struct(F.lit(name).alias("volatility_tier"), F.col(name).alias("currencies")) for name in VOLATILITY_TIERS
    ]
    return counts.select(F.inline(F.array(*rows)))


def rates_table(summary: DataFrame, search: str | None = None) -> DataFrame:
    """The table panel. `search` finds a text in code, country or region, in any case."""
    change = F.col("day_over_day_change_pct")
    rows = summary
    if search:
        needle = F.lit(search.lower())
        found = [
            F.coalesce(F.contains(F.lower(F.col(name)), needle), F.lit(False))
            for name in ("target_currency", "primary_country_name", "region")
        ]
        rows = rows.filter(reduce(lambda a, b: a | b, found))
    return rows.select(
        "base_currency",
        "target_currency",
        "primary_country_name",
        F.round("latest_rate", 4).alias("rate"),
        F.round("inverse_rate", 4).alias("inverse"),
        F.when(change >= 0, F.lit("up")).when(change < 0, F.lit("down")).alias("direction"),
        F.round(F.abs(change), 2).alias("change_pct"),
        F.round("rate_avg_30d", 4).alias("avg_30d"),
        "volatility_tier",
        "region",
    )
