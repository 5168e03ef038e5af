"""Silver: the country dimension and the rate facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ratestrata.functions.text import blank_to_null
from ratestrata.functions.tiers import population_tier
from ratestrata.operators.containment import top_container
from ratestrata.operators.series import daily_change, dedup_latest, plausible

PAIR = ["base_currency", "target_currency"]

# Column order of the two tables.
DIM_COLUMNS = [
    "cca2", "cca3", "name_common", "name_official", "region", "subregion", "capital", "population",
    "area_km2", "population_tier", "population_density", "currencies", "languages",
    "has_multiple_currencies", "is_un_member", "timezones", "flag_emoji", "source_system",
    "extracted_at", "pipeline_run_id",
]
FACT_COLUMNS = [
    "base_currency", "target_currency", "rate", "rate_date", "inverse_rate", "previous_day_rate",
    "rate_change_pct", "unix_timestamp", "source_system", "extracted_at", "pipeline_run_id",
    "currency_region", "primary_country_name",
]


def dim_countries(staged: DataFrame) -> DataFrame:
    """One row per country, the newest extraction, with derived bands."""
    newest = dedup_latest(staged, ["cca2"], "extracted_at")
    texts = ["name_common", "name_official", "region", "subregion", "capital"]
    people, area = F.col("population"), F.col("area_km2")
    return newest.withColumns(
        {
            **{name: blank_to_null(F.col(name)) for name in texts},
            "population_tier": population_tier(people),
            "population_density": F.when(area > 0, F.round(people.cast("decimal(20,0)") / area, 2)),
            "has_multiple_currencies": F.coalesce(F.contains("currencies", F.lit(",")), F.lit(False)),
        }
    ).select(*DIM_COLUMNS)


def fct_rates(
    staged: DataFrame,
    dim: DataFrame,
    lo: float = 0,
    hi: float = 1_000_000,
    match: str = "substring",
    code_lengths: Sequence[int] | None = None,
    unique_by: Sequence[str] | None = None,
    codes: DataFrame | None = None,
) -> DataFrame:
    """One row per pair and day: newest, plausible, with its change and the region and name of
    the most populous country that lists the target currency.

    Two shuffles of the facts: by (pair, day), after the map side has dropped repeated
    extractions, and by pair for the change. Hashing by pair once would serve both, but
    would bring all repeated extractions of a dominant pair into one task. `codes` may name
    a smaller frame that holds the target currencies; with `code_lengths` none is read.
    """
    # The day first: sorting compares the key with the most values before the others.
    newest = dedup_latest(staged, ["rate_date", *reversed(PAIR)], "extracted_at")
    changes = daily_change(plausible(newest, "rate", lo, hi), PAIR, "rate_date", "rate")
    return top_container(
        changes,
        dim,
        "target_currency",
        "currencies",
        "population",
        {"region": "currency_region", "name_common": "primary_country_name"},
        match,
        code_lengths,
        unique_by,
        codes=staged if codes is None and code_lengths is None else codes,
    ).select(*FACT_COLUMNS)
