"""Band rules."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Lower bound of each population band, largest first.
POPULATION_BANDS = [
    (1_000_000_000, "mega"),
    (100_000_000, "large"),
    (10_000_000, "medium"),
    (1_000_000, "small"),
]

# Volatility tiers, and the upper bounds of the first two.
VOLATILITY_TIERS = ["low", "medium", "high"]
LOW_BELOW, MEDIUM_BELOW = 0.01, 0.05


def population_tier(population: Column) -> Column:
    tier = F.lit(None).cast("string")
    tier = F.when(population.isNotNull(), F.lit("micro")).otherwise(tier)
    for bound, name in reversed(POPULATION_BANDS):
        tier = F.when(population >= bound, F.lit(name)).otherwise(tier)
    return tier


def volatility_tier(stddev: Column, average: Column) -> Column:
    """Tier of the relative deviation. With fewer than two observations there is no
    deviation, and the tier is `high`: unknown counts as risky."""
    ratio = stddev / F.nullif(average.cast("double"), F.lit(0.0))
    low, medium, high = VOLATILITY_TIERS
    return F.when(ratio < LOW_BELOW, low).when(ratio < MEDIUM_BELOW, medium).otherwise(high)
