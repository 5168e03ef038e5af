"""Data checks as rules; their outcome is a table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ratestrata.functions.tiers import VOLATILITY_TIERS


class CheckFailure(Exception):
    """At least one rule has failing rows."""


@dataclass(frozen=True)
class Rule:
    model: str
    column: str
    check: str  # not_null, unique or accepted_values
    values: tuple[str, ...] = ()
    where: str | None = None
    with_columns: tuple[str, ...] = ()  # further columns of a unique key


# The checks of the gold tables.
GOLD_RULES = [
    Rule("agg_currency_summary", "target_currency", "not_null"),
    Rule("agg_currency_summary", "target_currency", "unique"),
    Rule("agg_currency_summary", "latest_rate", "not_null"),
    Rule("agg_currency_summary", "rate_date", "not_null"),
    Rule(
        "agg_currency_summary", "volatility_tier", "accepted_values", tuple(VOLATILITY_TIERS),
        "volatility_tier is not null",
    ),
    Rule("agg_rates_by_region", "rate_date", "not_null"),
    Rule("agg_rates_by_region", "region", "not_null"),
    Rule("agg_rates_by_region", "avg_rate", "not_null"),
    Rule("agg_country_currency_map", "cca2", "not_null"),
    Rule("agg_country_currency_map", "cca2", "unique"),
    Rule("agg_country_currency_map", "name_common", "not_null"),
]

# The checks that the documents show for the country dimension.
DIM_RULES = [
    Rule("dim_countries", "cca2", "not_null"),
    Rule("dim_countries", "cca2", "unique"),
    Rule(
        "dim_countries", "region", "accepted_values",
        ("Africa", "Americas", "Antarctic", "Asia", "Europe", "Oceania"),
    ),
]

# With several base currencies the summary is unique per pair, not per target.
PAIR_RULE = Rule("agg_currency_summary", "base_currency", "unique", with_columns=("target_currency",))


def _where(rule_where: str | None) -> Column:
    return F.lit(True) if rule_where is None else F.expr(rule_where)


def not_null(df: DataFrame, col: str) -> DataFrame:
    """The rows without a value."""
    return df.filter(F.col(col).isNull())


def unique(df: DataFrame, *cols: str) -> DataFrame:
    """Values that occur more than once, and how often. NULL is no value."""
    return df.na.drop("any", subset=list(cols)).groupBy(*cols).agg(F.count("*").alias("n")).filter("n > 1")


def accepted_values(df: DataFrame, col: str, values: Sequence[str], where: str | None = None) -> DataFrame:
    """Values outside the list, and how often they occur. NULL is neither in nor out."""
    outside = df.filter(_where(where)).filter(~F.col(col).isin(list(values)))
    return outside.groupBy(col).agg(F.count("*").alias("n"))


def _counted_in_place(rule: Rule) -> Column:
    """Failures as an aggregate of the whole table."""
    col = F.col(rule.column)
    if rule.check == "not_null":
        return F.count_if(_where(rule.where) & col.isNull())
    return F.count_distinct(F.when(_where(rule.where) & ~col.isin(list(rule.values)), col))


def _outcome(rule: Rule, failures: Column) -> Column:
    return F.struct(
        F.lit(rule.model).alias("model"),
        F.lit(", ".join([rule.column, *rule.with_columns])).alias("column"),
        F.lit(rule.check).alias("check"),
        failures.cast("bigint").alias("failures"),
    )


def run_checks(tables: Mapping[str, DataFrame], rules: Sequence[Rule] = tuple(GOLD_RULES)) -> DataFrame:
    """One row per rule. All rules of a table that are plain aggregates share one scan of it;
    only uniqueness groups by its column."""
    parts = []
    for model in dict.fromkeys(rule.model for rule in rules):
        table = tables[model]
        own = [rule for rule in rules if rule.model == model]
        plain = [rule for rule in own if rule.check != "unique"]
        if plain:
            counts = table.agg(*[_counted_in_place(rule).alias(f"c{i}") for i, rule in enumerate(plain)])
            outcomes = F.array(*[_outcome(rule, F.col(f"c{i}")) for i, rule in enumerate(plain)])
            parts.append(counts.select(F.inline(outcomes)))
        for rule in own:
            if rule.check == "unique":
                rows = table if rule.where is None else table.filter(F.expr(rule.where))
                repeated = unique(rows, rule.column, *rule.with_columns).agg(F.count("*").alias("c"))
                parts.append(repeated.select(F.inline(F.array(_outcome(rule, F.col("c"))))))
    return reduce(DataFrame.unionByName, parts).withColumn("passed", F.col("failures") == 0)


def require_passed(results: DataFrame) -> None:
    """Raise if a rule failed. The table has one row per rule, so its failures fit the message."""
    failed = results.filter(~F.col("passed")).collect()
    if failed:
        listed = "; ".join(f"{r['model']}.{r['column']} {r['check']}: {r['failures']}" for r in failed)
        raise CheckFailure(f"{len(failed)} checks failed: {listed}")
