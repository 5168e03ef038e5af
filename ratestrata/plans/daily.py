"""The daily job: ingest both sources, build silver and gold, check, publish."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from ratestrata import schemas
from ratestrata.operators.cleaning import validate
from ratestrata.operators.moments import daily_moments, trailing_from_moments
from ratestrata.plans import gold, increment, quality, silver, staging
from ratestrata.sources import audit
from ratestrata.sources.base import ExtractionError, Source
from ratestrata.sources.landing import (
    NO_VALUE, RATE_MONTH, Landed, PartitionBy, current_version, land, landed_folders, read_landing, to_landing,
)
from ratestrata.sources.published import Batch, Tables

RATE_KEYS = ["base_currency", "target_currency", "rate_date"]
COUNTRY_KEYS = ["cca2"]
PAIR = silver.PAIR
# The length of ISO 4217 codes, for callers who know that all targets are such.
ISO_LENGTHS = (3,)


@dataclass(frozen=True)
class Layers:
    """Where each table lies below one root folder."""

    root: str

    def path(self, layer: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{table}"

    @property
    def runs(self) -> str:
        return self.path("bronze", "pipeline_runs")


def now() -> datetime:
    return datetime.now(timezone.utc)


def ingest(
    spark: SparkSession,
    source: Source,
    layers: Layers,
    table: str,
    fields: Sequence[str],
    keys: Sequence[str],
    run_id: str,
    extracted_at: datetime,
    partition: PartitionBy | None = None,
    validated: bool = False,
    dag_id: str = "ingest",
    loaded_at: datetime | None = None,
) -> Landed:
    """Extract, land and audit one source. A failure is recorded, and raised with the source's name.
    `loaded_at` is the moment of loading, now unless named."""
    schema = schemas.landing_schema(list(fields))
    audit.append_event(audit.run_started(spark, run_id, dag_id, source.name, now()), layers.runs)
    try:
        records = source.extract(spark, run_id, extracted_at)
        if validated:
            records, _ = validate(records, source.rule(records))
        landed = land(
            spark, layers.path("bronze", table), to_landing(records, fields, loaded_at or now()), keys, schema, partition
        )
    except Exception as problem:
        audit.append_event(
            audit.run_finished(
                spark, run_id, dag_id, source.name, "failed", now(), error_message=str(problem)
            ),
            layers.runs,
        )
        if isinstance(problem, ExtractionError):
            raise
        raise ExtractionError(f"source '{source.name}': {problem}") from problem
    audit.append_event(
        audit.run_finished(spark, run_id, dag_id, source.name, "success", now(), *landed), layers.runs
    )
    return landed


def published(spark: SparkSession, layers: Layers) -> Tables:
    """All silver and gold tables, by names such as `gold.agg_currency_summary`."""
    return Tables(spark, layers.root.rstrip("/"))


def read_table(spark: SparkSession, layers: Layers, layer: str, table: str) -> DataFrame:
    """A published table of the silver or gold layer, as of the last run that passed its checks."""
    return published(spark, layers).read(f"{layer}.{table}")


def _facts(
    spark: SparkSession, batch: Batch, tables: Tables, path: str, dim: DataFrame, codes: DataFrame | None,
    code_lengths: Sequence[int] | None, months: list[str] | None,
) -> DataFrame:
    """Write the facts and what is kept beside them: the last row of each pair and month, and daily moments.

    All of them, or those of `months`, which were landed since the last run, and of the months that depend on these.
    """
    month, order = F.col(increment.MONTH), ["rate_date", "target_currency", "base_currency"]
    named = F.coalesce(F.date_format("rate_date", "yyyy-MM"), F.lit(NO_VALUE))
    if months is None:
        rates = staging.stage_rates(read_landing(spark, path, schemas.RAW_RATES))
        new = silver.fct_rates(rates, dim, code_lengths=code_lengths, codes=codes)
        fct = batch.write("silver.fct_exchange_rates", new, named, sort=order, folder_as=increment.MONTH)
        batch.write("silver.pair_months", increment.last_rows(fct), month)
        touched = None
    else:
        countries = batch.read("silver.code_countries")
        before = tables.read("silver.pair_months")
        touched = sorted({*months, *increment.months_of_codes(before, tables.read("silver.code_countries"), countries)})
        ends = batch.write("silver.pair_months", increment.last_rows(increment.clean_rates(spark, path, touched)), month, touched)
        touched = sorted({*touched, *increment.following_months(before, ends, touched)})
        new = increment.facts_of_months(increment.clean_rates(spark, path, touched), ends, countries)
        fct = batch.write("silver.fct_exchange_rates", new, named, touched, order, increment.MONTH)
    fresh = fct if touched is None else fct.filter(month.isin(touched))
    days = daily_moments(fresh, [*PAIR, increment.MONTH], "rate")
    batch.write("silver.daily_moments", days, month, touched, ["rate_date"])
    return fct.drop(increment.MONTH)


def transform(
    spark: SparkSession,
    layers: Layers,
    as_of: date,
    rules: Sequence[quality.Rule] = tuple(quality.GOLD_RULES),
    base: str | None = None,
    code_lengths: Sequence[int] | None = None,
    incremental: bool = False,
) -> DataFrame:
    """Build silver and gold from the landed tables, check them, and publish all of them at once. A failed check raises
    after its outcome is published; the other tables then stay as they were.

    With `incremental`, facts, their last rows and moments are built for the months that were landed since the last published
    run and for those that depend on them; all other months keep their files. The first run, and a landed table that is not partitioned by
    month or day, build everything. Gold and the dimension are small, or a scan of the lookback, and always built whole.

    With `base`, gold holds the rates of that base only: a target and a country are then unique. The lengths
    that targets have are read from the landed rates, one column once, and stored as the distinct targets. A caller who knows
    all lengths can name them as `code_lengths`; targets of other lengths then match no country.
    """
    tables = published(spark, layers)
    batch = tables.begin()
    path = layers.path("bronze", "raw_currencies")
    landed_version = current_version(spark, path)
    months = None
    if incremental and tables.schema("silver.landed") is not None:
        months = increment.months_since(spark, path, tables.read("silver.landed").first()["version"])
    landed = read_landing(spark, path, schemas.RAW_RATES)
    if months is not None:  # targets of the other months are known
        folders = landed_folders(spark, path).filter(F.substring("folder", 1, 7).isin(months)).select("folder")
        landed = read_landing(spark, path, schemas.RAW_RATES, folders).select("target_currency")
        landed = landed.unionByName(tables.read("silver.target_codes"))
    targets = batch.write("silver.target_codes", landed.select("target_currency").filter("target_currency is not null").distinct())
    codes = targets if code_lengths is None else None
    countries = staging.stage_countries(
        read_landing(spark, layers.path("bronze", "raw_countries"), schemas.RAW_COUNTRIES)
    )
    dim = batch.write("silver.dim_countries", silver.dim_countries(countries))
    batch.write("silver.code_countries", increment.code_countries(dim, targets, code_lengths))
    fct = _facts(spark, batch, tables, path, dim, codes, code_lengths, months)
    batch.write("silver.landed", spark.createDataFrame([(landed_version,)], "version bigint"))
    built = {"dim_countries": dim, "fct_exchange_rates": fct}
    moments = batch.read("silver.daily_moments").drop(increment.MONTH)
    if base is not None:
        fct, moments = (df.filter(F.col("base_currency") == base) for df in (fct, moments))

    def store(name: str, df: DataFrame) -> None:
        built[name] = batch.write(f"gold.{name}", df)

    stats = trailing_from_moments(moments, PAIR, as_of)
    store("agg_currency_summary", gold.currency_summary_joined(fct, as_of, stats=stats))
    store("agg_rates_by_region", gold.rates_by_region(fct, dim, as_of, code_lengths=code_lengths, codes=codes))
    store("agg_country_currency_map", gold.country_currency_map(dim, built["agg_currency_summary"]))
    results = batch.write("gold.check_results", quality.run_checks(built, rules))
    if results.filter("not passed").isEmpty():
        batch.publish()
    else:
        batch.publish(["gold.check_results"])
    quality.require_passed(results)
    return results


def run_daily(
    spark: SparkSession,
    rates: Source,
    countries: Source,
    root: str,
    run_id: str,
    as_of: date,
    extracted_at: datetime,
    rules: Sequence[quality.Rule] = tuple(quality.GOLD_RULES),
    validated: bool = False,
    partition: PartitionBy = RATE_MONTH,
    base: str | None = None,
    code_lengths: Sequence[int] | None = None,
    loaded_at: datetime | None = None,
    incremental: bool = False,
) -> DataFrame:
    """The whole run. Repeating it with the same input changes load times and the audit log, and adds rows with a NULL in the
    key again, as they equal nothing."""
    layers = Layers(root)
    ingest(
        spark, rates, layers, "raw_currencies", schemas.RATE_FIELDS, RATE_KEYS, run_id, extracted_at,
        partition, validated, loaded_at=loaded_at,
    )
    ingest(
        spark, countries, layers, "raw_countries", schemas.COUNTRY_FIELDS, COUNTRY_KEYS, run_id, extracted_at,
        None, validated, loaded_at=loaded_at,
    )
    return transform(spark, layers, as_of, rules, base, code_lengths, incremental)
