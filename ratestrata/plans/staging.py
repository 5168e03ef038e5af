"""Landed text to typed columns. Lazy: the same role as a view over the landing tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ratestrata.functions.text import empty_to_null, truth


def _lineage() -> list[Column]:
    return [
        F.col("_source").alias("source_system"),
        F.col("_extracted_at").cast("timestamp").alias("extracted_at"),
        F.col("_pipeline_run_id").alias("pipeline_run_id"),
    ]


def stage_rates(raw: DataFrame) -> DataFrame:
    """Typed rates; rows without target, rate or day are dropped. Text that is no number or day fails the job."""
    present = F.col("target_currency").isNotNull() & F.col("rate").isNotNull() & F.col("rate_date").isNotNull()
    source, extracted_at, run_id = _lineage()
    return raw.filter(present).select(
        "base_currency",
        "target_currency",
        F.col("rate").cast("decimal(20,8)").alias("rate"),
        F.col("rate_date").cast("date").alias("rate_date"),
        F.col("timestamp").cast("bigint").alias("unix_timestamp"),
        source,
        extracted_at,
        run_id,
    )


def stage_countries(raw: DataFrame) -> DataFrame:
    """Typed countries; rows without a two-letter code are dropped."""
    return raw.filter(F.col("cca2").isNotNull() & (F.col("cca2") != "")).select(
        "cca2",
        "cca3",
        "name_common",
        "name_official",
        "region",
        "subregion",
        "capital",
        empty_to_null(F.col("population")).cast("bigint").alias("population"),
        empty_to_null(F.col("area_km2")).cast("decimal(15,4)").alias("area_km2"),
        "currencies",
        "languages",
        "timezones",
        truth(F.col("is_un_member")).alias("is_un_member"),
        "flag_emoji",
        *_lineage(),
    )
