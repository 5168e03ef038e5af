"""What every source shares: its name, its reading, its rule and its lineage columns."""

from __future__ import annotations

from abc import ABC, abstractmethod
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


class ExtractionError(Exception):
    """A source is missing, unreadable or not of the agreed form."""


def as_timestamp(moment: datetime | str | Column) -> Column:
    if isinstance(moment, Column):
        return moment
    if isinstance(moment, datetime) and moment.tzinfo is None:
        moment = moment.replace(tzinfo=timezone.utc)
    return F.lit(moment).cast("timestamp")


def with_lineage(
    df: DataFrame, source: str, run_id: str | None, extracted_at: datetime | str | Column
) -> DataFrame:
    """Add the source, the extraction time (one per batch) and the run."""
    return df.withColumns(
        {
            "_source": F.lit(source),
            "_extracted_at": as_timestamp(extracted_at),
            "_pipeline_run_id": F.lit(run_id).cast("string"),
        }
    )


class Source(ABC):
    """Subclass it for a new source: implement `read`, and override `rule` to reject rows."""

    def __init__(self, name: str) -> None:
        self.name = name

    @abstractmethod
    def read(self, spark: SparkSession) -> DataFrame:
        """Flat records, without lineage."""

    def rule(self, df: DataFrame) -> Column:
        return F.lit(True)

    def extract(
        self, spark: SparkSession, run_id: str | None, extracted_at: datetime | str | Column
    ) -> DataFrame:
        """Records with lineage. Anything that fails while planning names the source."""
        try:
            records = self.read(spark)
        except Exception as problem:
            raise ExtractionError(f"source '{self.name}': {problem}") from problem
        return with_lineage(records, self.name, run_id, extracted_at)

    def __repr__(self) -> str:
        return f"{type(self).__name__}(name={self.name!r})"
