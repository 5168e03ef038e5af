"""Uniqueness of new rows only: an index of the keys seen so far, against which a batch is checked.

The index is a table of segments, one for each batch, of the batch's distinct keys and how often it has them. A batch reads the index, two or three
narrow columns, and its own rows; the rows of earlier batches are never read again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ratestrata.sources.published import Tables

INDEX = "keys"


def key_counts(rows: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct keys and how often they occur. A key with a NULL is none. Map tasks send each of their keys once."""
    return rows.na.drop("any", subset=list(cols)).groupBy(*cols).agg(F.count("*").alias("n"))


def repeated_after(index: DataFrame, batch: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keys that occur more than once in all rows, and how often: `index(*cols, n)` of the earlier rows and `batch(*cols, n)` of the new ones.

    One aggregate of both: a key is one row of each map task, whatever segments hold it.
    """
    both = index.select(*cols, "n").unionByName(batch.select(*cols, "n"))
    return both.groupBy(*cols).agg(F.sum("n").alias("n")).filter("n > 1")


class KeyIndex:
    """The keys of a table that grows by batches, below `path`."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType) -> None:
        self.tables, self.cols = Tables(spark, path), schema.fieldNames()
        self.spark, self.schema = spark, T.StructType([*schema.fields, T.StructField("n", T.LongType())])

    def read(self) -> DataFrame:
        if self.tables.schema(INDEX) is None:
            return self.spark.createDataFrame([], self.schema)
        return self.tables.read(INDEX)

    def check(self, rows: DataFrame) -> DataFrame:
        """Keys that occur more than once after a batch of `rows`; the index stays as it is."""
        return repeated_after(self.read(), key_counts(rows, self.cols), self.cols)

    def add(self, rows: DataFrame, name: str) -> None:
        """Remember the keys of a batch. A batch of the same name, landed again, takes the place of its segment."""
        batch = self.tables.begin()
        batch.write(INDEX, key_counts(rows, self.cols), F.lit(name), [name])
        batch.publish()
