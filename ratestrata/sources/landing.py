"""Landed tables: text columns, lineage, and an upsert that publishes whole versions.

A table is a folder of immutable parts and a pointer to the live ones:

    data/version=7/folder=2024-01/   rows that batch 7 wrote for one partition
    live/7/                          which version of each partition is live, as of batch 7

A batch writes the partitions it touches as a new version, then a new pointer. The pointer counts once Spark has marked it
complete, so readers see the table before the batch or after it, whatever happens in between.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ratestrata.functions.text import double_text, empty_to_null
from ratestrata.operators.upsert import counted_per_key, has_null
from ratestrata.schemas import LINEAGE
from ratestrata.sources.base import as_timestamp

# Folders of rows without a partition value, and of tables without partitions.
NO_VALUE, WHOLE = "none", "all"
# A pointer also holds, for each stream, the last of its batches that was landed: a row with `batch`, whose folder names the stream.
LIVE = "folder string, version bigint, batch bigint"
STREAM = "stream of "


@dataclass(frozen=True)
class PartitionBy:
    """Folders of a landed table: the first `length` characters of the text column `key`."""

    key: str
    length: int

    def value(self) -> Column:
        return F.coalesce(empty_to_null(F.substring(self.key, 1, self.length)), F.lit(NO_VALUE))


# A batch rewrites the partitions it touches. Months keep the files of a small feed few; take
# days once a day fills files of its own.
RATE_MONTH = PartitionBy("rate_date", 7)
RATE_DAY = PartitionBy("rate_date", 10)


def to_landing(df: DataFrame, columns: Sequence[str], loaded_at: datetime | str | Column) -> DataFrame:
    """Exactly `columns` as text, then lineage and `_loaded_at`. Missing columns are NULL,
    further ones are dropped, and NULL stays NULL."""
    kinds = {field.name: field.dataType for field in df.schema}

    def text(name: str) -> Column:
        if name not in kinds:
            return F.lit(None).cast("string")
        if isinstance(kinds[name], T.DoubleType):
            return double_text(F.col(name))
        return F.col(name).cast("string")

    typed = {"_source": "string", "_extracted_at": "timestamp", "_pipeline_run_id": "string"}
    lineage = [
        (F.col(name) if name in kinds else F.lit(None)).cast(typed[name]).alias(name) for name in LINEAGE
    ]
    fields = [text(name).alias(name) for name in columns if name not in LINEAGE]
    return df.select(*fields, *lineage, as_timestamp(loaded_at).alias("_loaded_at"))


def _file_system(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def _remove(spark: SparkSession, path: str) -> None:
    files, place = _file_system(spark, path)
    files.delete(place, True)


def _numbers(spark: SparkSession, path: str, prefix: str = "", marker: str = "") -> list[int]:
    """Numbered folders below `path` that hold the marker."""
    files, place = _file_system(spark, path)
    if not files.exists(place):
        return []
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    names = [status.getPath().getName() for status in files.listStatus(place)]
    found = [name for name in names if name.startswith(prefix) and name[len(prefix):].isdigit()]
    return sorted(
        int(name[len(prefix):]) for name in found if not marker or files.exists(hadoop.Path(f"{path}/{name}/{marker}"))
    )


def current_version(spark: SparkSession, path: str) -> int | None:
    """The last version whose pointer is complete."""
    return max(_numbers(spark, f"{path}/live", marker="_SUCCESS"), default=None)


def _live(spark: SparkSession, path: str, version: int) -> DataFrame:
    # The comparison holds for every row; it tells the optimizer that pruning by this side is worthwhile.
    return spark.read.schema(LIVE).parquet(f"{path}/live/{version}").filter("version > 0")


def landed_folders(spark: SparkSession, path: str) -> DataFrame | None:
    """The live version of every partition, or None if nothing was landed."""
    version = current_version(spark, path.rstrip("/"))
    return None if version is None else _live(spark, path.rstrip("/"), version).filter("batch is null").drop("batch")


def landed_batch(spark: SparkSession, path: str, stream: str) -> int | None:
    """The last batch of a stream that was landed, or None."""
    version = current_version(spark, path.rstrip("/"))
    if version is None:
        return None
    found = _live(spark, path.rstrip("/"), version).filter(F.col("folder") == STREAM + stream).first()
    return found and found["batch"]


def read_landing(
    spark: SparkSession, path: str, schema: T.StructType, touched: DataFrame | None = None
) -> DataFrame:
    """The landed table; with `touched(folder)`, the partitions named there only.

    Scans are pruned at run time by the pointer. A table that was never landed is empty.
    """
    path = path.rstrip("/")
    version = current_version(spark, path)
    if version is None:
        return spark.createDataFrame([], schema)
    live = _live(spark, path, version).filter("batch is null")
    if touched is not None:
        live = live.join(touched, "folder", "left_semi")
    wider = T.StructType([*schema.fields, T.StructField("version", T.LongType()), T.StructField("folder", T.StringType())])
    rows = spark.read.schema(wider).option("basePath", f"{path}/data").parquet(f"{path}/data")
    return rows.join(live, ["version", "folder"], "left_semi").select(*schema.fieldNames())


class Landed(NamedTuple):
    """Rows a batch held, and rows of it that were written: one per key."""

    extracted: int
    loaded: int


def _publish(
    spark: SparkSession, path: str, before: int | None, number: int, touched: DataFrame, batch: tuple[str, int] | None
) -> None:
    """The pointer of a version: the one before, with the touched partitions moved to the new version, and the stream to its batch."""
    live = touched.select("folder", F.lit(number).cast("bigint").alias("version"), F.lit(None).cast("bigint").alias("batch"))
    if batch is not None:
        live = live.unionByName(spark.createDataFrame([(STREAM + batch[0], number, batch[1])], LIVE))
    if before is not None:
        moved = live.select("folder")
        live = _live(spark, path, before).join(moved, "folder", "left_anti").unionByName(live)
    live.coalesce(1).write.mode("overwrite").parquet(f"{path}/live/{number}")


def _tidy(spark: SparkSession, path: str, version: int) -> None:
    """Remove versions that neither the pointer nor the one before it, which readers may still hold, refers to."""
    pointers = _numbers(spark, f"{path}/live")
    held = pointers[-2:]
    used = {row[0] for number in held for row in _live(spark, path, number).filter("batch is null").select("version").distinct().collect()}
    for number in pointers[:-2]:
        _remove(spark, f"{path}/live/{number}")
    for number in _numbers(spark, f"{path}/data", "version="):
        if number not in used and number <= version:
            _remove(spark, f"{path}/data/version={number}")


def land(
    spark: SparkSession,
    path: str,
    updates: DataFrame,
    keys: Sequence[str],
    schema: T.StructType,
    partition: PartitionBy | None = None,
    order_by: str = "_extracted_at",
    batch: tuple[str, int] | None = None,
) -> Landed:
    """Upsert `updates` into the table at `path`. One writer at a time.

    `batch` names the stream that they come from and their number in it. The pointer remembers the last number of every
    stream, so a batch that comes again, after a failure behind its landing, is skipped whole, rows with a NULL in the key included.

    The batch is reduced to its last row of each key, with the number of rows that stood for it, and stored: the
    source is read once, both counts come from stored files (an accumulator would count rerun tasks twice), and a
    key that most of the batch has is one row from each map task on. With `partition`, of one of the keys, only the partitions that the
    batch touches are read and written. A driver that dies at any step leaves the table as it was; the
    next call writes over what it left.
    """
    path = path.rstrip("/")
    if partition is not None and partition.key not in keys:
        raise ValueError("the partition must derive from a key, or a key could sit in two partitions")
    before = current_version(spark, path)
    number = (before or 0) + 1
    if batch is not None:
        last = landed_batch(spark, path, batch[0])
        if last is not None and batch[1] <= last:
            return Landed(0, 0)
    _remove(spark, f"{path}/incoming")
    incoming = f"{path}/incoming/{uuid.uuid4().hex}"
    counted_per_key(updates.select(*schema.fieldNames()), keys, order_by).write.parquet(incoming)
    stored = spark.read.schema(T.StructType([*schema.fields, T.StructField("_copies", T.LongType())])).parquet(incoming)
    counts = stored.agg(F.sum("_copies"), F.count("*")).first()
    if not counts[1]:
        _remove(spark, f"{path}/incoming")
        return Landed(0, 0)

    folder = F.lit(WHOLE) if partition is None else partition.value()
    fresh = stored.drop("_copies").withColumn("folder", folder)
    # Compared for the same reason as versions above; no folder is empty text.
    touched = fresh.select("folder").distinct().filter("length(folder) > 0")
    merged = fresh
    if before is not None:
        keyed = fresh.filter(~has_null(keys)).select(*keys)
        kept = read_landing(spark, path, schema, touched).join(keyed, list(keys), "left_anti").select(*schema.fieldNames())
        merged = kept.withColumn("folder", folder).unionByName(fresh)
    # A folder that gets most rows is split among many tasks, and small ones share one.
    merged.hint("rebalance", F.col("folder")).write.mode("overwrite").partitionBy("folder").parquet(f"{path}/data/version={number}")
    _publish(spark, path, before, number, touched, batch)
    _remove(spark, f"{path}/incoming")
    _tidy(spark, path, number)
    return Landed(*counts)
