"""Tables that change together: one pointer names the live folders of all of them.

    data/table=silver.fct/version=7/folder=2024-01/   what batch 7 wrote
    live/7/                                           the live version of every folder of every table, as of batch 7

A batch writes whole tables, or the folders of a table that it touches, as a new version. Readers see nothing of it until its
pointer is complete, and then all of it. A driver that dies before leaves all tables as they were.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ratestrata.sources.landing import NO_VALUE, WHOLE, _file_system, _numbers, _remove, current_version

ENTRY = "table string, folder string, version bigint, schema string"
#: The folder of an entry that only says that a table exists, and what its columns are.
NONE = ""


def _alike(one: T.StructType, other: T.StructType | None) -> bool:
    """Same names and types; what may be NULL can differ."""
    return other is None or [(f.name, f.dataType) for f in one] == [(f.name, f.dataType) for f in other]


class Entry(NamedTuple):
    table: str
    folder: str
    version: int
    schema: str


class Tables:
    """The pointer is a list of folders, as long as the calendar or the batches make it: it is read once and kept on the driver."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def version(self) -> int | None:
        return current_version(self.spark, self.root)

    def entries(self, version: int | None = None) -> list[Entry]:
        number = self.version() if version is None else version
        if number is None:
            return []
        return [Entry(*row) for row in self.spark.read.schema(ENTRY).parquet(f"{self.root}/live/{number}").collect()]

    def schema(self, table: str, entries: list[Entry] | None = None) -> T.StructType | None:
        """Columns of a table, or None if it was never published."""
        found = [e for e in (self.entries() if entries is None else entries) if e.table == table]
        return T.StructType.fromJson(json.loads(max(found, key=lambda e: e.version).schema)) if found else None

    def read(self, table: str, folder_as: str | None = None) -> DataFrame:
        """The published rows of a table; no other folders are read. `folder_as` names a column for the folder."""
        return self.rows(table, self.entries(), folder_as)

    def rows(self, table: str, entries: list[Entry], folder_as: str | None = None) -> DataFrame:
        schema = self.schema(table, entries)
        if schema is None:
            raise LookupError(f"table '{table}' was never published")
        wider = T.StructType([*schema.fields, T.StructField("version", T.LongType()), T.StructField("folder", T.StringType())])
        path = f"{self.root}/data/table={table}"
        live = [(e.version, e.folder) for e in entries if e.table == table and e.folder != NONE]
        if not live:
            rows = self.spark.createDataFrame([], wider)
        else:
            # the files of versions that are not live, which may go meanwhile, are not listed
            versions = sorted({version for version, _ in live})
            rows = self.spark.read.schema(wider).option("basePath", path).parquet(*(f"{path}/version={number}" for number in versions))
            # Folders are chosen while planning: a join with the list would send all rows into as many tasks as there are folders.
            places = [f"{number}/{folder}" for number, folder in live]
            rows = rows.filter(F.concat(F.col("version").cast("string"), F.lit("/"), F.col("folder")).isin(places))
        return rows.select(*schema.fieldNames(), *([F.col("folder").alias(folder_as)] if folder_as else []))

    def begin(self) -> Batch:
        return Batch(self)


class Batch:
    """Tables of the next version. One batch at a time."""

    def __init__(self, tables: Tables) -> None:
        self.tables, self.spark, self.root = tables, tables.spark, tables.root
        before = tables.version()
        self.before = [] if before is None else tables.entries(before)
        self.number = (before or 0) + 1
        self.written: dict[str, tuple[list[Entry], list[str] | None]] = {}

    def write(
        self,
        table: str,
        df: DataFrame,
        folder: Column | None = None,
        touched: Sequence[str] | None = None,
        sort: Sequence[str] = (),
        folder_as: str | None = None,
    ) -> DataFrame:
        """Write a table, or with `touched` those of its folders, and return the table as it will be.

        A folder that gets most rows is split among many tasks, and small ones share one. Rows without a folder lie in one
        of their own. A touched folder without rows goes.
        """
        schema, path = df.schema, f"{self.root}/data/table={table}/version={self.number}"
        if touched is not None and not _alike(schema, self.tables.schema(table, self.before)):
            raise ValueError(f"columns of '{table}' changed: write the whole table")
        rows = df.withColumn("folder", F.lit(WHOLE) if folder is None else F.coalesce(folder, F.lit(NO_VALUE)))
        if folder is not None:
            rows = rows.hint("rebalance", F.col("folder"))
        if sort:
            rows = rows.sortWithinPartitions("folder", *sort)
        rows.write.mode("overwrite").partitionBy("folder").parquet(path)
        entries = [Entry(table, name, self.number, schema.json()) for name in [*self._folders(path), NONE]]
        self.written[table] = entries, None if touched is None else list(touched)
        return self.read(table, folder_as)

    def _folders(self, path: str) -> list[str]:
        files, place = _file_system(self.spark, path)
        unescape = self.spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
        names = [status.getPath().getName() for status in files.listStatus(place)]
        return [unescape(name.removeprefix("folder=")) for name in names if name.startswith("folder=")]

    def read(self, table: str, folder_as: str | None = None) -> DataFrame:
        """A table as it will be, written by this batch or not."""
        return self.tables.rows(table, self._entries([table] if table in self.written else []), folder_as)

    def _entries(self, names: Iterable[str]) -> list[Entry]:
        """The pointer as it will be when the tables of these names change."""
        live = self.before
        for name in names:
            entries, touched = self.written[name]
            gone = None if touched is None else {*touched, NONE}
            live = [e for e in live if e.table != name or (gone is not None and e.folder not in gone)] + entries
        return live

    def publish(self, only: Sequence[str] | None = None) -> None:
        """Switch to what was written, all tables at once, or those of `only`."""
        live = self.spark.createDataFrame(self._entries(self.written if only is None else only), ENTRY)
        live.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/live/{self.number}")
        self._tidy()

    def _tidy(self) -> None:
        """Remove versions that neither this pointer nor the one before it, which readers may still hold, refers to."""
        pointers = _numbers(self.spark, f"{self.root}/live")
        used = {(e.table, e.version) for number in pointers[-2:] for e in self.tables.entries(number)}
        for number in pointers[:-2]:
            _remove(self.spark, f"{self.root}/live/{number}")
        for table in {table for table, _ in used} | set(self.written):
            for number in _numbers(self.spark, f"{self.root}/data/table={table}", "version="):
                if (table, number) not in used and number <= self.number:
                    _remove(self.spark, f"{self.root}/data/table={table}/version={number}")
