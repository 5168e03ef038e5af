"""Token counts of documents in flat token files without an index.

A token file is nothing but ids of 16 or 32 bits, each document ended by one identifier. Files are cut into ranges of ids, and every
task reads its ranges by their offset, so a file may have any size. Every range is searched for the identifier by itself, in numpy. What a
range cannot know, how many documents ended before it and where the last one did, is a prefix scan over range
summaries: a scan of groups of ranges, then of the ranges in each group, so that no window holds more than a file's groups.

Spark estimates a stored table by the size of its files, in which a row of the register, path included, takes about 3 bytes, against some 400
in a broadcast: millions of rows would go through the driver. Tables that grow with the documents are therefore joined by sorting.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ratestrata.llm.common import Remembered, Workspace, let_workers_import, slices, texts_of
from ratestrata.llm.packing import _units, byte_units, default_tokenizer

#: Ids of a range, and ranges of a group of the prefix scan.
RANGE, GROUP = 1 << 20, 1 << 10


def _opened(path: str):
    """File system and path of a file that Spark names."""
    from pyarrow import fs

    if path.startswith("/"):
        return fs.LocalFileSystem(), path
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path.removeprefix("file:")
    return fs.FileSystem.from_uri(path)


@lru_cache(maxsize=2)
def plain_units(tokenizer: str) -> Remembered:
    """Ids of units of text, in which the strings of special tokens are ordinary text: no text has the id of one."""
    return Remembered(byte_units(tokenizer).encoding.encode_ordinary, 400_000)


def end_of_text(tokenizer: str) -> int:
    """The id of the end of text, which no text has."""
    return byte_units(tokenizer).encoding.encode("<|endoftext|>", allowed_special="all")[0]


def write_files(docs: DataFrame, tokenizer: str, end: int, folder: str, kind: str = "<u2") -> DataFrame:
    """Writes the token file of every partition of `docs(doc_id, text, ...)` below `folder`, which all executors share.

    A file holds the ids of each document, as numbers of `kind`, followed by `end`, and nothing else. Returned is the register of
    what was written, to be stored at once: `file, ordinal, doc_id`, and for each file a row without ordinal with its `size` in ids. A task that
    runs again writes a file of another name; only those in the register count. Null text counts as empty; rows that repeat a doc_id are
    documents of their own. Fails if a text has the id `end`, or one that `kind` cannot hold.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        path = f"{folder}/part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.bin"
        system, place = _opened(path)
        system.create_dir(place.rsplit("/", 1)[0], recursive=True)
        units, most, stop = plain_units(tokenizer), np.iinfo(np.dtype(kind)).max, np.array([end], kind)
        written, size = 0, 0
        with system.open_output_stream(place) as out:
            for batch in slices(batches):
                parts = []
                for ids in units.encode([_units(t or "") for t in batch.column("text").to_pylist()]):
                    if len(ids) and (int(ids.max()) > most or (ids == end).any()):
                        raise ValueError(f"a text has the id {end} of the end, or one above {most}")
                    parts += [ids.astype(kind), stop]
                flat = np.concatenate(parts)
                out.write(flat.tobytes())
                n, size = batch.num_rows, size + len(flat)
                yield pa.record_batch(
                    [pa.array([path] * n), pa.array(np.arange(written, written + n)), batch.column("doc_id"), pa.nulls(n, pa.int64())],
                    names=["file", "ordinal", "doc_id", "size"],
                )
                written += n
        yield pa.record_batch(
            [pa.array([path]), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.array([size], pa.int64())],
            names=["file", "ordinal", "doc_id", "size"],
        )

    return texts_of(docs).mapInArrow(run, "file string, ordinal long, doc_id long, size long")


def files_below(spark: SparkSession, path: str, kind: str = "<u4") -> DataFrame:
    """`file, size` (in ids) of token files that others wrote. Only names and lengths are read."""
    found = spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), F.col("length"))
    return found.select("file", F.expr(f"length div {np.dtype(kind).itemsize}").alias("size"))


def _searched(end: int, kind: str, width: int):
    """Places of the identifier in ranges of files, each read by its offset."""
    bytes_ = np.dtype(kind).itemsize

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, sizes = [], []
            for file, number, size in zip(*(batch.column(c).to_pylist() for c in ("file", "range", "size"))):
                system, place = _opened(file)
                n = min(width, size - number * width)
                with system.open_input_file(place) as source:
                    ids = np.frombuffer(source.read_at(n * bytes_, number * width * bytes_), kind)
                if len(ids) != n:
                    raise OSError(f"{file} is shorter than {size} ids")
                found.append(np.flatnonzero(ids == end).astype(np.int32))
                sizes.append(n)
            yield pa.record_batch(
                [batch.column("file"), batch.column("range"), pa.array(sizes, pa.int64()), pa.array(found, pa.list_(pa.int32()))],
                names=["file", "range", "size", "ends"],
            )

    return run


def token_counts(files: DataFrame, end: int, kind: str = "<u4", width: int = RANGE) -> DataFrame:
    """`file, ordinal, start, n_tokens` of each document of `files(file, size)`: its place among the file's documents, its first id, its ids
    without the end.

    Documents without ids count 0. Ids after a file's last identifier are a document that was not ended, and are counted as one
    unless there are none. An empty file, and an empty table of files, have no documents.
    """
    spark = files.sparkSession
    let_workers_import(spark)
    work = Workspace(spark, "token-counts")
    ranges = files.where("size > 0").select(
        "file", "size", F.explode(F.expr(f"sequence(0L, (size - 1) div {width})")).alias("range")
    ).repartition("file", "range")
    found = work.store(ranges.mapInArrow(_searched(end, kind, width), "file string, range long, size long, ends array<int>"), "ends")
    summary = found.select(
        "file", "range", F.expr(f"range div {GROUP}").alias("group"), "size", (F.col("range") * width).alias("base"),
        F.size("ends").cast("long").alias("n"), F.expr(f"range * {width} + array_max(ends)").alias("last"),
    )
    groups = summary.groupBy("file", "group").agg(F.sum("n").alias("n"), F.max("last").alias("last"))
    earlier = Window.partitionBy("file").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select(
        "file", "group", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("n_before"), F.max("last").over(earlier).alias("last_before")
    )
    inside = Window.partitionBy("file", "group").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    carried = summary.select(
        "file", "group", "range", "base", F.coalesce(F.sum("n").over(inside), F.lit(0)).alias("n_inside"), F.max("last").over(inside).alias("last_inside")
    ).join(groups, ["file", "group"])
    carried = carried.select(
        "file", "range", "base", (F.col("n_before") + F.col("n_inside")).alias("ordinal"),
        (F.coalesce("last_inside", "last_before", F.lit(-1)) + 1).alias("start"),
    )
    each = found.where(F.size("ends") > 0).select("file", "range", "ends").hint("merge").join(carried, ["file", "range"]).select(
        "file", "ordinal", "start", F.expr("transform(ends, e -> base + e)").alias("at")
    ).select("file", "ordinal", "start", "at", F.posexplode("at").alias("k", "stop")).select(
        "file", (F.col("ordinal") + F.col("k")).alias("ordinal"),
        F.when(F.col("k") == 0, F.col("start")).otherwise(F.expr("get(at, k - 1) + 1")).alias("start"), "stop",
    )
    totals = summary.groupBy("file").agg(F.sum("size").alias("size"), F.sum("n").alias("ordinal"), (F.coalesce(F.max("last"), F.lit(-1)) + 1).alias("start"))
    open_end = totals.where("start < size").select("file", "ordinal", "start", F.col("size").alias("stop"))
    return each.unionByName(open_end).select("file", "ordinal", "start", (F.col("stop") - F.col("start")).alias("n_tokens"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of all documents, from flat files of 16-bit ids written of them, ended by the end of text of the vocabulary."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    tokenizer = default_tokenizer()
    end, work = end_of_text(tokenizer), Workspace(spark, "token-files")
    register = work.store(write_files(docs, tokenizer, end, f"{work.root}/files"), "register")
    files = register.where("ordinal is null").select("file", "size")
    found = token_counts(files, end, "<u2")
    return register.where("ordinal is not null").drop("size").hint("merge").join(found, ["file", "ordinal"]).select(
        "doc_id", "file", "ordinal", "start", "n_tokens"
    )
