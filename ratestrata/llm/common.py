"""What the operators share: intermediate tables, Arrow slices, vectorised words and their hashes."""

from __future__ import annotations

import gc
import os
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ratestrata.session import shared_folder

U64 = np.uint64
#: Bytes of text worked on at a time inside a task.
SLICE_BYTES = 4 << 20
#: Bytes hashed at a time: the prefix sums and powers of so many stay in a worker.
HASH_BYTES = 500_000

SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True  # words are [^\x20\x09-\x0D]+
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32  # A-Z only


class Workspace:
    """Intermediate tables of one run, in a new folder below `spark.checkpoint.dir`.

    A stored table cuts the lineage: executors lost later cost no more than the tasks that were
    running, and the shuffles that led to it can go.
    """

    def __init__(self, spark: SparkSession, purpose: str) -> None:
        self.spark, self.root = spark, shared_folder(spark, purpose)

    def store(self, df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
        path, schema = f"{self.root}/{name}", df.schema
        writer = df.write.option("compression", "zstd")
        if partition_by:
            writer = writer.partitionBy(partition_by)
        writer.parquet(path)
        del df, writer
        self.release()
        return self.spark.read.schema(schema).parquet(path)

    def drop(self, name: str) -> None:
        """Delete a table that nothing reads any more."""
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

    def release(self) -> None:
        """Shuffle files go when the driver collects the plans that made them: long before it would by itself."""
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()


def let_workers_import(spark: SparkSession) -> None:
    """Python workers look for this package where the driver found it, besides their own path."""
    root, environment = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, root])


def texts_of(docs: DataFrame, *more: Column) -> DataFrame:
    """`doc_id` as long and `text`; other columns, whatever their names, stay out of the way."""
    let_workers_import(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *more)


def with_fields(df: DataFrame, **kinds: str) -> T.StructType:
    """The schema of `df` and further columns; the frame's own schema stays as it is."""
    return T.StructType([*df.schema.fields, *T.StructType.fromDDL(", ".join(f"{n} {k}" for n, k in kinds.items())).fields])


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut so that a slice holds about `most` bytes of text, or one text that is longer."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        i = 0
        while i < batch.num_rows:
            j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + most, "right")))
            yield batch.slice(i, j - i)
            i = j


def raw_texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """UTF-8 bytes of a text column; null counts as empty."""
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a finaliser of two multiplications)."""
    x = x ^ (x >> U64(32))
    x *= U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(29)
    x *= U64(0xBF58476D1CE4E5B9)
    return x ^ (x >> U64(32))


class Lane:
    """Hashes of substrings of a buffer: differences of prefix sums of (value of byte) * base^position."""

    def __init__(self, seed: int, base: int) -> None:
        self.values = np.random.default_rng(seed).integers(0, 1 << 64, 256, dtype=np.uint64)
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.powers = self.inverses = np.ones(1, np.uint64)

    def grow(self, n: int) -> None:
        if len(self.powers) < n:
            n = 1 << (n - 1).bit_length()
            for name, base in (("powers", self.base), ("inverses", self.inverse)):
                steps = np.full(n, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))

    def of(self, buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        out = np.empty(len(starts), np.uint64)
        i = 0
        while i < len(starts):  # pieces, so that the prefix sums stay small for any length of text
            j = max(i + 1, int(np.searchsorted(ends, starts[i] + HASH_BYTES, "right")))
            first, last = int(starts[i]), int(ends[j - 1])
            self.grow(last - first + 1)
            sums = np.zeros(last - first + 1, np.uint64)
            np.cumsum(self.values[buffer[first:last]] * self.powers[: last - first], out=sums[1:])
            s, e = starts[i:j] - first, ends[i:j] - first
            out[i:j] = (sums[e] - sums[s]) * self.inverses[s]
            i = j
        return mixed(out)


LANES = (Lane(1, 0x9E3779B97F4A7C15), Lane(2, 0xC2B2AE3D27D4EB4F))


@dataclass
class Words:
    """The words of several texts, in order: byte ranges in `buffer`, owning text, and first word of each text."""

    buffer: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    text: np.ndarray
    first: np.ndarray  # one more entry than texts

    def hashes(self, lane: int = 0) -> np.ndarray:
        return LANES[lane].of(self.buffer, self.starts, self.ends)

    def raw(self, text: int, keep: np.ndarray | None = None) -> list[bytes]:
        """Words of a text as bytes, or those that the mask keeps."""
        a, b = self.first[text], self.first[text + 1]
        data = self.buffer.data
        s, e = self.starts[a:b], self.ends[a:b]
        if keep is not None:
            s, e = s[keep], e[keep]
        return [bytes(data[x:y]) for x, y in zip(s.tolist(), e.tolist())]


def words_of(texts: list[bytes], lower: bool, breaks: np.ndarray = SPACES) -> Words:
    """Maximal runs of bytes that are no `breaks` (which hold the line feed)."""
    buffer = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    if lower:
        buffer = LOWER[buffer]
    is_break = np.ones(len(buffer) + 2, bool)
    is_break[1:-1] = breaks[buffer]
    edges = np.flatnonzero(is_break[1:] != is_break[:-1])
    starts, ends = edges[::2], edges[1::2]
    text_ends = np.cumsum([len(t) + 1 for t in texts], dtype=np.int64) if texts else np.zeros(0, np.int64)
    first = np.searchsorted(starts, np.concatenate([[0], text_ends]))
    text = np.repeat(np.arange(len(texts)), np.diff(first))
    return Words(buffer, starts, ends, text, first)


def grams(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of `width` consecutive word hashes; runs that cross texts are the caller's to drop."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(width):
        out *= U64(0x9E3779B97F4A7C15)
        out += hashes[j : j + n]
        out ^= out >> U64(31)
    return mixed(out)


def signed(x: np.ndarray) -> np.ndarray:
    """Bits of a 64-bit hash as Spark's long."""
    return x.view(np.int64)


class _Codes(dict):
    """Numbers of units, given to new ones as they are asked for."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, unit: str) -> int:
        code = self[unit] = len(self)
        self.new.append(unit)
        return code


class Remembered:
    """Ids of units, such as words, encoded once for each Python worker; a worker forgets when there are `most`."""

    def __init__(self, encode, most: int = 300_000, encode_all=None) -> None:
        """`encode` gives the ids of a unit, or `encode_all` those of many, one after the other, and how many each has."""
        self.encode_unit, self.most, self.encode_all = encode, most, encode_all
        self.forget()

    def forget(self) -> None:
        self.codes = _Codes()
        self.lengths, self.flat, self.arrays = array("q"), array("I"), None

    def encode(self, split: list[list[str]]) -> list[np.ndarray]:
        """Ids of each text, given as its units."""
        if len(self.codes) > self.most:
            self.forget()
        sizes = np.fromiter(map(len, split), np.int64, len(split))
        codes = np.fromiter(map(self.codes.__getitem__, chain.from_iterable(split)), np.int64, sizes.sum())
        new, self.codes.new = self.codes.new, []
        if new and self.encode_all:
            flat, lengths = self.encode_all(new)
            self.lengths.frombytes(lengths.astype(np.int64).tobytes())
            self.flat.frombytes(flat.astype(np.uint32).tobytes())
        else:
            for unit in new:
                ids = self.encode_unit(unit)
                self.lengths.append(len(ids))
                self.flat.extend(ids)
        if new or self.arrays is None:
            lengths = np.array(self.lengths, np.int64)
            self.arrays = lengths, np.cumsum(lengths) - lengths, np.array(self.flat, np.uint32)
        lengths, offsets, flat = self.arrays
        n = lengths[codes]
        ends = np.cumsum(n)
        ids = flat[np.arange(int(n.sum())) + np.repeat(offsets[codes] - ends + n, n)]
        cuts = np.append(0, ends)[np.cumsum(sizes)]
        return np.split(ids, cuts[:-1]) if len(split) else []


def binary_array(rows: list[bytes]) -> pa.Array:
    return pa.array(rows, pa.binary())
