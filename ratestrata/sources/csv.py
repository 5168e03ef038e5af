"""CSV files as all-text tables."""

from __future__ import annotations

import csv
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from ratestrata.operators.cleaning import (
    any_value_rule, cast_columns, drop_empty_rows, normalize_columns, null_tokens, trim_strings,
)
from ratestrata.sources.base import ExtractionError, Source

# The delimiters to choose from, and the sample to choose on.
DELIMITERS = ",;\t|"
SAMPLE_CHARACTERS = 4096

BROKEN = "_broken_line"
UTF8, LATIN1 = "UTF-8", "ISO-8859-1"


def sniff_delimiter(sample: str) -> str:
    try:
        return csv.Sniffer().sniff(sample[:SAMPLE_CHARACTERS], delimiters=DELIMITERS).delimiter
    except csv.Error:
        return ","


def _quotes() -> Column:
    """Quotes of a line, counted in bytes: a line of Latin-1 has no characters yet."""
    return F.octet_length("value") - F.octet_length(F.replace("value", F.lit('"'), F.lit("")))


def _file_flags(lines: DataFrame) -> DataFrame:
    """Files that need more than a plain read, with the reason.

    A file with a byte sequence that is no UTF-8 is Latin-1 as a whole. A file in which
    a line holds an odd number of quotes has a quoted line break.
    """
    return (
        lines.select(
            F.col("_metadata.file_path").alias("_file"),
            (~F.is_valid_utf8("value")).alias("latin"),
            (_quotes() % 2 == 1).alias("broken"),
        )
        .filter(F.col("latin") | F.col("broken"))
        .groupBy("_file")
        .agg(F.bool_or("latin").alias("latin"), F.bool_or("broken").alias("broken"))
    )


def _cells(line: Column, delimiter: str) -> Column:
    """Cells of a line: its delimiters outside quotes, and one."""
    unquoted = F.regexp_replace(line, '"[^"]*"', "")
    return (F.length(unquoted) - F.length(F.replace(unquoted, F.lit(delimiter), F.lit("")))) / len(delimiter) + 1


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of each split with their number in it, whether an odd number of quotes stands before them in it, and in them."""
    at, n, parity = None, 0, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        odd = pc.count_substring(batch.column("line"), b'"').to_numpy(zero_copy_only=False).astype(np.int64) % 2
        places = list(zip(batch.column("file").to_pylist(), batch.column("split").to_pylist()))
        number, before = np.empty(len(odd), np.int64), np.empty(len(odd), np.int64)
        edges = [0, *(i for i in range(1, len(odd)) if places[i] != places[i - 1]), len(odd)]
        for a, b in zip(edges, edges[1:]):
            if places[a] != at:
                at, n, parity = places[a], 0, 0
            sums = parity + np.cumsum(odd[a:b])
            number[a:b], before[a:b] = n + np.arange(b - a), (sums - odd[a:b]) % 2
            n, parity = n + b - a, int(sums[-1]) % 2
        yield pa.record_batch(
            [*(batch.column(c) for c in ("line", "file", "split")), pa.array(number), pa.array(before), pa.array(odd)],
            names=["line", "file", "split", "n", "before", "odd"],
        )


def _records(lines: DataFrame) -> DataFrame:
    """Records of CSV files whose quoted cells hold line breaks: `record, file, first`, from splits that are read in parallel.

    Whether a line begins inside a quoted cell is a prefix scan of the parity of quotes: over the splits of a file, which are few, then over the lines
    of each split where they are read. Most lines are records. The others, parts of longer ones, are put together by the line
    that opens theirs: in the same split, or the last one of an earlier split.
    """
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split")]
    splits = lines.select(*place, _quotes().alias("quotes")).groupBy("file", "split").agg(F.sum("quotes").alias("quotes"))
    unclosed = splits.groupBy("file").agg(F.sum("quotes").alias("quotes")).filter("quotes % 2 = 1").first()
    if unclosed:
        raise ExtractionError(f"CSV file has a quote that is never closed: {unclosed['file']}")
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    opened = splits.select("file", "split", F.coalesce(F.sum("quotes").over(earlier) % 2, F.lit(0)).alias("opened"))
    numbered = lines.select(F.col("value").cast("binary").alias("line"), *place).mapInArrow(
        _numbered, "line binary, file string, split long, n long, before long, odd long"
    )
    told = numbered.join(opened, ["file", "split"]).withColumn("inside", (F.col("before") + F.col("opened")) % 2)
    parts = told.filter("inside = 1 or odd = 1").select("file", "split", "n", "line", F.expr("if(inside = 0, n, null)").alias("opens"))
    so_far = Window.partitionBy("file", "split").orderBy("n").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parts = parts.withColumn("start", F.last("opens", ignorenulls=True).over(so_far))
    last = parts.groupBy("file", "split").agg(F.max("opens").alias("last"))
    carried = last.select(
        "file", "split", F.last(F.expr("if(last is null, null, struct(split, last))"), ignorenulls=True).over(earlier).alias("carried")
    )
    # splits without such parts carry nothing and need nothing
    parts = parts.join(carried, ["file", "split"]).select(
        "file", F.when(F.col("start").isNull(), F.col("carried.split")).otherwise(F.col("split")).alias("from_split"),
        F.coalesce("start", "carried.last").alias("from"), F.struct("split", "n", "line").alias("part"),
    )
    longer = parts.groupBy("file", "from_split", "from").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("part")), lambda part: part.line.cast("string")), "\n").alias("record")
    ).select(F.col("record").cast("binary").alias("record"), "file", (F.expr("from_split = 0 and from = 0")).alias("first"))
    whole = told.filter("inside = 0 and odd = 0").select(
        F.col("line").alias("record"), "file", F.expr("split = 0 and n = 0").alias("first")
    )
    return whole.unionByName(longer)


def _parsed(records: DataFrame, flags: DataFrame, header: list[str], delimiter: str, encoding: str | None) -> DataFrame:
    """Cells of records, those of Latin-1 files decoded as such, and the record itself where it is broken. Headers, which must be alike, go."""
    if encoding is None:
        latin = flags.filter("latin").select(F.col("_file").alias("file"), F.lit(LATIN1).alias("charset"))
        records = records.join(latin, "file", "left")
        text = F.when(F.col("charset").isNull(), F.col("record").cast("string")).otherwise(F.decode("record", LATIN1))
    else:
        text = F.decode("record", encoding)
    schema = ", ".join(f"`{name}` string" for name in (*header, BROKEN))
    options = {"sep": delimiter, "quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN}
    cells = records.select("first", text.alias("text")).filter("trim(text) != ''").select("first", F.from_csv("text", schema, options).alias("cells"))
    same = F.array(*(F.col(f"cells.`{name}`") for name in header)) == F.array(*map(F.lit, header))
    failure = F.raise_error(F.lit(f"CSV files have other headers than {header}")).cast("boolean")
    return cells.filter(F.when(~F.col("first"), True).when(same, False).otherwise(failure)).select("cells.*")


def _utf8_name(name: str) -> str:
    """A header read as Latin-1, as the UTF-8 text it is if it is that."""
    try:
        return name.encode("latin-1").decode("utf-8")
    except UnicodeError:
        return name


def _checked(rows: DataFrame, header: list[str], delimiter: str) -> DataFrame:
    """The rows; the job fails on a line with too many cells."""
    # Only lines that the reader found broken are looked at again. The first cell is part of the condition because a
    # reader that is asked for nothing but broken lines refuses.
    too_long = F.col(BROKEN).isNotNull() & (_cells(F.col(BROKEN), delimiter) > len(header))
    failure = F.raise_error(F.concat(F.lit("CSV line has too many cells: "), F.col(BROKEN))).cast("boolean")
    return rows.filter(F.when(too_long, failure).otherwise(F.length(F.coalesce(F.col(f"`{header[0]}`"), F.lit(""))) >= 0))


def read_csv(
    spark: SparkSession,
    path: str,
    delimiter: str | None = None,
    encoding: str | None = None,
    multiline: bool | None = None,
) -> DataFrame:
    """All-text table of one CSV file, a folder or a glob whose files share a header.

    The delimiter comes from the first lines. What `encoding` and `multiline` do not name, one distributed pass over the
    lines finds. Files with quoted line breaks are read in splits like others, and their records put together (a break
    inside a cell is a line feed then); with `multiline=True` every file is read whole, by one task. Where some files are Latin-1, all are read so, which loses no byte, and the cells of the others are decoded by
    their file's entry in a small table: no list of files is held on the driver.

    Short lines are filled up with NULL; a line with too many cells fails the job. An empty file is an error.
    """
    try:
        lines = spark.read.text(path)
    except AnalysisException as problem:
        raise ExtractionError(f"CSV file not found: {path}") from problem
    # A line holds its break at least, so the sample needs no more lines than characters.
    head = lines.select(F.substring("value", 1, SAMPLE_CHARACTERS)).limit(SAMPLE_CHARACTERS).collect()
    if not any(row[0] for row in head):
        raise ExtractionError(f"CSV file is empty: {path}")
    if delimiter is None:
        delimiter = sniff_delimiter("\n".join(row[0] for row in head) + "\n")
    flags, mixed, found = None, False, None
    if encoding is None or multiline is None:
        flags = _file_flags(lines)
        found = flags.agg(F.bool_or("latin").alias("latin"), F.bool_or("broken").alias("broken")).first()
        mixed = encoding is None and bool(found["latin"])
    joined = multiline is None and bool(found["broken"])
    options = {
        "header": True, "sep": delimiter, "encoding": encoding or (LATIN1 if mixed else UTF8), "quote": '"', "escape": '"',
        "multiLine": bool(multiline) or joined, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN,
        # Lines are judged by all their cells, also where a caller reads some columns or none.
        "columnPruning": False,
    }
    header = spark.read.options(**options).csv(path).columns
    schema = T.StructType([T.StructField(name, T.StringType()) for name in (*header, BROKEN)])
    if joined:
        names = [_utf8_name(name) if mixed else name for name in header]
        rows = _checked(_parsed(_records(lines), flags, names, delimiter, encoding), names, delimiter)
        return rows.drop(BROKEN)
    rows = spark.read.schema(schema).options(enforceSchema=False, **options).csv(path)
    rows = _checked(rows, header, delimiter)
    if not mixed:
        return rows.drop(BROKEN)
    latin = flags.filter("latin").select("_file", F.lit(True).alias("_latin"))
    told = rows.drop(BROKEN).withColumn("_file", F.col("_metadata.file_path")).join(latin, "_file", "left")

    def cell(name: str) -> Column:
        raw = F.col(f"`{name}`")
        return F.when(F.col("_latin"), raw).otherwise(F.decode(F.encode(raw, LATIN1), UTF8)).alias(_utf8_name(name))

    return told.select(*map(cell, header))


class CsvSource(Source):
    """A cleaned CSV: snake-case headers, missing tokens as NULL, no empty rows, stripped
    cells, and the columns named in `types` cast."""

    def __init__(
        self,
        name: str,
        path: str,
        column_mapping: Mapping[str, str] | None = None,
        types: Mapping[str, str] | None = None,
        delimiter: str | None = None,
        encoding: str | None = None,
        multiline: bool | None = None,
    ) -> None:
        super().__init__(name)
        self.path = str(path)
        self.column_mapping = column_mapping
        self.types = types or {}
        self.delimiter = delimiter
        self.encoding = encoding
        self.multiline = multiline

    def read(self, spark: SparkSession) -> DataFrame:
        raw = normalize_columns(
            read_csv(spark, self.path, self.delimiter, self.encoding, self.multiline), self.column_mapping
        )
        return cast_columns(trim_strings(drop_empty_rows(null_tokens(raw))), self.types)

    def rule(self, df: DataFrame) -> Column:
        return any_value_rule(df)
