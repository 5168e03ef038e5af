"""Substring dedup on a compacted De Bruijn graph of word windows.

A window of `WINDOW` words is an edge of the graph, between its first and last `WINDOW - 1` words. Only edges that
occur in more than one document matter, and an edge's representative is its occurrence in the smallest doc_id.

1. Most edges are unique, and sending them all is what would cost. A minimizer of the edge, the smallest hash of
   `SEED` consecutive words in it, is shared by all its copies, so an edge whose minimizer occurs in one document
   only is dropped before any edge is sent. This loses nothing.
2. The edges left are grouped by a 128-bit key and joined back to their occurrences, a fraction of the key space at a time.
3. Consecutive edges of a document whose representatives are consecutive too lie on one nonbranching
   path: at a branch the representative jumps. Runs compact to spans with source coordinates, and a span
   is accepted only if every edge of it stands at the matching place of one source document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ratestrata.llm.common import U64, Workspace, grams, raw_texts, signed, slices, texts_of, words_of

WINDOW = 13
SEED = 4
#: Parts of the key space joined one after the other, so that shuffles of one part at a time are on disk.
PARTS = 4
_MOST = U64(0xFFFFFFFFFFFFFFFF)


def _sliding(values: np.ndarray, width: int, best) -> np.ndarray:
    """Minimum or maximum of each run of `width` values, in a logarithmic number of passes."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = best(out[: len(out) - step], out[step:])
        have += step
    return out


def _minimizers(words, hashes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of seeds, the smallest seed of each window, and which windows lie within one text."""
    seeds = grams(hashes, SEED)
    starts = len(hashes) - window + 1
    if starts <= 0:
        return seeds, np.zeros(0, np.uint64), np.zeros(0, bool)
    whole = words.text[:starts] == words.text[window - 1 :]
    return seeds, _sliding(seeds, window - SEED + 1, np.minimum), whole


def _seeds(window: int):
    """Rows `(seed, doc_id)` of the minimizers of a text, each once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words = words_of(raw_texts(batch), lower=False)
            seeds, least, whole = _minimizers(words, words.hashes(), window)
            doc = batch.column("doc_id").to_numpy(zero_copy_only=False)
            chosen = np.flatnonzero(whole)
            chosen = chosen[np.concatenate([[True], (least[chosen][1:] != least[chosen][:-1]) | np.diff(words.text[chosen]).astype(bool)])] if len(chosen) else chosen
            yield pa.record_batch(
                [pa.array(signed(least[chosen])), pa.array(doc[words.text[chosen]].astype(np.int64))], names=["seed", "doc_id"]
            )

    return run


def _edges(window: int):
    """Rows `(key_1, key_2, doc_id, position)` of the windows whose minimizer is in the document's list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words = words_of(raw_texts(batch), lower=False)
            hashes = words.hashes()
            seeds, least, whole = _minimizers(words, hashes, window)
            doc = batch.column("doc_id").to_numpy(zero_copy_only=False)
            lists = batch.column("seeds")
            wanted = np.zeros(len(least), bool)
            for i, (a, b) in enumerate(zip(words.first[:-1].tolist(), words.first[1:].tolist())):
                listed = lists[i].values.to_numpy(zero_copy_only=False).view(np.uint64)
                wanted[a : max(a, b - window + 1)] = np.isin(least[a : max(a, b - window + 1)], listed)
            chosen = np.flatnonzero(wanted & whole)
            first = grams(hashes, window)[chosen]
            second = grams(words.hashes(1), window)[chosen]
            yield pa.record_batch([
                pa.array(signed(first)), pa.array(signed(second)), pa.array(doc[words.text[chosen]].astype(np.int64)),
                pa.array((chosen - words.first[words.text[chosen]]).astype(np.int32)),
            ], names=["key_1", "key_2", "doc_id", "position"])

    return run


def _runs(window: int):
    """Rows sorted by document and position become spans of words, one for each nonbranching path."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            doc, at, source, source_at = (
                batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "position", "source", "source_position")
            )
            breaks = np.concatenate([[True], (np.diff(doc) != 0) | (np.diff(source) != 0) | (np.diff(at) != 1) | (np.diff(source_at) != 1)])
            first = np.flatnonzero(breaks)
            last = np.concatenate([first[1:], [len(doc)]]) - 1
            yield pa.record_batch([
                pa.array(doc[first]), pa.array(at[first]), pa.array((at[last] - at[first] + window).astype(np.int32)),
                pa.array(source[first]), pa.array(source_at[first]),
            ], names=["doc_id", "start", "length", "source", "source_start"])

    return run


def repeated_spans(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Spans of words that also stand in a document of a smaller doc_id.

    `doc_id, start, length, source, source_start`: positions count words from 0. Every window of a span occurs
    in `source`, at the matching place. Spans of one document may touch or overlap; together they cover
    exactly the words of windows that also start in a smaller doc_id. Rows without a doc_id take no part;
    rows that repeat a doc_id are one document.
    """
    work = Workspace(docs.sparkSession, "long-repeats")
    docs = texts_of(docs).where("doc_id is not null")
    seeds = docs.mapInArrow(_seeds(window), "seed long, doc_id long")
    shared = seeds.groupBy("seed").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high")
    # Stored, so that the joins shuffle both sides anew: a join on top of an aggregate's own shuffle cannot split a hot key.
    shared = work.store(shared.select("seed"), "shared-seeds")
    listed = work.store(seeds.join(shared, "seed").groupBy("doc_id").agg(F.collect_set("seed").alias("seeds")), "seeds")
    work.drop("shared-seeds")
    edges = docs.join(listed, "doc_id").select("doc_id", "text", "seeds").mapInArrow(
        _edges(window), "key_1 long, key_2 long, doc_id long, position int"
    )
    edges = work.store(edges.withColumn("part", F.pmod("key_2", F.lit(PARTS)).cast("int")), "edges", partition_by="part")
    work.drop("seeds")

    repeats = None
    for part in range(PARTS):
        own = edges.where(F.col("part") == part).drop("part")
        first = own.groupBy("key_1", "key_2").agg(
            F.min("doc_id").alias("source"), F.max("doc_id").alias("high"), F.min_by("position", "doc_id").alias("source_position")
        ).where("source < high").drop("high")
        first = work.store(first, f"first-{part}")
        found = work.store(
            own.join(first, ["key_1", "key_2"]).where("doc_id > source").select("doc_id", "position", "source", "source_position"),
            f"repeats-{part}",
        )
        work.drop(f"first-{part}")
        repeats = found if repeats is None else repeats.unionByName(found)
    work.drop("edges")
    spans = repeats.repartition("doc_id").sortWithinPartitions("doc_id", "position").mapInArrow(
        _runs(window), "doc_id long, start int, length int, source long, source_start int"
    )
    return work.store(spans, "spans")


def _with_spans(docs: DataFrame, window: int) -> DataFrame:
    spans = repeated_spans(docs, window).groupBy(F.col("doc_id").alias("__doc")).agg(F.collect_list(F.struct("start", "length")).alias("__spans"))
    return docs.join(spans, F.col("doc_id").cast("long") == F.col("__doc"), "left").drop("__doc")


def _masks(batch: pa.RecordBatch):
    """The words of a slice, and for each text the mask of those that stay, or None if all do."""
    words = words_of(raw_texts(batch), lower=False)
    masks = []
    for i, spans in enumerate(batch.column("__spans").to_pylist()):
        keep = np.ones(int(words.first[i + 1] - words.first[i]), bool) if spans else None
        for span in spans or ():
            keep[span["start"] : span["start"] + span["length"]] = False
        masks.append(keep)
    return words, masks


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        words, masks = _masks(batch)
        yield pa.record_batch([
            batch.column("doc_id"), pa.array(np.diff(words.first).astype(np.int64)),
            pa.array([0 if keep is None else int(len(keep) - keep.sum()) for keep in masks], pa.int64()),
            pa.array([hashlib.sha256(b" ".join(words.raw(i, keep))).hexdigest() for i, keep in enumerate(masks)], pa.string()),
        ], names=["doc_id", "n_words", "n_removed", "kept_sha256"])


def removal_digests(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """What `without_repeats` does to each row: `doc_id, n_words, n_removed, kept_sha256` (kept words joined by one space)."""
    docs = _with_spans(texts_of(docs), window)
    return docs.mapInArrow(_digests, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def without_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """`docs`, all columns, with repeated words gone from `text` and `n_chars` (where present) counted anew.

    Words are runs of anything but ASCII white space. Every word covered by a window of `window` words that also starts
    in a document of a smaller doc_id goes; windows are judged on the input. Texts that lose nothing stay as they are,
    others become their kept words joined by single spaces, which may be none. Null and empty texts and rows without a doc_id
    stay; rows that repeat a doc_id are one document and are cut alike where their texts are alike.
    """
    names = docs.columns
    texts_of(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words, masks = _masks(batch)
            old = batch.column("text").to_pylist()
            new = [old[i] if keep is None else b" ".join(words.raw(i, keep)).decode() for i, keep in enumerate(masks)]
            columns = [pa.array(new, pa.string()) if name == "text" else batch.column(name) for name in names]
            yield pa.record_batch(columns, names=names)

    cut = _with_spans(docs, window).mapInArrow(run, docs.schema)
    if "n_chars" in names:
        cut = cut.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return cut


def op4_long_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removal_digests(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP4_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT doc_id, unnest(range(1, len(w) - 11)) AS i, unnest(list_transform(range(1, len(w) - 11), lambda j: list_aggregate(w[j:j + 12], 'string_agg', ' '))) AS t
  FROM words WHERE len(w) >= 13
), first AS (
  SELECT t, min(doc_id) AS source FROM windows GROUP BY t HAVING min(doc_id) < max(doc_id)
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM windows JOIN first USING (t) WHERE doc_id > source
), gone_lists AS (
  SELECT doc_id, list(i) AS g FROM gone GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(g), 0) AS BIGINT) AS n_removed,
  sha256(coalesce(list_aggregate(list_transform(list_filter(range(1, len(w) + 1), lambda i: g IS NULL OR NOT list_contains(g, i)), lambda i: w[i]), 'string_agg', ' '), '')) AS kept_sha256
FROM words LEFT JOIN gone_lists USING (doc_id)
"""
