"""Quality rules as a bitmask ledger.

Every rule is measured once per document. The ledger holds the measurements and one bit per failed
rule, so that a policy, a named and versioned set of rules that reject, is a mask, applied without reading texts again.
What each rule of a policy rejects, and what would come back without it, are counts over distinct masks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ratestrata.llm.common import U64, mixed, raw_texts, slices, texts_of, with_fields, words_of

SYMBOLS = b"#*$%&|<>"
MEASURES = [
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper_words", "n_marked_words", "n_longest_repeat",
]

#: Rule name and its failing condition, in integers, over the measurements. Bits number the rules in this order; new
#: rules go to the end, so that older ledgers keep their meaning.
RULES = [
    ("too_few_words", "n_words < 50"),
    ("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    ("short_words", "word_chars < 2 * n_words"),
    ("long_words", "word_chars > 20 * n_words"),
    ("symbols", "100 * n_symbols > 10 * n_words"),
    ("repeated_lines", "n_lines >= 4 and 100 * n_dup_lines > 30 * n_lines"),
    ("shouting", "100 * n_upper_words > 40 * n_words"),
    ("marked_words", "100 * n_marked_words > 30 * n_words"),
    ("one_word_repeated", "100 * n_longest_repeat > 20 * n_words"),
]
BITS = {name: 1 << bit for bit, (name, _) in enumerate(RULES)}


@dataclass(frozen=True)
class Policy:
    """Rules that reject a document; a new version is a new policy, ledgers stay."""

    name: str
    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(BITS[rule] for rule in self.rules)

    def keeps(self, failures: Column | str = "failures") -> Column:
        column = F.col(failures) if isinstance(failures, str) else failures
        return column.bitwiseAND(F.lit(self.mask)) == 0


BASE = Policy("base", 1, ("too_few_words", "repeated_words"))
WEB = Policy("web", 1, tuple(BITS))


def _sums(flags: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of a value per word for each text."""
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[first[1:]] - total[first[:-1]]


def _repeat_words(hashes: np.ndarray, text: np.ndarray, n_texts: int) -> np.ndarray:
    """Words inside windows of three words that occur twice or more in their text."""
    n = len(hashes) - 2
    if n <= 0:
        return np.zeros(n_texts, np.int64)
    whole = np.flatnonzero(text[:n] == text[2:])
    key = mixed((hashes[whole] * U64(3) + mixed(hashes[whole + 1] * U64(5) + mixed(hashes[whole + 2]))) ^ (text[whole].astype(np.uint64) << U64(40)))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    found = whole[order][np.concatenate([same, [False]]) | np.concatenate([[False], same])]
    covered = np.zeros(len(hashes), bool)
    for step in range(3):
        covered[found + step] = True
    return np.bincount(text[covered], minlength=n_texts)


def _longest_runs(hashes: np.ndarray, text: np.ndarray, n_texts: int) -> np.ndarray:
    """Length of the longest run of one word, per text."""
    out = np.zeros(n_texts, np.int64)
    if len(hashes):
        starts = np.flatnonzero(np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])]))
        np.maximum.at(out, text[starts], np.diff(np.concatenate([starts, [len(hashes)]])))
    return out


def _lines(texts: list[bytes]) -> tuple[list[int], list[int]]:
    counts, repeats = [], []
    for text in texts:
        lines = [line for line in text.split(b"\n") if line.strip(b" \t\n\x0b\x0c\r")]
        counts.append(len(lines))
        repeats.append(len(lines) - len(set(lines)))
    return counts, repeats


_IS_SYMBOL = np.isin(np.arange(256), list(SYMBOLS))
_IS_START = (np.arange(256) & 0xC0) != 0x80  # bytes that begin a code point
_IS_UPPER = (np.arange(256) >= 0x41) & (np.arange(256) <= 0x5A)
_IS_SMALL = (np.arange(256) >= 0x61) & (np.arange(256) <= 0x7A)
_IS_MARK = np.isin(np.arange(256), list(b"!#*$%&|<>"))


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        texts = raw_texts(batch)
        words = words_of(texts, lower=False)
        hashes, first = words.hashes(), words.first

        def within(table: np.ndarray) -> np.ndarray:
            """Bytes of a class in each word."""
            total = np.concatenate([[0], np.cumsum(table[words.buffer], dtype=np.int64)])
            return total[words.ends] - total[words.starts]

        chars = within(_IS_START)
        last = words.buffer[words.ends - 1] if len(words.ends) else np.zeros(0, np.uint8)
        n_lines, n_dup_lines = _lines(texts)
        columns = [
            np.diff(first).astype(np.int64), _sums(chars, first), _sums(within(_IS_SYMBOL), first),
            np.array(n_lines, np.int64), np.array(n_dup_lines, np.int64), _repeat_words(hashes, words.text, len(texts)),
            _sums((within(_IS_UPPER) > 0) & (within(_IS_SMALL) == 0), first), _sums(_IS_MARK[last], first),
            _longest_runs(hashes, words.text, len(texts)),
        ]
        yield pa.record_batch([batch.column("doc_id"), *(pa.array(c) for c in columns)], names=["doc_id", *MEASURES])


def failure_bits() -> Column:
    bits = F.lit(0).cast("long")
    for name, condition in RULES:
        bits = bits.bitwiseOR(F.when(F.expr(condition), F.lit(BITS[name])).otherwise(F.lit(0)).cast("long"))
    return bits


def ledger(docs: DataFrame) -> DataFrame:
    """`doc_id`, the measurements and `failures`, for each row of `docs(doc_id, text)`.

    Words are runs of anything but ASCII white space, lines are cut at line feeds and count if they hold a word. Null
    and empty texts have no words and fail by that; rows that repeat a doc_id, or have none, are measured each.
    """
    measured = texts_of(docs).mapInArrow(_measure, "doc_id long, " + ", ".join(f"{m} long" for m in MEASURES))
    return measured.withColumn("failures", failure_bits())


def ablations(entries: DataFrame, policy: Policy) -> DataFrame:
    """What each rule of the policy does: `rule, n_failed, n_kept, n_kept_without`.

    One aggregate over the ledger to distinct masks, of which there are at most two to the number of rules; the rest is
    bitwise arithmetic on those.
    """
    masks = entries.groupBy(F.col("failures").bitwiseAND(F.lit(policy.mask)).alias("mask")).agg(F.count("*").alias("n"))
    rules = F.explode(F.array(*(F.struct(F.lit(r).alias("rule"), F.lit(BITS[r]).cast("long").alias("bit")) for r in policy.rules)))
    return masks.select("mask", "n", rules.alias("r")).groupBy("r.rule").agg(
        F.sum(F.when(F.expr("mask & r.bit != 0"), F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(F.expr("mask = 0"), F.col("n")).otherwise(0)).alias("n_kept"),
        F.sum(F.when(F.expr("mask & ~r.bit = 0"), F.col("n")).otherwise(0)).alias("n_kept_without"),
    )


def passing(docs: DataFrame, policy: Policy = WEB) -> DataFrame:
    """Rows of `docs`, all columns, that the policy keeps. Measured and filtered in one pass, without a join."""
    names = docs.columns
    texts_of(docs)
    masks = [(BITS[name], condition) for name, condition in RULES if BITS[name] & policy.mask]
    added = {f"__{m}": m for m in MEASURES}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            measured = next(_measure(iter([batch.select(["doc_id", "text"])])))
            yield pa.record_batch([*batch.columns, *(measured.column(m) for m in added.values())], names=[*names, *added])

    failed = F.lit(False)
    for _, condition in masks:
        failed = failed | F.expr(re.sub(r"[a-z_]+", lambda m: f"__{m[0]}" if m[0] in MEASURES else m[0], condition))
    return docs.mapInArrow(run, with_fields(docs, **dict.fromkeys(added, "long"))).where(~failed).select(*names)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ledger(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select(
        "*", (~BASE.keeps()).alias("base_failed"), (BASE.keeps() & WEB.keeps()).alias("kept")
    )


OP2_SQL = r"""
WITH words AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), each AS (
  SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS x FROM words
), windows AS (
  SELECT doc_id, i, x || chr(10) || lead(x, 1) OVER o || chr(10) || lead(x, 2) OVER o AS t
  FROM each WINDOW o AS (PARTITION BY doc_id ORDER BY i)
), twice AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, t) AS c FROM windows WHERE t IS NOT NULL) WHERE c > 1
), covered AS (
  SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, unnest(range(i, i + 3)) AS i FROM twice) GROUP BY doc_id
), runs AS (
  SELECT doc_id, max(n) AS n FROM (
    SELECT doc_id, x, g, count(*) AS n FROM (
      SELECT doc_id, i, x, i - row_number() OVER (PARTITION BY doc_id, x ORDER BY i) AS g FROM each
    ) GROUP BY doc_id, x, g
  ) GROUP BY doc_id
), measured AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
    CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words,
    CAST(len(list_filter(w, lambda x: regexp_matches(x, '[A-Z]') AND NOT regexp_matches(x, '[a-z]'))) AS BIGINT) AS n_upper_words,
    CAST(len(list_filter(w, lambda x: regexp_matches(x, '[!#*$%&|<>]$'))) AS BIGINT) AS n_marked_words,
    CAST(coalesce(r.n, 0) AS BIGINT) AS n_longest_repeat
  FROM words LEFT JOIN covered c USING (doc_id) LEFT JOIN runs r USING (doc_id)
), judged AS (
  SELECT *, CAST(
    (n_words < 50)::INT * 1 + (100 * n_repeat_words > 50 * n_words)::INT * 2 + (word_chars < 2 * n_words)::INT * 4
    + (word_chars > 20 * n_words)::INT * 8 + (100 * n_symbols > 10 * n_words)::INT * 16
    + (n_lines >= 4 AND 100 * n_dup_lines > 30 * n_lines)::INT * 32 + (100 * n_upper_words > 40 * n_words)::INT * 64
    + (100 * n_marked_words > 30 * n_words)::INT * 128 + (100 * n_longest_repeat > 20 * n_words)::INT * 256 AS BIGINT) AS failures
  FROM measured
)
SELECT *, failures & 3 <> 0 AS base_failed, failures = 0 AS kept FROM judged
"""
