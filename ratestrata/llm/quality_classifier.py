"""Quality classifier by supervised subword embeddings.

A document is the average of learned vectors of its words and of the character n-grams of its words, hashed into
`BUCKETS` rows; a softmax over two classes reads the average. Vectors and output weights are learned together by
stochastic gradient descent in numpy on a bounded sample of labelled documents. As the model is linear behind the
average, scoring needs one number per bucket: its vector times the difference of the classes' output weights.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ratestrata.llm.common import U64, Words, mixed, raw_texts, slices, texts_of, with_fields, words_of

BUCKET_BITS = 17
BUCKETS = 1 << BUCKET_BITS
NGRAMS = (3, 4)
#: Tokens beside the hashed ones: a word equal to the one before it, and a word of a line that stood in the text before.
SAME_WORD, SAME_LINE = BUCKETS, BUCKETS + 1
DIMENSIONS, EPOCHS, BATCH, RATE = 16, 5, 16, 0.5
#: At most so many labelled documents are learned from: those of the smallest hashed ids.
SAMPLE = 3000
THRESHOLD = 0.3


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # one per bucket
    bias: float


def _distinct(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each word the number of its form; then the buckets of every form, flat, and the form that each belongs to."""
    forms, at, number = np.unique(words.hashes(), return_index=True, return_inverse=True)
    length = words.ends[at] - words.starts[at] + 2
    ends = np.cumsum(length)
    total = int(ends[-1]) if len(ends) else 0
    owner = np.repeat(np.arange(len(forms)), length)
    place = np.arange(total) - np.repeat(ends - length, length)
    marked = np.zeros(total, np.uint64)  # bytes of the forms between two marks
    inner = (place > 0) & (place < length[owner] - 1)
    marked[inner] = words.buffer[(words.starts[at][owner] + place - 1)[inner]]
    marked[~inner] = 256
    buckets, owners = [mixed(forms ^ U64(0x5BD1E995)) >> U64(64 - BUCKET_BITS)], [np.arange(len(forms))]
    for n in NGRAMS:
        starts = np.flatnonzero(place <= length[owner] - n)
        key = np.full(len(starts), n, np.uint64)
        for step in range(n):
            key = key * U64(0x100000001B3) + marked[starts + step]
        buckets.append(mixed(key) >> U64(64 - BUCKET_BITS))
        owners.append(owner[starts])
    return number, np.concatenate(buckets).astype(np.int64), np.concatenate(owners)


def _repeats(texts: list[bytes], words: Words, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts of SAME_WORD and SAME_LINE for each text."""
    same = np.flatnonzero((number[1:] == number[:-1]) & (words.text[1:] == words.text[:-1]))
    in_lines = np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        seen = set()
        for line in text.split(b"\n"):
            if line in seen:
                in_lines[i] += len(line.split())
            seen.add(line)
    return np.bincount(words.text[same], minlength=len(texts)), in_lines


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Buckets and counts of each labelled text."""
    for batch in slices(batches):
        texts = raw_texts(batch)
        buckets, counts = [], []
        for text in texts:
            words = words_of([text], lower=False)
            number, own, owner = _distinct(words)
            n_words, n_lines = _repeats([text], words, number)
            times = np.bincount(number, minlength=int(number.max()) + 1 if len(number) else 0)
            sums = np.bincount(own, weights=times[owner], minlength=BUCKETS + 2)
            sums[SAME_WORD], sums[SAME_LINE] = n_words[0], n_lines[0]
            found = np.flatnonzero(sums)
            buckets.append(found.astype(np.int32))
            counts.append(sums[found].astype(np.float32))
        yield pa.record_batch(
            [batch.column("label"), pa.array(buckets, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.float32()))],
            names=["label", "buckets", "counts"],
        )


def fit(samples: list[tuple[int, np.ndarray, np.ndarray]]) -> Model:
    """Learn from `(label, buckets, counts)`. Without samples every score is 0.5; with one class only, its prior counts."""
    rng = np.random.default_rng(10)
    vectors = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS + 2, DIMENSIONS)).astype(np.float32)
    output, bias = np.zeros((DIMENSIONS, 2), np.float32), np.zeros(2, np.float32)
    samples = [(label, b, c / c.sum()) for label, b, c in samples if len(b)]
    steps = EPOCHS * -(-len(samples) // BATCH)
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(samples))
        for i in range(0, len(order), BATCH):
            rate = RATE * (1 - step / steps)
            step += 1
            own = [samples[j] for j in order[i : i + BATCH]]
            flat, share = np.concatenate([b for _, b, _ in own]), np.concatenate([c for *_, c in own]).astype(np.float32)
            first = np.cumsum([0] + [len(b) for _, b, _ in own[:-1]])
            hidden = np.add.reduceat(vectors[flat] * share[:, None], first, axis=0)
            scores = hidden @ output + bias
            scores = np.exp(scores - scores.max(axis=1, keepdims=True))
            error = scores / scores.sum(axis=1, keepdims=True)
            error[np.arange(len(own)), [label for label, *_ in own]] -= 1
            back = rate * len(own) * (error @ output.T)
            output -= rate * hidden.T @ error
            bias -= rate * error.mean(axis=0)
            for (_, b, c), gradient in zip(own, back):  # buckets of one document are distinct
                vectors[b] -= np.outer(c, gradient)
    difference = output[:, 1] - output[:, 0]
    return Model((vectors @ difference).astype(np.float64), float(bias[1] - bias[0]))


def held_out() -> Column:
    """Documents never learned from."""
    return F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Learn `quality` of the labelled documents that are not held out, `sample` of them at most.

    The sample is taken among labels, by hashed id, so that it does not depend on the order of rows, and has a fixed size: it
    alone is broadcast, and only its bucket counts reach the driver. A document labelled twice counts by its
    smaller label; labels other than 0 and 1 and null ids are ignored.
    """
    chosen = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label"))
        .where("doc_id is not null and label in (0, 1)").where(~held_out())
        .groupBy("doc_id").agg(F.min("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    )
    texts = texts_of(docs).join(F.broadcast(chosen), "doc_id").select("doc_id", "label", "text")
    counted = texts.select("label", "text", "doc_id").mapInArrow(_features, "label int, buckets array<int>, counts array<float>")
    table = counted.toArrow()
    samples = [
        (label.as_py(), b.values.to_numpy(), c.values.to_numpy())
        for label, b, c in zip(table["label"], table["buckets"], table["counts"])
    ]
    samples.sort(key=lambda x: (x[0], len(x[1]), x[1].tobytes(), x[2].tobytes()))  # tasks end in any order
    return fit(samples)


def scores(texts: list[bytes], model: Model) -> np.ndarray:
    words = words_of(texts, lower=False)
    number, buckets, owner = _distinct(words)
    n_forms = int(owner.max()) + 1 if len(owner) else 0
    weight = np.bincount(owner, weights=model.weights[buckets], minlength=n_forms)
    times = np.bincount(owner, minlength=n_forms)
    total = np.bincount(words.text, weights=weight[number], minlength=len(texts))
    count = np.bincount(words.text, weights=times[number], minlength=len(texts))
    for n, bucket in zip(_repeats(texts, words, number), (SAME_WORD, SAME_LINE)):
        total += n * model.weights[bucket]
        count += n
    return 1 / (1 + np.exp(-(total / np.maximum(count, 1) + model.bias)))


def _scored(model: Model, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = scores(raw_texts(batch), model)
            yield pa.record_batch([*(batch.column(n) for n in names), pa.array(found)], names=[*names, "__score"])

    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """`doc_id, score` of each row: the probability of label 1. Null and empty texts get what the bias alone says."""
    docs = texts_of(docs)
    scored = docs.mapInArrow(_scored(model, ["doc_id"]), "doc_id long, __score double")
    return scored.withColumnRenamed("__score", "score")


def good(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """Rows of `docs`, all columns, that score the threshold or more."""
    texts_of(docs)
    scored = docs.mapInArrow(_scored(model, docs.columns), with_fields(docs, __score="double"))
    return scored.where(F.col("__score") >= threshold).drop("__score")


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, model).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
