"""N-gram language model by deleted interpolation.

The probability of a token mixes maximum-likelihood estimates: of n-grams of every length up to the order, and uniform, with weights
that depend on the longest context that was seen, and on how often it was. The weights are learned by expectation-maximisation on counts that were
deleted from the estimates: a fifth of the training documents is held out for that, and put back
for the final counts.

Texts are tokenised once, into blocks of token codes. A block asks for the counts of its distinct n-grams, packed by
range of their hash; the buckets of a range add up what all blocks bring and answer every block in its own order. So an
n-gram travels once per block, not once per occurrence, and a word that is a third of all text is one entry of
each block: 16 bytes for every 8 MB of text. Nothing that grows with the vocabulary is broadcast or collected: the driver sees three totals and a
histogram of probability ratios, whose size is fixed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from ratestrata.llm.common import U64, Workspace, mixed, raw_texts, slices, texts_of, words_of

BLOCK_BYTES = 8 << 20
#: N-grams that a bucket of the hash range holds, about.
BUCKET = 1 << 20
#: Contexts of each length are told apart by the binary logarithm of their count, whatever it is.
CLASSES = 64
#: The histogram for the mixture weights: steps a factor of two, and the range of logarithms.
STEPS, RANGE = 4, 40
ROUNDS = 50
END = U64(0x9E37)
#: Folds by crc32 of the id modulo 5.
HELD_OUT, DELETED = 1, 0
NO_ID = 6

_BLOCK_SCHEMA = "block long, n_tokens long, doc_ids binary, folds binary, lengths binary, forms binary, codes binary"
_BLOCK_NAMES = ["block", "n_tokens", "doc_ids", "folds", "lengths", "forms", "codes"]


_small, _large = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def packed(values: np.ndarray) -> bytes:
    """An array, byte by byte of its numbers and compressed: what travels is mostly small counts and sorted hashes."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T
    return _small.compress(planes.tobytes())


def unpacked(data: bytes, kind) -> np.ndarray:
    planes = np.frombuffer(_large.decompress(data), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return planes.T.copy().view(kind).ravel()


def packed_sorted(values: np.ndarray) -> bytes:
    return packed(np.diff(values, prepend=U64(0)))


def unpacked_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpacked(data, np.uint64), dtype=np.uint64)


@dataclass(frozen=True)
class Mixture:
    tokens: int  # N
    types: int  # V
    weights: np.ndarray  # per context class: n-grams from the longest to unigrams, uniform


def _context_classes(seen: list[np.ndarray]) -> np.ndarray:
    """Class of each token by the counts of its contexts of one, two, ... words: the longest that was seen, and its count."""
    out = np.zeros(len(seen[0]) if seen else 0, np.int64)
    for k, counts in enumerate(seen):
        out = np.where(counts > 0, k * CLASSES + np.log2(np.maximum(counts, 1)).astype(np.int64) + 1, out)
    return out


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    block = TaskContext.get().partitionId() << 32
    for batch in slices(batches, most=BLOCK_BYTES):
        words = words_of(raw_texts(batch), lower=True)
        lengths = np.diff(words.first)
        hashes = np.insert(words.hashes(), words.first[1:], mixed(np.array([END]))[0])  # every text ends in the end token
        forms, codes = np.unique(hashes, return_inverse=True)
        yield pa.record_batch([
            pa.array([block], pa.int64()), pa.array([len(codes)], pa.int64()),
            *(pa.array([data], pa.binary()) for data in (
                packed(batch.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)),
                packed(batch.column("fold").to_numpy(zero_copy_only=False).astype(np.int8)), packed((lengths + 1).astype(np.int64)),
                packed_sorted(forms), packed(codes.astype(np.uint32)),
            )),
        ], names=_BLOCK_NAMES)
        block += 1


@dataclass
class _Block:
    doc_ids: np.ndarray
    folds: np.ndarray
    lengths: np.ndarray
    forms: np.ndarray
    codes: np.ndarray

    @classmethod
    def of(cls, row: dict) -> _Block:
        kinds = {"doc_ids": np.int64, "folds": np.int8, "lengths": np.int64, "codes": np.uint32}
        return cls(forms=unpacked_sorted(row["forms"]), **{name: unpacked(row[name], kind) for name, kind in kinds.items()})

    def grams(self, order: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For one word, two words, ...: the distinct keys in order, the number of each token's n-gram, and of its context one shorter.

        The first token of a text follows an end; it has no longer context. Such places have number -1.
        """
        out = [(self.forms, self.codes.astype(np.int64), np.full(len(self.codes), -1))]
        if not len(self.codes) or order == 1:
            return out[:order]
        end = int(np.searchsorted(self.forms, mixed(np.array([END]))[0]))
        starts = np.cumsum(self.lengths) - self.lengths
        place = np.arange(len(self.codes)) - np.repeat(starts, self.lengths)
        for k in range(1, order):
            above, numbers, _ = out[-1]
            context = np.concatenate([[-1], numbers[:-1]])
            if k == 1:
                context[starts] = end
            context[place < k - 1] = -1
            valid = np.flatnonzero(context >= 0)
            pairs, number = np.unique((context[valid].astype(np.uint64) << U64(32)) | self.codes[valid], return_inverse=True)
            keys = mixed(above[(pairs >> U64(32)).astype(np.int64)] * U64(3) ^ mixed(self.forms[(pairs & U64(0xFFFFFFFF)).astype(np.int64)] + U64(7)))
            sequence = np.argsort(keys, kind="stable")
            rank = np.empty(len(sequence), np.int64)
            rank[sequence] = np.arange(len(sequence))
            mine = np.full(len(self.codes), -1)
            mine[valid] = rank[number]
            out.append((keys[sequence], mine, context))
        return out

    def counted(self, row: dict, order: int, parts: tuple[str, ...]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Counts of each token's n-grams and of their contexts, of one word, two words, ...: the sums of the folds named."""
        counts = [sum(unpacked(row[f"{part}_{k}"], np.uint64) for part in parts).astype(float) for k in range(order)]
        own, seen = [], []
        for k, (_, numbers, contexts) in enumerate(self.grams(order)):
            own.append(np.where(numbers >= 0, np.append(counts[k], 0)[numbers], 0))
            if k:
                seen.append(np.where(contexts >= 0, np.append(counts[k - 1], 0)[contexts], 0))
        return own, seen

    def token_folds(self) -> np.ndarray:
        return np.repeat(self.folds, self.lengths)


def _asked(bits: int, order: int):
    """`kind, bucket, block, keys, kept, deleted`: a block's distinct n-grams and how often it has them, by range of the hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                (row,) = batch.slice(i, 1).to_pylist()
                own = _Block.of(row)
                folds = own.token_folds()
                for kind, (grams, numbers, _) in enumerate(own.grams(order)):
                    counts = [
                        np.bincount(numbers[chosen & (numbers >= 0)], minlength=len(grams)).astype(np.uint32)
                        for chosen in (~np.isin(folds, (HELD_OUT, NO_ID, DELETED)), folds == DELETED)
                    ]
                    bucket = (grams >> U64(64 - bits)).astype(np.int64) if bits else np.zeros(len(grams), np.int64)
                    first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(grams) else []
                    cuts = list(zip(first, [*first[1:], len(grams)]))
                    yield pa.record_batch([
                        pa.array([kind] * len(cuts), pa.int32()), pa.array([int(bucket[a]) for a, _ in cuts], pa.int64()),
                        pa.array([row["block"]] * len(cuts), pa.int64()), pa.array([packed_sorted(grams[a:b]) for a, b in cuts], pa.binary()),
                        *(pa.array([packed(c[a:b]) for a, b in cuts], pa.binary()) for c in counts),
                    ], names=["kind", "bucket", "block", "keys", "kept", "deleted"])

    return run


def _answered(table):
    """One bucket: totals of every n-gram of it, for each block in the block's order. Types are counted once, on the first row."""
    rows = table.to_pylist()
    keys = [unpacked_sorted(row["keys"]) for row in rows]
    distinct, number = np.unique(np.concatenate(keys), return_inverse=True)
    kept, deleted = (
        np.bincount(number, weights=np.concatenate([unpacked(row[c], np.uint32) for row in rows]), minlength=len(distinct)).astype(np.uint64)
        for c in ("kept", "deleted")
    )
    cuts = np.cumsum([0] + [len(k) for k in keys])
    types = int(((kept + deleted) > 0).sum())
    return pa.table({
        "kind": table["kind"], "bucket": table["bucket"], "block": table["block"],
        "kept": pa.array([packed(kept[number[a:b]]) for a, b in zip(cuts, cuts[1:])], pa.binary()),
        "deleted": pa.array([packed(deleted[number[a:b]]) for a, b in zip(cuts, cuts[1:])], pa.binary()),
        "types": pa.array([types] + [0] * (len(rows) - 1), pa.int64()),
    })


def _known(order: int) -> list[str]:
    return [f"{part}_{k}" for k in range(order) for part in ("kept", "deleted")]


def _joined(order: int):
    """A block's answers, joined in the order of the buckets, are its counts in the order of its n-grams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                (row,) = batch.slice(i, 1).to_pylist()
                answers = sorted(row["answers"], key=lambda a: (a["kind"], a["bucket"]))
                known = [
                    packed(np.concatenate([np.zeros(0, np.uint64), *(unpacked(a[c], np.uint64) for a in answers if a["kind"] == kind)]))
                    for kind in range(order) for c in ("kept", "deleted")
                ]
                yield pa.record_batch(
                    [pa.array([row[n]], pa.int64() if n in ("block", "n_tokens") else pa.binary()) for n in _BLOCK_NAMES]
                    + [pa.array([k], pa.binary()) for k in known],
                    names=_BLOCK_NAMES + _known(order),
                )

    return run


def _fold_sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            own = _Block.of(row)
            n = np.bincount(own.folds, weights=own.lengths).astype(np.int64)
            yield pa.record_batch([pa.array(np.arange(len(n), dtype=np.int32)), pa.array(n)], names=["fold", "n"])


def _estimates(own: list[np.ndarray], seen: list[np.ndarray], tokens: int) -> list[np.ndarray]:
    """Maximum-likelihood estimates of each token, from the longest n-gram to the unigram; 0 behind an unseen context."""
    return [own[k] / np.maximum(seen[k - 1], 1) for k in range(len(own) - 1, 0, -1)] + [own[0] / max(tokens, 1)]


def _ratios(tokens: int, types: int, order: int):
    """Histogram of the deleted tokens: context class, and how many times uniform each estimate is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                (row,) = batch.slice(i, 1).to_pylist()
                block = _Block.of(row)
                chosen = block.token_folds() == DELETED
                if not chosen.any():
                    continue
                own, seen = block.counted(row, order, ("kept",))
                own, seen = [x[chosen] for x in own], [x[chosen] for x in seen]
                steps = []
                for estimate in _estimates(own, seen, tokens):
                    x = estimate * (types + 1)
                    steps.append(np.where(x > 0, np.clip(np.round(np.log2(np.maximum(x, 1e-300)) * STEPS), -RANGE * STEPS, RANGE * STEPS), -RANGE * STEPS - 1))
                classes = _context_classes(seen) if seen else np.zeros(len(own[0]), np.int64)
                cells, n = np.unique(np.stack([classes, *steps]).astype(np.int32), axis=1, return_counts=True)
                yield pa.record_batch([*(pa.array(c) for c in cells), pa.array(n.astype(np.int64))], names=["class", *_ratio_names(order), "n"])

    return run


def _ratio_names(order: int) -> list[str]:
    return [f"ratio_{k}" for k in range(order, 0, -1)]


def learned_weights(histogram: list[tuple[int, ...]], order: int) -> np.ndarray:
    """Mixture weights of every context class by expectation-maximisation.

    What a class cannot use, n-grams longer than its context allows, weighs nothing. A class without deleted tokens has the weights of the class below it.
    """
    cells = np.array(histogram, np.int64).reshape(-1, order + 2)
    weights = np.zeros((max(1, order - 1) * CLASSES + 1, order + 1))
    for context in range(len(weights)):
        longest = 0 if context == 0 else (context - 1) // CLASSES + 1
        usable = np.arange(order + 1) >= order - 1 - longest
        start = np.where(usable, 1.0, 0.0) / usable.sum()
        own = cells[cells[:, 0] == context]
        if not len(own):
            weights[context] = start if context == 0 or (context - 1) % CLASSES == 0 else weights[context - 1]
            continue
        ratio = np.stack([*(np.where(own[:, c] < -RANGE * STEPS, 0, 2.0 ** (own[:, c] / STEPS)) for c in range(1, order + 1)), np.ones(len(own))], axis=1)
        mine = start
        for _ in range(ROUNDS):
            share = ratio * mine
            share /= share.sum(axis=1, keepdims=True)
            mine = (share * own[:, -1:]).sum(axis=0) / own[:, -1].sum()
        floor = np.zeros(order + 1)
        floor[-2:] = 0.5
        weights[context] = 0.999 * mine + 0.001 * floor  # never without a chance for what is new
    return weights


def _scored(model: Mixture, order: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                (row,) = batch.slice(i, 1).to_pylist()
                block = _Block.of(row)
                own, seen = block.counted(row, order, ("kept", "deleted"))
                weight = model.weights[_context_classes(seen) if seen else np.zeros(len(own[0]), np.int64)]
                p = weight[:, -1] / (model.types + 1)
                for k, estimate in enumerate(_estimates(own, seen, model.tokens)):
                    p += weight[:, k] * estimate
                base = np.log10((own[0] + 0.5) / (model.tokens + 0.5 * (model.types + 1)))
                first = np.cumsum(block.lengths) - block.lengths
                yield pa.record_batch([
                    pa.array(block.doc_ids), pa.array(block.folds.astype(np.int32)), pa.array(block.lengths),
                    pa.array(np.add.reduceat((own[0] > 0).astype(np.int64), first)), pa.array(np.add.reduceat(base, first)),
                    pa.array(np.add.reduceat(np.log10(p), first)),
                ], names=["doc_id", "fold", "n_tokens", "n_known", "base_score", "score"])

    return run


def score_documents(docs: DataFrame, order: int = 2) -> DataFrame:
    """`doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score` of each row of `docs(doc_id, text)`, by n-grams of up to `order` words.

    Texts are lower-cased (A-Z) and cut at ASCII white space; every text ends in an end token, which is a token
    like others and the context of first tokens. Training texts are those whose crc32(doc_id) modulo 5 is not 1.
    `base_score` sums log10((c + 0.5) / (N + 0.5 (V + 1))), `score` the model's log10 probabilities. Null and
    empty texts are the end token alone. Repeated rows count as often as they stand there. A null doc_id is neither
    held out nor trained on: it is scored, with a null id.
    """
    if order < 1:
        raise ValueError("the order is 1 or more")
    spark = docs.sparkSession
    work = Workspace(spark, "interpolated-lm")
    fold = F.coalesce((F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) % 5).cast("int"), F.lit(NO_ID))
    blocks = work.store(texts_of(docs, fold.alias("fold")).mapInArrow(_blocks, _BLOCK_SCHEMA), "blocks")
    sizes = blocks.agg(F.sum("n_tokens")).first()[0] or 0
    bits = max(0, int(np.ceil(np.log2(max(1, sizes / BUCKET)))))
    asked = blocks.mapInArrow(_asked(bits, order), "kind int, bucket long, block long, keys binary, kept binary, deleted binary")
    answers = asked.groupBy("kind", "bucket").applyInArrow(
        _answered, "kind int, bucket long, block long, kept binary, deleted binary, types long"
    )
    answers = work.store(answers, "answers")
    types = answers.where("kind = 0").agg(F.sum("types")).first()[0] or 0
    folded = blocks.mapInArrow(_fold_sizes, "fold int, n long").groupBy("fold").agg(F.sum("n").alias("n")).collect()
    tokens = {row["fold"]: row["n"] for row in folded}
    kept = sum(n for f, n in tokens.items() if f not in (HELD_OUT, NO_ID, DELETED))
    total = kept + tokens.get(DELETED, 0)
    del asked
    work.release()  # the questions' shuffle goes before the answers' begins
    replies = answers.groupBy("block").agg(F.collect_list(F.struct("kind", "bucket", "kept", "deleted")).alias("answers"))
    known = blocks.join(replies, "block").mapInArrow(_joined(order), _BLOCK_SCHEMA + "".join(f", {k} binary" for k in _known(order)))
    known = work.store(known, "known")
    work.drop("blocks")
    work.drop("answers")
    names = ["class", *_ratio_names(order)]
    cells = known.mapInArrow(_ratios(kept, types, order), ", ".join(f"{n} int" for n in names) + ", n long").groupBy(*names).agg(F.sum("n").alias("n"))
    model = Mixture(total, types, learned_weights([tuple(row) for row in cells.collect()], order))
    scored = known.mapInArrow(_scored(model, order), "doc_id long, fold int, n_tokens long, n_known long, base_score double, score double")
    return scored.select(
        F.when(F.col("fold") != NO_ID, F.col("doc_id")).alias("doc_id"), (F.col("fold") == HELD_OUT).alias("held_out"),
        "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score",
    )


def op3_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
