"""Best-fit packing of token pieces by a grouping genetic algorithm on islands.

A document becomes token ids and an end id; one that is longer than a sequence is cut so that all pieces but the
first are full. Full pieces are sequences of their own. The others are dealt out to shards by hash, and each
shard is evolved by several islands, which start from different packings: a solution is a list of bins, crossover injects the well-filled
bins of one parent whole into the other, removes what is then there twice, and refits the displaced pieces.
After each epoch a shard's islands pass on their elite through a shuffle; the best island's bins are the result.
Only lengths travel; texts are read once and never shuffled.
"""

from __future__ import annotations

import bisect
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ratestrata.llm.common import Workspace, slices, texts_of

SEQUENCE = 2048
END = 0
#: Pieces of a shard. A packed shard wastes less than one sequence more than the best packing of all pieces would.
SHARD = 8192
ISLANDS, EPOCHS, GENERATIONS, POPULATION = 3, 2, 20, 6


class ByteUnits:
    """Ids of a byte-level BPE tokenizer.

    Texts are encoded whole, in one call each: looking up remembered words costs more than encoding them again.
    """

    def __init__(self, path: str) -> None:
        import json

        import tiktoken

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        if spec["normalizer"] or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["pre_tokenizer"]["add_prefix_space"]:
            raise ValueError(f"{path} is no plain byte-level tokenizer")
        # byte-level vocabularies write bytes as printable characters: those that are printable stand for themselves
        printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        others = [b for b in range(256) if b not in set(printable)]
        to_byte = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(to_byte[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        self.encoding = tiktoken.Encoding("byte-level", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        return [self.encoding.encode_to_numpy(text, allowed_special="all") for text in texts]


def _units(text: str) -> list[str]:
    """Pieces of a text that can be encoded on their own: the splitting rule of these tokenizers never joins a blank to what
    stands before it unless that is white space, so a text may be cut before every blank between two non-blank characters."""
    if not text:
        return []
    if re.search(r"\s\s", text):
        return re.split(r"(?<=\S)(?= \S)", text)
    first, *rest = text.split(" ")
    return ([first] if first else []) + [" " + unit for unit in rest]


@lru_cache(maxsize=2)
def byte_units(path: str) -> ByteUnits:
    """One for each Python worker."""
    return ByteUnits(path)


def pieces(docs: DataFrame, tokenizer: str, sequence: int = SEQUENCE) -> DataFrame:
    """`doc_id, piece, start, length, ids_crc32` of every document with its end id; null text counts as empty.

    A text of up to `sequence` ids, the end included, is one piece. Of longer ones all pieces but the first are full.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = byte_units(tokenizer)
        for batch in slices(batches, most=1 << 20):  # texts of a slice are Python objects
            rows = []
            for doc, ids in zip(batch.column("doc_id").to_pylist(), units.encode([t or "" for t in batch.column("text").to_pylist()])):
                ids = np.append(ids, END).astype("<u4")
                at = [0, *range(len(ids) % sequence or sequence, len(ids) + 1, sequence)]
                rows += [(doc, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(at, at[1:]))]
            columns = list(zip(*rows))
            yield pa.record_batch(
                [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return texts_of(docs).mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


class Shard:
    """Packings of one shard. A solution is a list of bins, a bin its free space and its items, an item the number of a piece."""

    def __init__(self, lengths: list[int], sequence: int, seed: int) -> None:
        self.lengths, self.sequence, self.rng = lengths, sequence, np.random.default_rng(seed)

    def best_fit(self, bins: list, items: list[int]) -> list:
        """The items, largest first, each into the fullest bin that holds it, or a new one."""
        order = sorted(range(len(bins)), key=lambda i: bins[i][0])
        spaces, where = [bins[i][0] for i in order], order
        bins = [[free, list(own)] for free, own in bins]
        for item in sorted(items, key=self.lengths.__getitem__, reverse=True):
            need = self.lengths[item]
            at = bisect.bisect_left(spaces, need)
            if at < len(spaces):
                free, number = spaces.pop(at) - need, where.pop(at)
                bins[number][0] = free
                bins[number][1].append(item)
            else:
                free, number = self.sequence - need, len(bins)
                bins.append([free, [item]])
            at = bisect.bisect_left(spaces, free)
            spaces.insert(at, free)
            where.insert(at, number)
        return bins

    def fill(self, items: list[int], loose: int = 1) -> list:
        """Bin after bin, each as full as one piece or two can close it.

        A bin gets the largest piece left, or one of the `loose` largest at random, then largest ones for as long as two more would not fill it, then the
        piece or the pair that leaves least space.
        """
        items = sorted(items, key=self.lengths.__getitem__)
        sizes, numbers = np.array([self.lengths[i] for i in items], np.int64), np.array(items, np.int64)
        bins = []
        while len(sizes):
            at = len(sizes) - 1 - (int(self.rng.integers(0, min(loose, len(sizes)))) if loose > 1 else 0)
            chosen, left = [at], np.delete(np.arange(len(sizes)), at)
            free = self.sequence - int(sizes[at])
            while len(left):
                fits = left[: np.searchsorted(sizes[left], free, "right")]
                if not len(fits):
                    break
                own = sizes[fits]
                if len(fits) > 1 and own[-1] + own[-2] >= free:
                    # the best partner of each piece, the largest that fits beside it and is not itself
                    partner = np.searchsorted(own, free - own, "right") - 1
                    partner -= partner == np.arange(len(own))
                    both = np.where(partner >= 0, own + own[np.maximum(partner, 0)], -1)
                    best = int(both.argmax())
                    last = [fits[best], fits[partner[best]]] if both[best] > own[-1] else [fits[-1]]
                    chosen += [int(x) for x in last]
                    free -= int(sizes[last].sum())
                    break
                chosen.append(int(fits[-1]))
                free -= int(own[-1])
                left = fits[:-1]
            bins.append([free, numbers[chosen].tolist()])
            keep = np.ones(len(sizes), bool)
            keep[chosen] = False
            sizes, numbers = sizes[keep], numbers[keep]
        return bins

    def cost(self, bins: list) -> float:
        """Fewer bins first; among equals the one with the fuller bins, by the squares of their fill."""
        filled = sum((self.sequence - free) ** 2 for free, _ in bins) / (self.sequence**2 * (len(bins) + 1))
        return len(bins) - filled

    def refit(self, bins: list, items: list[int]) -> list:
        """Displaced pieces: into new bins of their own, closely filled, or into what space there is, whichever is better."""
        loose = self.best_fit(bins, items)
        close = self.fill(items, 3)
        kept = [x for x in close if x[0] * 50 <= self.sequence]  # those that came out full stay, the rest are fitted anywhere
        close = self.best_fit(bins + kept, [item for x in close if x[0] * 50 > self.sequence for item in x[1]])
        return min(loose, close, key=self.cost)

    def cross(self, a: list, b: list) -> list:
        """Well-filled bins of `b` go whole into `a`; bins of `a` that hold any of their items are emptied, the rest refitted."""
        filled = sorted(range(len(b)), key=lambda i: b[i][0])[: max(1, len(b) // 2)]
        injected = [b[filled[i]] for i in self.rng.permutation(len(filled))[: max(1, len(filled) // 2)].tolist()]
        inside = {item for _, own in injected for item in own}
        kept, displaced = injected, []
        for free, own in a:
            if inside.isdisjoint(own):
                kept.append((free, own))
            else:
                displaced += [item for item in own if item not in inside]
        return self.refit(kept, displaced)

    def mutate(self, a: list) -> list:
        """The emptiest bins and a few others are taken apart and refitted."""
        few = max(1, len(a) // 20)
        gone = set(sorted(range(len(a)), key=lambda i: -a[i][0])[: 3 * few]) | set(self.rng.integers(0, len(a), few).tolist())
        return self.refit([x for i, x in enumerate(a) if i not in gone], [item for i in gone for item in a[i][1]])

    def evolve(self, elite: list[list], generations: int, island: int = 0) -> list:
        """The best solution after some generations, from the elite, or else from best fit and a packing that differs from island to island.

        The evolution ends when the solution needs no more bins than the total of the lengths.
        """
        lowest = -(-sum(self.lengths) // self.sequence)
        every = list(range(len(self.lengths)))
        population = list(elite) or [self.best_fit([], every)]
        if not elite and len(population[0]) > lowest:
            population.append(self.fill(every, 1 if island == 0 else 4 * island))
        for _ in range(generations):
            population.sort(key=self.cost)
            if len(population[0]) <= lowest:
                break
            if len(population) < POPULATION:
                population.append(self.mutate(population[len(population) % 2]) if len(population) > 1 else self.mutate(population[0]))
                continue
            one, other = sorted(self.rng.choice(len(population), 2, replace=False).tolist())
            child = self.cross(population[one], population[other])
            population[-1] = min(child, self.mutate(child), key=self.cost)
        return min(population, key=self.cost)

    def bins_of(self, numbers: np.ndarray) -> list:
        bins: dict[int, list] = {}
        for item, number in enumerate(numbers.tolist()):
            own = bins.setdefault(number, [self.sequence, []])
            own[0] -= self.lengths[item]
            own[1].append(item)
        return list(bins.values())

    def numbers_of(self, bins: list) -> np.ndarray:
        out = np.empty(len(self.lengths), np.int32)
        for number, (_, own) in enumerate(bins):
            out[own] = number
        return out


def pack(rows: DataFrame, sequence: int = SEQUENCE) -> DataFrame:
    """`rows(doc_id, piece, length, ...)` with `sequence_id` and `offset`: gapless places in sequences of `sequence` tokens.

    Pieces are dealt to shards of about `SHARD` by hash, however many copies of a document there are. Ties fall to the order of
    (doc_id, piece). Pieces longer than a sequence are the caller's to cut: they, and lengths that are null or negative, fail the
    job. An empty table gives an empty one.
    """
    spark = rows.sparkSession
    work = Workspace(spark, "packing")
    message = F.format_string(f"a piece of length %s cannot be packed into sequences of {sequence} tokens", "length")
    length = F.when(F.col("length").between(0, sequence), F.col("length")).otherwise(F.raise_error(message))
    rows = work.store(rows.withColumns({"length": length, "row": F.monotonically_increasing_id()}), "pieces")
    small = rows.where(F.col("length") < sequence)
    shards = max(1, -(-small.count() // SHARD))
    items = small.select(F.pmod(F.xxhash64("doc_id", "piece", "row"), F.lit(shards)).alias("shard"), "row", "length")
    # one row for each shard: its pieces, at most a few times SHARD of them, longest first
    table = items.groupBy("shard").agg(F.sort_array(F.collect_list(F.struct("length", "row")), asc=False).alias("items"))
    table = work.store(table.select("shard", F.col("items.length").alias("lengths"), F.col("items.row").alias("rows")), "shards")

    def epoch(number: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out = []
                for shard, island, lengths, elite in zip(*(batch.column(c).to_pylist() for c in ("shard", "island", "lengths", "elite"))):
                    own = Shard(lengths, sequence, (shard * 7 + island * 3 + number) & 0x7FFFFFFF)
                    best = own.evolve([own.bins_of(np.frombuffer(e, np.int32)) for e in elite or ()], GENERATIONS, island)
                    out.append((shard, island, own.cost(best), own.numbers_of(best).tobytes()))
                columns = list(zip(*out)) if out else [[]] * 4
                yield pa.record_batch(
                    [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.float64(), pa.binary()))],
                    names=["shard", "island", "cost", "bins"],
                )

        return run

    islands = table.select("shard", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"), "lengths")
    parts = min(shards * ISLANDS, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    elite = None
    for number in range(EPOCHS):
        if elite is None:
            state = islands.withColumn("elite", F.lit(None).cast("array<binary>"))
        else:  # every island's best migrates to all islands of its shard
            state = islands.join(
                elite.groupBy("shard").agg(F.transform(F.sort_array(F.collect_list(F.struct("cost", "bins"))), lambda x: x["bins"]).alias("elite")), "shard"
            )
        evolved = state.repartition(parts, "shard", "island").mapInArrow(epoch(number), "shard long, island int, cost double, bins binary")
        elite = work.store(evolved, f"epoch-{number}")
    best = elite.groupBy("shard").agg(F.min_by("bins", F.struct("cost", "island")).alias("bins"))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, lengths, numbers, bins in zip(*(batch.column(c).to_pylist() for c in ("shard", "lengths", "rows", "bins"))):
                own = pd.DataFrame({"bin": np.frombuffer(bins, np.int32), "length": lengths, "row": numbers})
                before = own.groupby("bin")["length"].cumsum() - own["length"]
                yield pa.record_batch([
                    pa.array(own["row"], pa.int64()), pa.array(own["bin"].astype(np.int64) * shards + shard, pa.int64()), pa.array(before, pa.int64()),
                ], names=["row", "sequence_id", "offset"])

    places = table.join(best, "shard").mapInArrow(placed, "row long, sequence_id long, offset long")
    # full pieces take the negative numbers
    full = rows.where(F.col("length") == sequence).select("row", (-1 - F.col("row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return rows.join(places.unionByName(full), "row").drop("row")


def pack_documents(docs: DataFrame, tokenizer: str, sequence: int = SEQUENCE) -> DataFrame:
    """Every piece of every document with its place: `doc_id, piece, start, length, ids_crc32, sequence_id, offset`.

    Null and empty texts are one piece of the end id; repeated rows are packed as often as they stand there; a null
    doc_id stays null.
    """
    return pack(pieces(docs, tokenizer, sequence), sequence)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), default_tokenizer())
